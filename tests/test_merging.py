"""Merge-on-read collections against plain rewriting, version by version."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import documents as docs
from millrace.sources import merging


def people(spark, n=2000):
    return spark.range(n).select(
        F.col("id").alias("k"), (F.col("id") % 97).cast("int").alias("age"), F.concat(F.lit("p"), "id").alias("name"))


def rows(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=str)


def test_same_as_rewriting(spark):
    store = merging.stored(people(spark), "k", 8)
    plain = people(spark)
    for query, change, many in [
        ({"age": {"$gt": 90}}, {"$inc": {"age": 5}}, True), ({"age": 3}, {"$set": {"name": "first"}}, False),
        ({"k": 11}, {"$set": {"name": "eleven"}}, True), ({"age": {"$lt": 2}}, {"$set": {"mark": "new"}}, True),
        ({"age": 1000}, {"$set": {"name": "none"}}, True), ({"k": 11}, {"$set": {"name": "eleven"}}, True),
        ({"k": 5000}, {"$set": {"name": "added"}}, True),
    ]:
        upsert = query == {"k": 5000}
        done = docs.update(plain, query, change, many, upsert, "k")
        assert store.update(query, change, many, upsert) == done.counts.first().asDict()
        plain = spark.createDataFrame(done.rows.collect(), done.rows.schema)
        assert rows(store.read()) == rows(plain)
    for query, many in [({"age": {"$gte": 80}}, True), ({"age": 4}, False), ({"age": 2000}, True)]:
        assert store.delete(query, many) == docs.deleted_count(plain, query, many, "k").first()[0]
        plain = spark.createDataFrame(docs.delete(plain, query, many, "k").collect(), plain.schema)
        assert rows(store.read()) == rows(plain)
    assert store.compact(0.1) > 0 and rows(store.read()) == rows(plain)
    assert store.compact(0.0) >= 0 and not store.version().touched and rows(store.read()) == rows(plain)
    store.vacuum()
    assert rows(store.read()) == rows(plain) and store.count({"k": 12}) == 1
    assert store.update({"k": 12}, {"$set": {"age": 1}}, True)["modified_count"] == 1
    assert store.count() == plain.count()


def test_random_writes(spark):
    rng = random.Random(5)
    store, held = merging.stored(people(spark, 60), "k", 4), {r.k: (r.age, r.name) for r in people(spark, 60).collect()}
    for step in range(14):
        k, age = rng.randrange(90), rng.randrange(60)
        if step % 5 == 4:
            store.compact(rng.choice([0.0, 0.3]))
        elif step % 3 == 0:
            assert store.delete({"age": age}, many=True) == sum(a == age for a, _ in held.values())
            held = {i: v for i, v in held.items() if v[0] != age}
        elif k in held:
            store.update({"k": k}, {"$inc": {"age": 1}})
            held[k] = (held[k][0] + 1, held[k][1])
            with pytest.raises(ValueError, match=str(k)):
                store.insert(people(spark, 90).filter(F.col("k") == k))
        else:
            store.insert(people(spark, 90).filter(F.col("k") == k))
            held[k] = (k % 97, f"p{k}")
        assert {r.k: (r.age, r.name) for r in store.read().collect()} == held


def test_an_update_writes_what_it_changes(spark):
    big = people(spark, 200_000).withColumn("text", F.sha2(F.col("name"), 512))
    store = merging.stored(big, "k", 8)
    before = store.bytes_stored()
    store.update({"k": {"$lt": 2000}}, {"$set": {"name": "x"}}, many=True)
    assert store.bytes_stored() - before < 0.03 * before
    before = store.bytes_stored()
    assert store.delete({"k": {"$lt": 2000}}, many=True) == 2000
    assert store.bytes_stored() - before < 0.01 * before
    assert store.count() == 198_000


def test_ids_are_looked_up_in_their_buckets(spark):
    store = merging.stored(people(spark), "k", 8)
    version = store.version()
    one = store._buckets_of(version, {"k": 17})
    plan = store.find({"k": 17})._jdf.queryExecution().executedPlan().toString()
    assert len(one) == 1 and f"(mr_bucket" in plan.split("PartitionFilters")[1][:400] and "EqualTo(k,17)" in plan
    many = people(spark, 4000).filter("k >= 2000")
    store.insert(many)
    assert store.count() == 4000
    with pytest.raises(ValueError, match="duplicate"):
        store.insert(people(spark, 6000).filter("k >= 3999"))
    with pytest.raises(ValueError, match="duplicate"):
        store.insert(people(spark, 6000).filter("k = 5000").union(people(spark, 6000).filter("k = 5000")))
    assert store.count() == 4000 and store.version().number == 1


def test_two_writers_conflict_and_readers_keep_their_version(spark):
    store = merging.stored(people(spark, 50), "k", 2)
    other = merging.MergedCollection(spark, store.root, "k")
    old, reading = other.version(), other.read()
    store.delete({"age": {"$lt": 10}}, many=True)
    with pytest.raises(merging.Conflict):
        other._commit(merging.replace(old, number=old.number + 1))
    assert reading.count() == 50 and other.read().count() == 40


def test_documents_nulls_and_empty(spark):
    store = merging.MergedCollection(spark)
    assert store.read().count() == 0 and store.delete({}, True) == 0 and store.compact() == 0
    assert store.update({"a": 1}, {"$set": {"b": 2}}) == {"matched_count": 0, "modified_count": 0, "upserted_count": 0}
    store.insert_many(spark.createDataFrame([('{"_id": "x", "a": 1}',), ('{"a": null}',), ("{}",)], "json_data string"))
    with pytest.raises(ValueError, match="x"):
        store.insert_one({"_id": "x"})
    assert store.update({"_id": "x"}, {"$set": {"a.b": 2}})["modified_count"] == 1
    assert store.update({"_id": "y"}, {"$set": {"a": 3}}, upsert=True)["upserted_count"] == 1
    assert store.count({"a": 3}) == 1 and store.count({"a.b": 2}) == 1 and store.count() == 4
    assert store.delete({"a.b": 2}) == 1 and store.count() == 3
    nulls = merging.stored(spark.createDataFrame([(None, 1), (None, 2), (3, 4)], "k int, v int"), "k", 2)
    assert nulls.delete({"v": 1}) == 0 and nulls.delete({"v": 1}, many=True) == 1 and nulls.count() == 2
    with pytest.raises(ValueError, match="reserved"):
        merging.stored(spark.createDataFrame([(1, 2)], "k int, mr_row int"), "k")
