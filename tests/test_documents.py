"""The document calls of a user and a product collection, end to end."""

import json
import uuid

import pytest
from pyspark.sql import functions as F

from millrace.operators import documents as docs
from millrace.sources.collections import Collection, list_collections, list_databases

USERS = [
    {"_id": "1", "name": "John Doe", "email": "john@example.com", "age": 30, "city": "New York"},
    {"_id": "2", "name": "Alice", "email": "alice@example.com", "age": 25, "department": "Engineering"},
    {"_id": "3", "name": "Bob", "email": "bob@example.com", "age": 35, "department": "Marketing"},
]
PRODUCTS = [
    {"_id": "1", "name": "Laptop", "price": 999.99, "category": "Electronics", "stock": 10},
    {"_id": "2", "name": "Mouse", "price": 29.99, "category": "Electronics"},
    {"_id": "3", "name": "Book", "price": 19.99, "category": "Education", "stock": 50},
]


def texts(spark, items):
    return spark.createDataFrame([(json.dumps(i),) for i in items], "json_data string")


@pytest.fixture
def users(spark):
    store = Collection(spark, "testdb", f"users_{uuid.uuid4().hex}")
    store.insert_many(texts(spark, USERS))
    return store


@pytest.fixture
def products(spark):
    store = Collection(spark, "testdb", f"products_{uuid.uuid4().hex}")
    store.insert_many(texts(spark, PRODUCTS))
    return store


def names(df):
    return [json.loads(r["json_data"]).get("name") for r in docs.render_json(df).collect()]


def test_reads(users):
    assert sorted(names(users.find())) == ["Alice", "Bob", "John Doe"]
    assert sorted(names(users.find({"age": {"$gt": 25}}))) == ["Bob", "John Doe"]
    assert names(users.find(sort={"age": -1})) == ["Bob", "John Doe", "Alice"]
    assert names(users.find(sort={"department": 1, "age": 1})) == ["John Doe", "Alice", "Bob"]
    assert names(users.find(sort={"age": 1}, skip=1, limit=1)) == ["John Doe"]
    assert names(users.find(sort={"age": 1}, skip=1)) == ["John Doe", "Bob"]
    assert len(names(users.find(limit=5))) == 3
    assert len(names(users.find(sort="{broken"))) == 3
    assert users.count() == 3 and users.count({"age": {"$gte": 30}}) == 2
    assert users.count({"department": {"$regex": "Engineering"}}) == 1
    assert users.count({"department": {"$regex": "engin", "$options": "i"}}) == 1
    assert names(users.find({"_id": "2"})) == ["Alice"]


def test_filters_compare_like_with_like(spark):
    rows = docs.from_json_text(
        spark.createDataFrame(
            list(enumerate(['{"a":1}', '{"a":"1"}', '{"a":null}', "{}", '{"a":[1,2]}', '{"a":1.5}', '{"a":{"b":1}}'])),
            "_id int, t string",
        ),
        "_id", "t",
    )

    def ids(query):
        return [r["_id"] for r in docs.matching(rows, query).orderBy("_id").collect()]

    assert ids({"a": 1}) == [0, 4]
    assert ids({"a": "1"}) == [1]
    assert ids({"a": None}) == [2, 3]
    assert ids({"a": {"$gt": 1}}) == [4, 5]
    assert ids({"a": {"$ne": 1}}) == [1, 2, 3, 5, 6]
    assert ids({"a": {"$nin": [1, "1"]}}) == [2, 3, 5, 6]
    assert ids({"a": {"$exists": True}}) == [0, 1, 2, 4, 5, 6]
    assert ids({"a": {"$not": {"$gte": 1}}}) == [1, 2, 3, 6]
    assert ids({"a.b": 1}) == [6]
    assert ids({"a": {"b": 1}}) == [6]
    assert ids({"$or": [{"a": "1"}, {"a": {"$lt": 1.6}}]}) == [0, 1, 4, 5]
    with pytest.raises(ValueError, match="near"):
        docs.matching(rows, {"a": {"$near": 1}})
    with pytest.raises(ValueError, match="nor"):
        docs.matching(rows, {"$nor": []})


def test_updates(users):
    assert users.update({"name": "John Doe"}, {"$set": {"age": 31, "status": "updated"}}) == {
        "matched_count": 1, "modified_count": 1, "upserted_count": 0
    }
    again = users.update({"name": "John Doe"}, {"$set": {"age": 31}})
    assert again == {"matched_count": 1, "modified_count": 0, "upserted_count": 0}
    made = users.update({"name": "Jane Doe"}, {"$set": {"age": 28, "email": "jane@example.com"}}, upsert=True)
    assert made == {"matched_count": 0, "modified_count": 0, "upserted_count": 1}
    assert users.count({"name": "Jane Doe", "age": 28}) == 1
    many = users.update('{"age": {"$gte": 30}}', '{"$set": {"category": "senior"}}', many=True)
    assert many["modified_count"] == 2
    one = users.update({"category": "senior"}, {"$set": {"first": True}})
    assert one["matched_count"] == 1 and users.count({"first": True, "_id": "1"}) == 1
    with pytest.raises(ValueError, match="mul"):
        users.update({}, {"$mul": {"age": 1}})


def test_deletes(products):
    assert products.delete({"name": "Mouse"}) == 1
    assert products.delete({"price": {"$lt": 50}}, many=True) == 1
    assert names(products.find()) == ["Laptop"]
    assert products.delete({"stock": {"$gt": 100}}, many=True) == 0
    assert products.delete({}, many=True) == 1 and products.count() == 0


def test_inserts(spark, users):
    users.insert_one({"name": "Eve"})
    assert users.count({"name": "Eve"}) == 1 and users.find({"name": "Eve"}).first()["_id"]
    with pytest.raises(ValueError):
        users.insert_one("[1]")
    with pytest.raises(Exception, match="invalid JSON document"):
        users.insert_many(spark.createDataFrame([('{"name":"ok"}',), ("nope",)], "json_data string"))
    assert users.count({"name": "ok"}) == 0


def test_deleting_keeps_rows_with_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, 5.0), (3, 50.0)], "_id int, price double")
    left = docs.delete(df, {"price": {"$lt": 10}}, many=True)
    assert sorted(r["_id"] for r in left.collect()) == [1, 3]
    wide = docs.update(df, {"_id": 2}, {"$set": {"tag": "x"}}).rows
    assert {r["_id"]: r["tag"] for r in wide.collect()} == {1: None, 2: "x", 3: None}


def test_listings(spark, users):
    listed = {r["name"]: r["type"] for r in list_collections(spark, "testdb").collect()}
    assert listed[users.name] == "external"
    testdb = list_databases(spark).filter(F.col("name") == "testdb").first()
    assert not testdb["empty"] and testdb["size_on_disk"] > 0
    with pytest.raises(ValueError):
        list_collections(spark, "")
    with pytest.raises(ValueError):
        Collection(spark, "testdb", "")


def test_ids_and_single_rows(spark):
    store = Collection(spark, "iddb", "people")
    for _ in range(2):
        store.insert_one({"name": "same"})
    assert len({r["_id"] for r in store.read().collect()}) == 2
    files = set(store.read().inputFiles())
    store.insert_one({"_id": "own", "name": "x"})
    assert files < set(store.read().inputFiles())
    with pytest.raises(ValueError, match="own"):
        store.insert_one({"_id": "own"})
    assert store.delete({"name": "same"}) == 1 and store.count() == 2
    twice = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "k int, v string")
    assert docs.delete(twice, {}, id_column="k").count() == 2
    assert docs.deleted_count(twice, {"v": "c"}, id_column="k").first()[0] == 0


def test_text_order_and_deep_skip(spark):
    names = ["John Doe", "John!", "John", "Jo", "5", "é"]
    held = docs.from_json_text(
        spark.createDataFrame([(str(i), f'{{"n": "{n}"}}') for i, n in enumerate(names)] + [("9", '{"n": 10}'), ("8", "{}")], "i string, j string"), "i", "j")
    got = [docs.render_json(docs.find(held, sort={"n": 1})).collect()]
    order = [r["_id"] for r in docs.find(held, sort={"n": 1}).collect()]
    assert got and order == ["8", "9", "4", "3", "2", "0", "1", "5"]
    rows = spark.createDataFrame([(None, 1), (None, 2), (7, 3), (7, 4)], "id int, v int")
    for skip in range(6):
        left = docs.find(rows, sort={"v": 1}, skip=skip, id_column="id").collect()
        assert [r["v"] for r in left] == [1, 2, 3, 4][skip:]
    wide = spark.range(5000).repartition(7)
    assert [r["id"] for r in docs.find(wide, sort={"id": -1}, skip=4321, id_column="id").collect()] == list(range(678, -1, -1))


def test_array_and_number_operators(spark):
    texts = ['{"a": [1, 2], "n": 9}', '{"a": [2], "n": -5}', '{"a": 2, "n": 9.7}', '{"n": "9"}', '{"a": [], "n": 1e300}']
    rows = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "i string, j string")
    held = docs.from_json_text(rows, "i", "j")
    ids = lambda q: sorted(r["_id"] for r in docs.matching(held, q).collect())
    assert ids({"a": {"$all": [1, 2]}}) == ["0"] and ids({"a": {"$all": [2]}}) == ["0", "1", "2"]
    assert ids({"a": {"$all": []}}) == []
    assert ids({"a": {"$size": 0}}) == ["4"] and ids({"a": {"$size": 1}}) == ["1"]
    assert ids({"n": {"$mod": [4, 1]}}) == ["0", "2"] and ids({"n": {"$mod": [4, -1]}}) == ["1"]
    assert ids({"$nor": [{"a": {"$size": 2}}, {"n": {"$lt": 0}}]}) == ["2", "3", "4"]
    typed = spark.createDataFrame([([1, 2], 7.5), ([], float("inf")), (None, None)], "a array<int>, n double")
    assert docs.matching(typed, {"a": {"$size": 2}}).count() == 1
    assert docs.matching(typed, {"n": {"$mod": [7, 0]}}).count() == 1
    with pytest.raises(ValueError, match="divisor"):
        docs.matching(typed, {"n": {"$mod": [0, 0]}})


def stored(df, name):
    return [json.loads(r["json_data"]) for r in docs.render_json(df).collect() if json.loads(r["json_data"]).get("name") == name][0]


def test_update_operators(users):
    change = {"$inc": {"age": 2, "visits": 1, "score": 0.5}, "$unset": {"city": "", "no.such": ""},
              "$push": {"tags": "x", "more": {"$each": [1, "b", None]}}, "$set": {"a.b": 1}}
    assert users.update({"_id": "1"}, change)["modified_count"] == 1
    users.update({"_id": "1"}, {"$push": {"tags": {"k": 1}}, "$unset": {"a.b": 1}, "$inc": {"score": 1}})
    john = stored(users.read(), "John Doe")
    assert john["age"] == 32 and john["visits"] == 1 and john["score"] == 1.5 and "city" not in john
    assert john["tags"] == ["x", {"k": 1}] and john["more"] == [1, "b", None] and john["a"] == {}
    assert users.update({"_id": "2"}, {"$unset": {"city": ""}}) == {
        "matched_count": 1, "modified_count": 0, "upserted_count": 0}
    done = users.update({"name": "New", "age": 5}, {"$inc": {"age": 1, "n": 3}, "$push": {"t": 1}}, upsert=True)
    assert done["upserted_count"] == 1
    new = stored(users.read(), "New")
    assert (new["age"], new["n"], new["t"]) == (6, 3, [1])
    for bad in ({"$inc": {"name": 1}}, {"$push": {"age": 1}}):
        with pytest.raises(Exception, match=r"\$inc needs|\$push needs"):
            users.update({"_id": "1"}, bad)
    for bad in ({"$inc": {"a": "1"}}, {"$set": {"a": 1}, "$inc": {"a.b": 1}}, {"$mul": {"a": 2}}, {}):
        with pytest.raises(ValueError):
            users.update({"_id": "1"}, bad)


def test_type_and_element_filters(spark):
    items = [
        {"_id": "1", "v": 1, "list": [1, 5, 9], "subs": [{"a": 1, "b": 2}, {"a": 3, "b": 0}]},
        {"_id": "2", "v": 1 << 40, "list": [2, "x"], "subs": [{"a": 1, "b": 0}]},
        {"_id": "3", "v": 1.5, "list": [], "subs": [1, 2]},
        {"_id": "4", "v": "t", "list": 5, "subs": {"a": 1, "b": 2}},
        {"_id": "5", "v": None},
        {"_id": "6", "v": [True, {"z": 1}]},
    ]
    rows = docs.parsed(texts(spark, items), "string")

    def hits(query):
        return "".join(sorted(r["_id"] for r in docs.find(rows, query).collect()))

    assert [hits({"v": {"$type": t}}) for t in ("int", 18, "double", "string", "null", "array", "bool", "object", "number")] == [
        "1", "2", "3", "4", "5", "6", "6", "6", "123"]
    assert hits({"v": {"$type": [2, "null"]}}) == "45" and hits({"v": {"$not": {"$type": "number"}}}) == "456"
    assert hits({"list": {"$elemMatch": {"$gt": 3, "$lt": 8}}}) == "1"
    assert hits({"list": {"$elemMatch": {"$type": "string"}}}) == "2"
    assert hits({"subs": {"$elemMatch": {"a": 1, "b": {"$gte": 2}}}}) == "1"
    assert hits({"subs": {"$elemMatch": {"$or": [{"a": 3}, {"b": 0}]}}}) == "12"
    assert hits({"subs": {"$elemMatch": {"zz": None}}}) == "12"
    with pytest.raises(ValueError):
        docs.find(rows, {"v": {"$type": "nonsense"}})
    typed = spark.createDataFrame([(1, [1, 2], [(1, "a")]), (2, None, [(2, "b")])], "_id int, xs array<int>, ss array<struct<n:int,t:string>>")
    assert [r[0] for r in docs.find(typed, {"xs": {"$elemMatch": {"$gte": 2}}}).collect()] == [1]
    assert [r[0] for r in docs.find(typed, {"ss": {"$elemMatch": {"n": 2, "t": "b"}}}).collect()] == [2]
    assert [r[0] for r in docs.find(typed, {"xs": {"$type": "int"}}).collect()] == [1]
