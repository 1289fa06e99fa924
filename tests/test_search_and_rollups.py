"""Text search against plain Python, sketches against exact counts, deep pages."""

import math
import re
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.operators import documents as docs
from millrace.operators import text_search
from millrace.plans import rollups

TEXTS = {1: "The old town, the sea", 2: "Old old TOWN hall", 3: "sea of red", 4: None, 5: "", 6: "été Été old", 7: "town old",
         8: "x " * 5000 + "sea"}


def brute(search, texts):
    words = {i: [w.translate({c: c + 32 for c in range(65, 91)}) for w in re.findall(text_search.TERM, t)] for i, t in texts.items() if t is not None}
    n, mean = len(words), sum(map(len, words.values())) / len(words)
    found = {}
    for i, ws in words.items():
        times, line = Counter(ws), f" {' '.join(ws)} "
        if any(t in times for t in search.without) or not any(t in times for t in search.terms):
            continue
        if not all(f" {' '.join(p)} " in line for p in search.phrases):
            continue
        total = 0.0
        for t in search.terms:
            d = sum(t in v for v in words.values())
            if times[t]:
                total += math.log(1 + (n - d + 0.5) / (d + 0.5)) * times[t] * 2.2 / (times[t] + 1.2 * (0.25 + 0.75 * len(ws) / mean))
        found[i] = round(total, 9)
    return found


@pytest.mark.parametrize("text", ["old", "Old TOWN", "sea -red", '"old town"', '"old town" sea', "ÉTÉ", "nothing", "", "-old", "a-b old"])
def test_scores(spark, text):
    rows = spark.createDataFrame(list(TEXTS.items()) + [(None, "old")], "id int, t string")
    index = text_search.TextIndex.build(rows, "id", "t")
    got = {r["id"]: round(r["score"], 9) for r in index.find(rows, {"$text": {"$search": text}}).collect()}
    assert got == brute(text_search.parsed(text), TEXTS)
    some = index.find(rows, {"id": {"$lt": 3}, "$text": {"$search": text}}).count()
    assert some == sum(i < 3 for i in got)


def test_index_of_nothing_and_sorted_postings(spark):
    none = spark.createDataFrame([], "id int, t string")
    index = text_search.TextIndex.build(none, "id", "t")
    assert index.find(none, {"$text": {"$search": "a"}}).count() == 0
    with pytest.raises(ValueError, match="score"):
        index.find(none.withColumn("score", F.lit(1)), {"$text": {"$search": "a"}})
    many = spark.range(3000).select(F.col("id"), F.concat(F.lit("common w"), F.col("id")).alias("t"))
    index = text_search.TextIndex.build(many, "id", "t")
    plan = index.postings().filter("term = 'w17'")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(term,w17)" in plan
    files = index.postings().groupBy(F.input_file_name()).agg(F.min("term").alias("a"), F.max("term").alias("b")).orderBy("a").collect()
    assert all(x["b"] <= y["a"] for x, y in zip(files, files[1:]))


def test_rollups_merge_within_their_bounds(spark):
    rows = spark.range(60_000).select(
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 7).alias("ts"), (F.col("id") % 2).cast("string").alias("kind"),
        (F.col("id") % 5_000).alias("user"), F.rand(3).alias("value"))
    rows = rows.cache()
    hours = rollups.rolled_up(rows, "ts", "kind", "user", "value", "1 hour")
    days = rollups.merged(hours, "1 day")
    got = {(r["window_start"], r["group"]): r for r in rollups.readings(days, [0.1, 0.5, 0.9]).collect()}
    exact = rows.groupBy(F.window("ts", "1 day")["start"].alias("d"), "kind").agg(
        F.count("*").alias("n"), F.count_distinct("user").alias("u"),
        F.percentile("value", F.array(F.lit(0.1), F.lit(0.5), F.lit(0.9))).alias("q"))
    rows_ = exact.collect()
    assert len(got) == len(rows_) > 8
    for r in rows_:
        e = got[r["d"], r["kind"]]
        assert e["events"] == r["n"] and abs(e["distinct_users"] - r["u"]) <= 0.06 * r["u"]
        assert all(abs(a - b) < 0.03 for a, b in zip(e["quantiles"], r["q"]))
    assert rollups.merged(hours.filter("false"), "1 day").count() == 0


@pytest.mark.parametrize("skip, limit", [(0, 5), (10, 7), (95, 20), (200, 3)])
def test_deep_pages(spark, monkeypatch, skip, limit):
    rows = spark.range(100).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v")).repartition(5)
    want = [r.k for r in docs.find(rows, sort={"v": 1}, skip=skip, limit=limit, id_column="k").collect()]
    monkeypatch.setattr(docs, "PAGE", 1)
    assert [r.k for r in docs.find(rows, sort={"v": 1}, skip=skip, limit=limit, id_column="k").collect()] == want


def test_a_long_text_is_read_in_linear_time(spark):
    """A text of 300,000 words."""
    rows = spark.range(1).select("id", F.concat(F.repeat(F.lit("sea, "), 300_000), F.lit("Old  Town")).alias("t"))
    start = time.perf_counter()
    index = text_search.TextIndex.build(rows, "id", "t")
    assert index.find(rows, {"$text": {"$search": '"sea old town"'}}).count() == 1
    assert index.find(rows, {"$text": {"$search": '"sea town"'}}).count() == 0
    assert time.perf_counter() - start < 40


@pytest.mark.parametrize("phrase", ["ab cd", "ab", "é ab", "cd.ab"])
def test_phrases_against_the_terms(spark, phrase):
    texts = ["ab cd", "AB--cd!", "xab cd", "ab cdx", "ab ab cd", "cd ab", "é,ab", "éab", "x é ab\ncd", "", "ab\ncd\n", "Écd"]
    (wanted,) = text_search.parsed(f'"{phrase}"').phrases
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    test = F.rlike("t", F.lit(text_search.phrase_test(wanted)))
    held = lambda t: f" {' '.join(wanted)} " in f" {' '.join(text_search._terms(t))} "
    assert {r.t for r in rows.filter(test).collect()} == {t for t in texts if held(t)}
    assert all(r.w == text_search._terms(r.t) for r in rows.select("t", text_search.words(F.col("t")).alias("w")).collect())
