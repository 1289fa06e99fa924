import random

import numpy as np
import pyarrow as pa

from millrace.llm import decontam, queries, tokens
from tests.llm.overlap import brute


def run(spark, docs, items):
    frame = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = decontam.judged(frame, bench).collect()
    assert sorted(r.doc_id for r in got) == list(range(len(docs)))
    assert all(r.contaminated == (r["items"] is not None) for r in got)
    return {(r.doc_id, i) for r in got for i in r["items"] or []}


def test_against_every_offset(spark):
    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(300)] + ["été", "Über"]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [text(n) for n in (3, 5, 9, 12, 13, 25, 40, 40, 60, 0)]
    docs = []
    for k in range(160):
        item = list(rng.choice(items))
        for _ in range(rng.randint(0, max(1, len(item) // 3))):
            if item:
                item[rng.randrange(len(item))] = rng.choice(vocabulary)
        cut = item[rng.randint(0, len(item) // 2):] if k % 3 == 0 else item
        docs.append(text(rng.randint(0, 40)) + cut + text(rng.randint(0, 40)))
    joined = [rng.choice([" ", ", ", "\n"]).join(d) for d in docs] + [None, "", "..."]
    lines = [" ".join(i).upper() for i in items]
    expected = brute(joined, lines)
    assert len(expected) > 60
    assert run(spark, joined, lines) == expected


def test_long_texts_in_pieces():
    """Every seed comes with all tokens around it, wherever a text is cut."""
    rng = random.Random(6)
    text = " ".join(rng.choice("abcdefgh") * rng.randint(1, 4) for _ in range(900))
    whole = decontam._whole(pa.array([text]))[0].view(np.int64)
    column = pa.record_batch([pa.array([1, 3, 5]), pa.array([2, 4, 6]), pa.array([text, None, "a b"])], ["k1", "k2", "text"])
    seeds = {m: decontam._seeds(whole.view(np.uint64), m) for m in decontam.MASKS}
    for chosen in (slice(None, None, 97), slice(None)):
        have = np.zeros(1 << 14, dtype=np.uint64)
        for s in np.concatenate([s[chosen] for s in seeds.values()]).tolist():
            for half in (s, s >> 32):
                have[(half & (1 << 20) - 1) >> 6] |= np.uint64(1 << (half & 63))
        bits = type("B", (), {"value": have})
        for limit in (64, 1000, 1 << 20):
            cut = lambda t, i, o: tokens.pieces(t, i, o, limit)  # noqa: E731,B023
            real, decontam.pieces = decontam.pieces, cut
            try:
                got = [r for b in decontam._segment_batches(decontam.MASKS, bits)([column]) for r in b.to_pylist()]
            finally:
                decontam.pieces = real
            full = set()
            for r in got:
                low = r["segment"]
                assert (r["k1"], r["k2"]) == (1, 2) and r["tokens"] == whole[low:low + len(r["tokens"])].tolist()
                for seed, place in zip(r["seeds"], r["places"]):
                    at = low + place
                    if low <= max(0, at - 24) and low + len(r["tokens"]) >= min(900, at + 36):
                        full.add((seed, at))
            for s in seeds.values():
                for at in range(len(s))[chosen]:
                    assert (int(s.view(np.int64)[at]), at) in full


def test_query_and_stage(spark, sf_dir):
    docs, bench = queries.table(spark, sf_dir, "documents"), queries.table(spark, sf_dir, "benchmark")
    texts = [r.text for r in docs.orderBy("doc_id").collect()]
    ids = [r.doc_id for r in docs.orderBy("doc_id").collect()]
    items = [(r.item_id, r.text) for r in bench.collect()]
    expected = {(ids[d], items[i][0]) for d, i in brute(texts[:60], [t for _, t in items])}
    got = queries.QUERIES["op7_benchmark_decontamination"](spark, sf_dir).collect()
    first = set(ids[:60])
    assert {(r.doc_id, i) for r in got for i in r["items"] or [] if r.doc_id in first} == expected
    planted = {r.doc_id for r in docs.collect() for _, t in items if t in r.text}
    assert planted <= {r.doc_id for r in got if r.contaminated}
    kept = decontam.without_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in got if not r.contaminated)


def test_odd_rows(spark):
    long = " ".join(f"x{k}" for k in range(40))
    rows = [(1, long), (1, long), (None, long), (2, None), (3, "")]
    docs = spark.createDataFrame([(*r, 9, "s") for r in rows], "doc_id long, text string, k1 int, items string")
    bench = spark.createDataFrame([(None, long), (4, long), (4, long), (5, None)], "item_id long, text string")
    got = decontam.judged(docs, bench).collect()
    assert sorted((str(r.doc_id), r.contaminated, str(r["items"])) for r in got) == sorted(
        [("1", True, "[4]")] * 2 + [("None", True, "[4]"), ("2", False, "None"), ("3", False, "None")])
    kept = decontam.without_contaminated(docs, bench)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3]
    assert decontam.judged(docs, bench.limit(0)).filter("contaminated").count() == 0
    assert decontam.judged(docs.limit(0), bench).count() == 0
