import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from millrace.llm import draws, langid, mixing, queries, sharding
from tests.llm.overlap import brute
from tests.llm.test_near_copies import kept_ids


def test_hypergeometric_draws():
    rng = np.random.default_rng(1)
    got = [draws.hypergeometric(30, 70, 20, rng) for _ in range(4000)]
    assert abs(np.mean(got) - 6) < 0.1 and abs(np.var(got) - 20 * 0.3 * 0.7 * 80 / 99) < 0.3
    assert draws.hypergeometric(0, 5, 3, rng) == 0 and draws.hypergeometric(5, 0, 3, rng) == 3
    big = draws.hypergeometric(10**11, 9 * 10**11, 65536, rng)
    assert 5500 < big < 7600
    assert sum(draws.multivariate_hypergeometric([3, 0, 9, 4], 7, rng)) == 7


def test_matrix_and_tree_keep_their_sums():
    counts, sizes = [5, 0, 17, 9], [11, 10, 10]
    matrix = sharding.communication_matrix(counts, sizes, 3)
    assert [sum(m) for m in matrix] == counts and [sum(c) for c in zip(*matrix)] == sizes
    leaves = mixing.splitting_tree([7, 0, 20, 3], 5, 4)
    assert [sum(q) for q in zip(*leaves)] == [7, 0, 20, 3]
    assert [sum(q) for q in leaves] == [6] * 5


@pytest.mark.parametrize("cell", [7, 1 << 15])
def test_shards_against_brute_force(spark, sf_dir, monkeypatch, cell):
    monkeypatch.setattr(sharding, "CELL", cell)
    monkeypatch.setattr(sharding, "BLOCK", 50)
    docs = {r.doc_id: r.text for r in queries.table(spark, sf_dir, "documents").collect()}
    got = queries.QUERIES["op2_sharding"](spark, sf_dir).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    for r in got:
        data = docs[r.doc_id].encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(data) + 1, zlib.crc32(data), "rows", None)
    sizes = Counter(r.shard for r in got)
    assert set(sizes) == set(range(8)) and max(sizes.values()) - min(sizes.values()) <= 1
    for s in range(8):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sizes[s]))
    if cell != 7:
        by_id = [r.slot for r in sorted(got, key=lambda r: r.doc_id) if r.shard == 0]
        assert by_id != sorted(by_id)


def test_shards_of_odd_rows(spark):
    rows = [(1, None), (None, ""), (2, "é" * 30000), (2, "é" * 30000)]
    frame = spark.createDataFrame([(*r, 5, 6, "b") for r in rows], "doc_id long, text string, shard int, slot int, block string")
    out = sharding.shuffled(frame, 3)
    assert out.columns == ["doc_id", "text", "block", "shard", "slot"]
    assert sorted((str(r.doc_id), str(r.text)) for r in out.collect()) == sorted((str(a), str(b)) for a, b in rows)
    got = sharding.sharded_documents(frame, 3).collect()
    assert sorted(r["size"] for r in got) == [1, 1, 60001, 60001]
    assert sharding.shuffled(frame.limit(0), 3).count() == 0


def expected_targets(sizes):
    """Water level by bisection."""
    weights = {s: (1, 2, 3)[k % 3] for k, s in enumerate(sorted(sizes, key=lambda s: (s is None, s)))}
    total = sum(sizes.values())
    low, high = 0.0, 3.0 * total + 1
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if sum(min(mid * weights[s], 3 * sizes[s]) for s in sizes) < total else (low, mid)
    return {s: min(high * weights[s], 3 * sizes[s]) for s in sizes}


@pytest.mark.parametrize("block", [8, 1 << 12])
def test_mix_against_brute_force(spark, sf_dir, monkeypatch, block):
    monkeypatch.setattr(mixing, "BLOCK", block)
    docs = {r.doc_id: (len(re.findall(r"[^\x20\x09-\x0D]+", r.text)), r.source) for r in queries.table(spark, sf_dir, "documents").collect()}
    sizes = defaultdict(int)
    for size, source in docs.values():
        sizes[source] += size
    wanted = expected_targets(sizes)
    got = queries.QUERIES["op3_source_mixing"](spark, sf_dir).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    taken = defaultdict(int)
    for r in got:
        size, source = docs[r.doc_id]
        assert (r["size"], r.source_size) == (size, sizes[source]) and abs(r.target - wanted[source]) < 1e-3
        assert r.taken == size * r.copies and 0 <= r.copies <= 3 and len(r.shards or []) == r.copies
        taken[source] += r.taken
    largest = max(size for size, _ in docs.values())
    assert all(abs(taken[s] - wanted[s]) <= largest / 2 + 1 for s in sizes)
    again = queries.QUERIES["op3_source_mixing"](spark, sf_dir).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_mix_of_odd_rows(spark):
    rows = [(1, None, "a"), (2, "", "a"), (3, "x y", None), (3, "x y", None), (None, " p\tq\x0br ", "b"), (4, "w " * 5000, "b")]
    frame = spark.createDataFrame([(*r, 1, "t") for r in rows], "doc_id long, text string, source string, size int, tag string")
    got = sorted((str(r.doc_id), r["size"], r.source_size, r.taken) for r in mixing.mixed_documents(frame, 2).collect())
    assert [g[:3] for g in got] == [("1", 0, 0), ("2", 0, 0), ("3", 2, 4), ("3", 2, 4), ("4", 5000, 5003), ("None", 3, 5003)]
    assert sum(g[3] for g in got if g[0] == "3") == 12
    out = mixing.mixed_rows(frame, 2)
    assert out.columns == [*frame.columns, "mix_shard", "mix_order"]
    assert sum(r.doc_id == 3 for r in out.collect()) == 6
    assert mixing.mixed_rows(frame.limit(0), 2).count() == 0
    assert mixing.mixed_documents(frame.filter("text is null"), 2).first().taken == 0


def test_pipeline_against_brute_force(spark, sf_dir):
    docs = queries.table(spark, sf_dir, "documents")
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.columns == [*docs.columns, "shard", "slot"]
    got = out.collect()
    model = langid.fit(docs)
    rejected = {r.doc_id for r in langid.languages(docs, model).collect() if r.rejected}
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect() if r.doc_id not in rejected]
    kept = kept_ids([r[:2] for r in rows])
    rows = [r for r in rows if r[0] in kept]
    items = [r.text for r in queries.table(spark, sf_dir, "benchmark").collect()]
    dirty = {r[0] for r in rows if any(t in r[1] for t in items)}
    clean = {r[0]: r for r in rows if r[0] not in dirty}
    copies = Counter(r.doc_id for r in got)
    assert set(copies) <= set(clean) and max(copies.values()) <= 3
    short = [r for r in rows if r[0] in clean and len(r[1]) < 1500][:40]
    assert {short[d][0] for d, _ in brute([r[1] for r in short], items)}.isdisjoint(copies)
    sizes, taken = defaultdict(int), defaultdict(int)
    for d, text, source in clean.values():
        sizes[source] += len(text.split())
        taken[source] += copies[d] * len(text.split())
    wanted = expected_targets(sizes)
    largest = max(len(t.split()) for _, t, _ in rows)
    assert all(abs(taken[s] - wanted[s]) <= max(largest, 0.1 * wanted[s]) for s in sizes)
    counts = Counter(r.shard for r in got)
    assert max(counts.values()) - min(counts.values()) <= 1
    assert all(sorted(r.slot for r in got if r.shard == s) == list(range(counts[s])) for s in counts)
