import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from millrace.llm import graph, queries, simhash, tokens
from millrace.llm.graph import components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(rows):
    """(doc_id, fingerprint, component) by brute force."""
    prints = [fingerprint(t) for _, t in rows]
    values = sorted(set(prints))
    label = {v: v for v in values}

    def root(v):
        while label[v] != v:
            v = label[v]
        return v

    array = np.array(values, dtype=np.uint64)
    for i, v in enumerate(values):
        for j in np.flatnonzero(np.bitwise_count(array[:i] ^ array[i]) <= 3):
            label[root(v)] = root(values[j])
    least = {}
    for (d, _), p in zip(rows, prints):
        if d is not None:
            least[root(p)] = min(least.get(root(p), d), d)
    return sorted((str(d), f"{p:016x}", str(least.get(root(p)))) for (d, _), p in zip(rows, prints))


def found(frame):
    return sorted((str(r[0]), r[1], str(r[2])) for r in frame.select("doc_id", "fingerprint", "component_id").collect())


@pytest.mark.parametrize("limit", [40, 1 << 20])
def test_fingerprints_of_odd_texts(monkeypatch, limit):
    monkeypatch.setattr(tokens, "PIECE", limit)
    monkeypatch.setattr(simhash, "pieces", lambda t, i, o: tokens.pieces(t, i, o, limit))
    rng = random.Random(1)
    texts = [None, "", " \t", "a", "A b", "x\x0by z", "é É ß x   w", "w" * 300, "p " + "q" * 500 + " r s"]
    texts += [" ".join(rng.choice(["a", "Bc", "dé", "\n", "long" * rng.randint(1, 15)]) for _ in range(n)) for n in range(60)]
    got = simhash._text_bits(pa.array(texts)).view(np.uint64).tolist()
    assert got == [fingerprint(t) for t in texts]


def test_golay_code_is_perfect():
    table = simhash.golay_indices()
    words = [i << 11 | simhash._remainder(i << 11) for i in range(4096)]
    assert min(w.bit_count() for w in words[1:]) == 7
    rng = np.random.default_rng(2)
    for value in rng.integers(0, 1 << 22, 200):
        assert (int(value) ^ words[table[value]]).bit_count() <= 3


def test_links_miss_nothing(spark):
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(40)]
    values = {0, (1 << 64) - 1, *base}
    for v in base:
        for _ in range(25):
            w = v
            for bit in rng.sample(range(64), rng.randint(1, 4)):
                w ^= 1 << bit
            values.add(w)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    frame = spark.createDataFrame([(v,) for v in signed], "bits long")
    got = {(r.a, r.b) for r in simhash.links(frame).collect()}
    wanted = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 3}
    assert got == wanted


def test_components(spark):
    rng = random.Random(4)
    pairs = [(i, i + 1) for i in range(100, 160)] + [(500, j) for j in range(501, 560)]
    pairs += [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(60)] + [(7, 7), (8, None)]
    label = {}
    for a, b in pairs:
        if b is not None:
            label.setdefault(a, a), label.setdefault(b, b)
            x, y = label[a], label[b]
            label = {k: min(x, y) if v in (x, y) else v for k, v in label.items()}
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {k: v for k, v in label.items() if k != v}


def test_query_against_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in queries.table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    assert found(queries.QUERIES["op1_simhash_near_dedup"](spark, sf_dir)) == groups(rows)


def test_nulls_repeats_and_clashing_columns(spark):
    rows = [(3, "a b c d"), (3, "a b c d"), (None, "a b c d"), (5, None), (6, ""), (None, "lone words here now"), (1, "A  B c\td")]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, bits string, rank int")
    assert found(simhash.near_duplicates(frame)) == groups(rows)
    kept = simhash.keep_one_of_each(frame)
    assert kept.columns == frame.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "5", "None", "None"]
    empty = frame.limit(0)
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_one_of_each(empty).count() == 0


@pytest.mark.parametrize("pairs, tables, expected", [
    ([(1, 0), (2, 0), (5, 4)], 1, {1: 0, 2: 0, 5: 4}), ([(1, 0), (2, 1), (4, 3)], 3, {1: 0, 2: 0, 4: 3})])
def test_components_end_at_stars(spark, monkeypatch, pairs, tables, expected):
    """No round is run once only stars are left: its plans would stay with the driver."""
    labels, real = [], graph.staged
    monkeypatch.setattr(graph, "staged", lambda frame, label: labels.append(label) or real(frame, label))
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == expected and len(labels) == tables
