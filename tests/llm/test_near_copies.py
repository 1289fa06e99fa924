import random
import re

import pyarrow as pa
import pytest
import xxhash

from millrace.llm import near_copies, queries, tokens

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text, n=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def kept_ids(rows, least=0.8):
    """Ids of the documents that stay, by comparing all pairs."""
    sets = [shingle_set(t) for _, t in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            alike = (rows[i][1] or "") == (rows[j][1] or "")
            if alike or (a and len(a & sets[j]) >= least * len(a | sets[j])):
                label[root(i)] = root(j)
    best = {}
    for i, (d, _) in enumerate(rows):
        best[root(i)] = min(best.get(root(i), d), d)
    return set(best.values())


@pytest.mark.parametrize("limit", [40, 1 << 20])
def test_wide_fingerprints(monkeypatch, limit):
    monkeypatch.setattr(tokens, "PIECE", limit)
    monkeypatch.setattr(tokens.pieces, "__defaults__", (limit, True))
    texts = [None, "", " \t", "One", "one two", "a b c d", "é ü ß x " * 9, " ".join(str(i % 400) for i in range(1500)), "w " * 700]
    bits, count = near_copies._wide_bits(pa.array(texts), 3, 5)
    for text, got, n in zip(texts, bits, count):
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        runs = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        assert n == len(runs)
        for word in range(5):
            hashes = []
            for s in runs:
                z = (xxhash.xxh64_intdigest(s, seed=42) + (word + 1) * 0x9E3779B97F4A7C15) % (1 << 64)
                z = (z ^ z >> 30) * 0xBF58476D1CE4E5B9 % (1 << 64)
                z = (z ^ z >> 27) * 0x94D049BB133111EB % (1 << 64)
                hashes.append(z ^ z >> 31)
            assert int(got[word]) == sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > n)


def test_documents_against_all_pairs(spark, sf_dir):
    docs = queries.table(spark, sf_dir, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    kept = near_copies.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(kept_ids(rows))


def edited(words, rng, share, kind):
    words = list(words)
    count = max(1, round(share * len(words)))
    if kind == "cut":
        return words[count:]
    for at in rng.sample(range(len(words)), count):
        words[at] = f"new{rng.randrange(10**6)}"
    return words


def test_recall_by_similarity(spark):
    """Pairs of random texts at a similarity of 0.8 to 0.95: at least nine in ten are found, none below 0.8."""
    rng = random.Random(3)
    rows, similarity = [], {}
    for k in range(400):
        base = [f"w{int(rng.paretovariate(0.7)) % 5000}" for _ in range(rng.randrange(120, 400))]
        kind = "cut" if k % 4 == 0 else "words"
        share = rng.uniform(0.02, 0.22) if kind == "cut" else rng.uniform(0.003, 0.03)
        one, two = " ".join(base), " ".join(edited(base, rng, share, kind))
        a, b = shingle_set(one), shingle_set(two)
        similarity[k] = len(a & b) / len(a | b)
        rows += [(2 * k, one), (2 * k + 1, two)]
    kept = {r.doc_id for r in near_copies.keep_one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    alike = [k for k, s in similarity.items() if s >= 0.8]
    missed = [k for k in alike if 2 * k + 1 in kept]
    assert len(alike) > 200 and len(missed) <= 0.05 * len(alike)
    assert all(2 * k + 1 in kept for k, s in similarity.items() if s < 0.8)
    assert all(2 * k in kept for k in similarity)


def test_chain_and_dense_group(spark):
    """A chain links its ends through its middle; a group of many near copies leaves one."""
    rng = random.Random(5)
    base = [f"v{i}" for i in range(200)]
    rows, words = [], base
    for k in range(6):
        rows.append((100 - k, " ".join(words)))
        words = words[5:] + [f"x{k}_{i}" for i in range(5)]
    other = [f"u{i}" for i in range(150)]
    rows += [(1000 + k, " ".join(edited(other, rng, 0.007, "words"))) for k in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in near_copies.keep_one_of_each(frame).collect()) == sorted(kept_ids(rows)) == [95, 1000]


def test_odd_rows(spark):
    long = "lorem ipsum dolor sit amet " * 20_000
    rows = [(1, None), (2, ""), (3, " \n"), (4, "A b"), (5, "a  B"), (6, "a c"), (7, "same id"), (7, "other text here"),
            (None, "a b"), (None, "alone without id"), (8, long), (9, long + "end"), (8, long), (8, long)]
    frame = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], "doc_id long, text string, node int, digest string, row string")
    kept = near_copies.keep_one_of_each(frame)
    assert kept.columns == frame.columns
    got = sorted((str(r.doc_id), (r.text or "")[:16]) for r in kept.collect())
    assert got == sorted([("1", ""), ("3", " \n"), ("4", "A b"), ("6", "a c"), ("7", "same id"), ("7", "other text here"),
                          ("None", "alone without id"), ("8", long[:16])])
    empty = frame.limit(0)
    assert near_copies.keep_one_of_each(empty).count() == 0 and near_copies.near_copies(empty).count() == 0
    assert near_copies.keep_one_of_each(frame.filter("text is null")).count() == 1


def bits_apart(a, b):
    return sum(((a[c] ^ b[c]) & (1 << 64) - 1).bit_count() for c in ("check0", "check1"))


def test_chance_meetings_leave(spark, sf_dir, monkeypatch):
    """What is kept of a key of few rows is like another row of it, so that it does not grow with the square of the texts."""
    seen, real = {}, near_copies.staged

    def watched(frame, label):
        seen[label] = real(frame, label)
        return seen[label]

    monkeypatch.setattr(near_copies, "staged", watched)
    near_copies.keep_one_of_each(queries.table(spark, sf_dir, "documents")).count()
    for label, other in ("copy-met", None), ("copy-able", "component"):
        keys = {}
        for row in seen[label][0].collect():
            keys.setdefault(row.key, []).append(row)
        assert keys
        for rows in keys.values():
            assert len(rows) > 1
            for a in rows if len(rows) <= 8 else ():
                near = [b for b in rows if b.node != a.node and bits_apart(a, b) <= near_copies.CHECKED]
                assert any(other is None or a[other] != b[other] for b in near)


def test_rows_of_a_key_against_all_pairs(spark):
    rng = random.Random(7)
    rows, node = [], 0
    for key in range(60):
        size = rng.choice([1, 2, 3, 8, 9, 30])
        base = [rng.getrandbits(64) for _ in range(2)]
        for _ in range(size):
            flips = [sum(1 << b for b in rng.sample(range(64), rng.choice([4, 9, 17]))) for _ in range(2)]
            words = [w ^ f for w, f in zip(base, flips)] if rng.random() < 0.4 else [rng.getrandbits(64) for _ in range(2)]
            words = [w - (1 << 64) if w >> 63 else w for w in words]
            rows.append((key, node, *words, rng.randrange(2), size))
            node += 1
    frame = spark.createDataFrame(rows, "key long, node long, check0 long, check1 long, component long, n long")
    plain = [dict(zip(frame.columns, r)) for r in rows]
    for differ in (), ("component",):
        got = {r.node for r in near_copies._alike(frame, *differ).collect()}
        expected = {a["node"] for a in plain if a["n"] > near_copies.FEW or any(
            a["node"] != b["node"] and bits_apart(a, b) <= near_copies.CHECKED and (not differ or a["component"] != b["component"])
            for b in plain if b["key"] == a["key"])}
        assert got == expected and 0 < len(got) < len(rows)


def test_group_without_links(spark, monkeypatch):
    """Texts that are alike but below the similarity are told apart before their sets are compared, whatever they share with others."""
    rng = random.Random(9)
    base = [f"v{i}" for i in range(150)]
    rows = []
    for k in range(150):
        words = list(base)
        for at in rng.sample(range(3, 150, 6), 3):
            words[at] = f"new{at}"
        rows.append((k, " ".join(words)))
    pairs, real = [], near_copies.staged

    def watched(frame, label):
        found = real(frame, label)
        if label == "copy-pairs":
            pairs.append(found[0].count())
        return found

    monkeypatch.setattr(near_copies, "staged", watched)
    kept = near_copies.keep_one_of_each(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(kept_ids(rows))
    sets = [shingle_set(t) for _, t in rows]
    nearly = sum(len(a & b) >= 0.7 * len(a | b) for i, a in enumerate(sets) for b in sets[:i])
    assert pairs[-1] < nearly < len(rows) ** 2 / 5


def test_bound_of_what_is_in_common(spark):
    """No pair has more in common than the bitmaps say, and they say little more."""
    rng = random.Random(11)
    sets = [rng.sample(range(400), rng.choice([3, 90, 300])) for _ in range(30)]
    scattered = [rng.getrandbits(64) - (1 << 63) for _ in range(400)]
    rows = [(k, [scattered[i] for i in s]) for k, s in enumerate(sets)]
    frame = spark.createDataFrame(rows, "node long, shingles array<long>")
    verifier = near_copies._Verifier(None, None, 5, 0.8)
    verifier.sets, verifier.fill = frame, lambda nodes: None
    shared = near_copies._shared(frame.select("node"), verifier)
    other = shared.select(*[near_copies.F.col(c).alias("few_" + c) for c in shared.columns])
    bound = near_copies.F.least(near_copies._in_common("", "few_"), near_copies._in_common("few_", ""))
    got = shared.crossJoin(other).select("node", "few_node", bound.alias("bound")).collect()
    assert len(got) == len(sets) ** 2
    for r in got:
        common = len(set(sets[r.node]) & set(sets[r.few_node]))
        assert common <= r.bound <= min(len(sets[r.node]), len(sets[r.few_node]))
    assert sum(r.bound for r in got) < 1.5 * sum(len(set(sets[r.node]) & set(sets[r.few_node])) for r in got)
