"""The divergence audit against sums over all terms in plain Python."""

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa

from millrace.llm import divergence

TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, source string, term string, n long"
UPPER = {c: c + 32 for c in range(65, 91)}


def brute(rows, min_docs, top):
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        words = [w.translate(UPPER) for w in TERM.findall(text or "")]
        counts[lang, source].update(words)
        docs[lang].update(set(words))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        sources = [s for g, s in groups if g == lang]
        v = len(kept)

        def share(names):
            n = {t: sum(counts[lang, s][t] for s in names) for t in kept}
            total = sum(n.values())
            return {t: 1 + 10**9 * (n[t] + 5) // (total + 5 * v) for t in kept}

        q = share(sources)
        p = {s: share([s]) for s in sources}
        for s in sources:
            pair = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in sources if o != s]
            term = [(q[t] - p[s][t], t.encode(), t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, items in (("pair", sorted(pair)), ("term", sorted(term)[:top])):
                out += [(lang, s, part, name, -value, rank) for rank, (value, _, name) in enumerate(items, 1)]
    return sorted(out)


def run(spark, rows, min_docs, top):
    df = spark.createDataFrame([(i, *r, "a", 1) for i, r in enumerate(rows)], SCHEMA)
    return sorted(tuple(r) for r in divergence.audit(df.repartition(5), min_docs, top).collect())


def test_against_all_terms(spark):
    rng = random.Random(1)
    words = [f"{a}{b}" for a in "abcdefgh" for b in ("x", "Y", "é", "Ωmega", "日本")]
    rows = []
    for i in range(400):
        source = rng.choice(["s0", "s0", "s0", "s1", "s2", "s3", "é", None])
        size = rng.choice([0, 1, 5, 30])
        few = words[: rng.choice([5, 12, 40])]
        rows.append((" ".join(rng.choice(few) + rng.choice(["", ".", "1", "\n", "_"]) for _ in range(size)),
                     rng.choice(["en", "en", "en", "de", None]), source))
    rows += [(None, "en", "quiet"), ("", "en", ""), ("123 456", "fr", "a"), ("one two", "fr", "b"), (None, None, None)]
    assert run(spark, rows, 3, 4) == brute(rows, 3, 4)
    assert run(spark, rows, 1, 1000) == brute(rows, 1, 1000)


def test_no_kept_terms_and_no_rows(spark):
    rows = [("a b", "en", "x"), ("b c", "en", "y"), ("c", "de", "x")]
    assert run(spark, rows, 30, 50) == brute(rows, 30, 50)
    assert run(spark, [], 30, 50) == []


def test_repeated_rows_weigh_as_often(spark):
    rows = [("same words here", "en", "x")] * 50 + [("other words", "en", "y")] * 35 + [("rare", "en", "y")]
    assert run(spark, rows, 30, 50) == brute(rows, 30, 50)


def test_long_texts_count_once(spark, monkeypatch):
    """A text cut into pieces is one document for each of its terms."""
    texts = ["alpha Beta " * 400 + "gamma", "beta delta", "alpha", "x " * 900 + "alpha"]
    batch = pa.record_batch([pa.array(["en"] * 4), pa.array(["s", "s", "t", "t"]), pa.array(texts)], ["l", "s", "t"])
    monkeypatch.setattr(divergence, "PIECE", 64)
    n, docs = Counter(), Counter()
    for out in divergence._count_batches(iter([batch])):
        for r in out.to_pylist():
            n[r["source"], r["term"]] += r["n"]
            docs[r["source"], r["term"]] += r["docs"]
    assert n["s", "alpha"] == 400 and docs["s", "alpha"] == 1
    assert n["s", "beta"] == 401 and docs["s", "beta"] == 2
    assert n["t", "x"] == 900 and docs["t", "x"] == 1 and docs["t", "alpha"] == 2


def test_tree_needs_no_more_than_one_path(spark):
    """Any cut of the sorted paths adds up to the same sums."""
    paths = [[("a", 1), ("b", 2)], [("a", 1), ("b", 2), ("c", 1)], [("a", 2), ("c", 1)], [("b", 2), ("c", 5)]]

    def batch(some):
        rows = [[{"size": 1, "source": s, "n": n, "p": 10 * n, "base": 3} for s, n in p] for p in some]
        kind = pa.list_(pa.struct([("size", pa.int64()), ("source", pa.string()), ("n", pa.int64()), ("p", pa.int64()), ("base", pa.int64())]))
        return pa.record_batch([pa.array(["en"] * len(rows)), pa.array(rows, kind), pa.array([2] * len(rows))], ["l", "p", "t"])

    def total(*groups):
        out = Counter()
        for some in groups:
            for found in divergence._tree_batches(iter([batch([p]) for p in some])):
                for r in found.to_pylist():
                    out[tuple(sorted((r["source"], r["item"])))] += r["value"]
        return out

    assert total(paths) == total(paths[:1], paths[1:3], paths[3:]) == total(*[[p] for p in paths])
