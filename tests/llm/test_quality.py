"""The quality classifier: the chain against all labellings, held-out accuracy."""

import itertools
import random

import numpy as np
import pyarrow as pa

from millrace.llm import quality

WORDS = "the water runs down from hills towards old towns where people gather grain".split()


def clean(rng):
    lines = [" ".join(rng.choice(WORDS) for _ in range(rng.randint(4, 20))).capitalize() + "." for _ in range(rng.randint(1, 9))]
    return "\n".join(lines)


def junk(rng):
    kind = rng.randrange(3)
    if kind == 0:
        return " ".join(w + "###" for w in clean(rng).split())
    if kind == 1:
        return clean(rng).upper().replace(" ", "!! ")
    return " | ".join(rng.choice(WORDS) for _ in range(40))


def tables(spark, n=900):
    rng = random.Random(4)
    docs, labels = [], []
    for i in range(n):
        good = rng.random() < 0.8
        docs.append((i, clean(rng) if good else junk(rng), "x"))
        if i % 2:
            labels.append((i, int(good)))
    labels += [(1, 0), (1, 1), (None, 1), (3, None), (5, 9), (10**9, 1)]
    return (spark.createDataFrame(docs, "doc_id long, text string, score string"),
            spark.createDataFrame(labels, "doc_id long, quality int"))


def test_marginals_against_all_labellings():
    rng = np.random.default_rng(0)
    rows = np.array([0, 0, 0, 2, 3, 3, 3, 3, 3])
    good, steps = rng.normal(0, 2, len(rows)), rng.normal(0, 1, (2, 2))
    p, pair = quality.marginals(good, steps, rows)
    for r in np.unique(rows):
        at = np.flatnonzero(rows == r)
        weight = {}
        for y in itertools.product((0, 1), repeat=len(at)):
            weight[y] = np.exp(sum(good[i] * k for i, k in zip(at, y)) + sum(steps[a, b] for a, b in zip(y, y[1:])))
        total = sum(weight.values())
        for j, i in enumerate(at):
            assert np.isclose(p[i], sum(w for y, w in weight.items() if y[j]) / total)
            if j:
                want = [[sum(w for y, w in weight.items() if y[j - 1] == a and y[j] == b) / total for b in (0, 1)] for a in (0, 1)]
                assert np.allclose(pair[i], want)


def test_long_chain_of_strong_scores():
    rows = np.zeros(50_000, dtype=np.int64)
    good = np.where(np.arange(50_000) % 1000 < 500, 60.0, -60.0)
    p, _ = quality.marginals(good, np.array([[3.0, -3.0], [-3.0, 3.0]]), rows)
    assert np.isfinite(p).all() and (p[good > 0] > 0.99).all() and (p[good < 0] < 0.01).all()


def test_held_out_accuracy_and_columns(spark):
    docs, labels = tables(spark)
    model = quality.fit(docs, labels)
    out = quality.judged(docs, model).toPandas().set_index("doc_id")
    known = labels.filter("quality IN (0, 1) AND doc_id < 900 AND doc_id <> 1").toPandas().set_index("doc_id").quality
    held = out.loc[known.index][lambda x: x.held_out]
    assert len(held) > 50 and (held.predicted == known[held.index]).mean() > 0.97
    assert list(out.columns) == ["held_out", "score", "predicted"] and out.score.between(0, 1).all()
    assert (out.predicted == (out.score >= 0.7)).all()


def test_only_the_text_decides_and_pieces_agree(spark, monkeypatch):
    docs, labels = tables(spark)
    model = quality.fit(docs, labels)
    rng = random.Random(9)
    texts = [clean(rng), None, "", " \n\t\n", junk(rng), clean(rng) * 60, "\n".join([clean(rng), junk(rng)] * 30), "\n\nx\r\n", "x" * 5000]
    alone = [float(quality.score_texts(pa.array([t], pa.large_string()), model)[0]) for t in texts]
    together = quality.score_texts(pa.array(texts, pa.large_string()), model)
    assert np.allclose(alone, together, atol=1e-9)
    monkeypatch.setattr(quality, "pieces", lambda t, inside, overlap, lower: _small(t, inside, overlap, lower))
    assert np.allclose(quality.score_texts(pa.array(texts, pa.large_string()), model), together, atol=1e-9)
    assert together[1] == together[2] == together[3] == model.empty


def _small(texts, inside, overlap, lower):
    from millrace.llm.tokens import pieces

    return pieces(texts, inside, overlap, 300, lower)


def test_neighbours_matter(spark):
    """A line between bad ones is less likely good than between good ones."""
    docs, labels = tables(spark)
    model = quality.fit(docs, labels)
    rng = random.Random(2)
    bad, good, middle = junk(rng), clean(rng).replace("\n", " "), "1 a"
    p = [quality.line_probabilities(pa.array([f"{x}\n{middle}\n{x}"], pa.large_string()), model)[2][1] for x in (bad, good)]
    assert p[0] < p[1]


def test_empty_tables_one_label_and_repeats(spark):
    docs, labels = tables(spark, 60)
    none = quality.fit(docs.limit(0), labels.limit(0))
    assert quality.judged(docs.limit(0), none).count() == 0
    assert quality.judged(docs.limit(3), none).select("score").distinct().collect()[0][0] == 0.5
    ones = quality.fit(docs, labels.filter("quality = 1"))
    assert {r.predicted for r in quality.judged(docs, ones).collect()} == {1}
    twice = docs.union(docs).withColumn("doc_id", docs.doc_id % 7)
    same = spark.createDataFrame([(i, i % 2) for i in range(7)], "doc_id long, quality int")
    assert quality.judged(twice, quality.fit(twice, same)).count() == 120
    nulls = spark.createDataFrame([(None, None), (None, "a b")], "doc_id long, text string")
    assert [r.held_out for r in quality.judged(nulls, ones).collect()] == [False, False]
