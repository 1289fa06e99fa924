import re
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import langid, queries, tokens


@pytest.fixture(scope="module")
def model(spark, sf_dir):
    return langid.fit(queries.table(spark, "/root/testdata/sf0.01", "documents"))


def test_held_out_accuracy(spark, model):
    docs = queries.table(spark, "/root/testdata/sf0.01", "documents")
    got = langid.languages(docs, model).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.97
    assert np.mean([r.rejected for r in got]) < 0.02
    assert all(0 <= r.score <= 1 for r in got)


def test_prediction_is_the_mean_embedding(monkeypatch, model):
    texts = ["The thing, and THE other!", "le être", None, "12 34", "", "x" * 50, "é"]
    best, score = langid.predict_texts(pa.array(texts), model)
    for text, b, s in zip(texts, best, score):
        data = ("".join(c if c.isalpha() else " " for c in (text or "").lower())).split()
        raw = b"".join(w.encode() + b" " for w in data)
        if not raw:
            assert b == -1 and s == 0
            continue
        total, n = np.zeros(len(model.languages)), 0
        for size in range(1, 5):
            for i in range(len(raw) - size + 1):
                code = 0
                for byte in raw[i:i + size]:
                    code = (code * 257 + byte + 1) % (1 << 64)
                total += model.logits[code * 0x9E3779B97F4A7C15 % (1 << 64) >> 52]
                n += 1
        z = (total / n + model.bias) / model.temperature
        p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        assert b == p.argmax() and abs(p.max() - s) < 1e-9


def test_odd_rows(spark, model):
    rows = [(1, None, "en"), (None, "the of and", None), (2, "123 !!", "en"), (2, "123 !!", "en"), (3, "the and of in " * 50000, "fr")]
    frame = spark.createDataFrame([(*r, 0.5, "x") for r in rows], "doc_id long, text string, lang string, score double, rejected string")
    got = langid.languages(frame, model).collect()
    assert [r.lang_pred for r in got] == ["und", got[1].lang_pred, "und", "und", "en"]
    assert not got[1].held_out and got[0].score == 0
    kept = langid.without_rejected(frame, model)
    assert kept.columns == frame.columns and {r.doc_id for r in kept.collect()} <= {None, 3}
    empty = langid.fit(frame.limit(0))
    assert empty.languages == [] and langid.languages(frame, empty).filter("lang_pred <> 'und' OR score <> 0").count() == 0
    assert langid.languages(frame.limit(0), model).count() == 0


def test_sample_is_small_on_the_driver(spark):
    """Six bytes for each bucket of a sampled document, not twice that, and the same counts."""
    texts = [f"word{k} and others {k * k} " * 50 for k in range(40)]
    ids, langs = pa.array(range(40), pa.int64()), pa.array(["en"] * 40)
    (batch,) = langid._count_batches(iter([pa.RecordBatch.from_arrays([ids, langs, pa.array(texts)], ["doc_id", "lang", "text"])]))
    entries = sum(len(b) for b in batch.column(2).to_pylist())
    assert sum(batch.column(c).values.nbytes for c in (2, 3)) == 6 * entries
    # Words and a blank each, T bytes in all, have T runs of a byte, T - 1 of two and so on, to four.
    sizes = [4 * sum(len(w) + 1 for w in re.findall("[a-z]+", t)) - 6 for t in texts]
    assert [sum(c) for c in batch.column(3).to_pylist()] == sizes


def test_order_of_the_sample_takes_no_copy():
    rng = np.random.default_rng(2)
    ids, names = [k // 2 for k in range(400)], ["en", "de", "en", "en"] * 100
    rows = [(rng.integers(0, 4096, 2000, np.int16), rng.integers(1, 99, 2000, np.int32)) for _ in ids]
    tracemalloc.start()
    order = langid._order(ids, names, rows)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < sum(a.nbytes + b.nbytes for a, b in rows) / 4
    mixed = rng.permutation(len(ids))
    again = langid._order([ids[i] for i in mixed], [names[i] for i in mixed], [rows[i] for i in mixed])
    assert [mixed[i] for i in again] == order and [ids[i] for i in order] == sorted(ids)
