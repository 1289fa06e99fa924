"""Language of a text: averaged hashed subword embeddings and a linear softmax.

Subwords are the 1 to 4 byte runs of the lower-cased text's words, each followed
by one blank; they are hashed to ``BUCKETS`` embeddings, whose mean over the whole
text goes through a linear layer. Embeddings and layer are trained together by
stochastic gradient descent. As all of that is linear, prediction adds up one
row of logits for each subword.

The fit reads a bounded sample: at most about ``PER_LANGUAGE`` documents of each
language and ``SAMPLE`` in all, chosen by a hash of their id. A fifth of it is
kept back to set the softmax temperature and the rejection threshold: a
prediction is rejected if its score is below all but ``REJECTED`` of the scores
of the kept-back documents that were predicted right.
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.tokens import joined, pieces

BUCKETS, WIDTH, LONGEST = 4096, 16, 4
PER_LANGUAGE, SAMPLE = 1000, 20_000
PIECE = 1 << 18
EPOCHS, BATCH, RATE = 12, 16, 4.0
REJECTED = 0.001
UNKNOWN = "und"
LETTERS = np.array([b >= 128 or chr(b).isalpha() for b in range(256)])


@dataclass
class LanguageModel:
    languages: list[str]
    logits: np.ndarray  # one row for each bucket
    bias: np.ndarray
    temperature: float
    threshold: float


# ---------------------------------------------------------------- subwords

def _subwords(texts: pa.Array, limit: int):
    """Yields (rows, buckets), sorted by row, of some of the texts' subwords."""
    for data, starts, ends, rows in pieces(pc.utf8_lower(texts), LETTERS, 0, limit):
        if not len(starts):
            continue
        out, begins, stops = joined(data, starts, ends)
        owner = np.repeat(rows.astype(np.int32), stops - begins + 1)
        code = np.zeros(len(out), dtype=np.uint64)
        for n in range(1, min(LONGEST, len(out)) + 1):
            code = code[:len(out) - n + 1] * np.uint64(257) + out[n - 1:] + np.uint64(1)
            whole = owner[:len(code)] == owner[n - 1:]
            mixed = (code[whole] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(52)
            yield owner[:len(code)][whole], mixed.astype(np.int32)


def _runs(rows):
    first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
    return first, np.r_[first[1:], len(rows)]


def _texts(texts) -> pa.Array:
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    return texts.cast(pa.large_string())


def _count_batches(batches):
    """(doc_id, lang, buckets, counts) of the sample's documents."""
    for batch in batches:
        found = [{} for _ in range(batch.num_rows)]
        for rows, buckets in _subwords(_texts(batch.column(2)), PIECE):
            for low, high in zip(*_runs(rows)):
                seen = found[rows[low]]
                for k, n in zip(*np.unique(buckets[low:high], return_counts=True)):
                    seen[int(k)] = seen.get(int(k), 0) + int(n)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([list(f) for f in found], pa.list_(pa.int16())),
             pa.array([list(f.values()) for f in found], pa.list_(pa.int32()))],
            ["doc_id", "lang", "buckets", "counts"])


# --------------------------------------------------------------------- fit

def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE, seed: int = 5) -> LanguageModel:
    """Learns from the labelled rows of ``docs(doc_id, text, lang)`` outside the
    held-out fold (crc32 of the id modulo 3 is 1). Rows with a null id or lang
    or without a letter teach nothing; without any row the model knows no
    language."""
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long"), F.col("lang").cast("string"), text.alias("text"))
    rows = rows.filter((fold(F.col("doc_id")) != 1) & F.col("lang").isNotNull() & has_letter(F.col("text")))
    size = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not size:
        return _train([], [], seed)
    most = min(per_language, SAMPLE / len(size))
    share = F.create_map(*[F.lit(x) for lang, n in size.items() for x in (lang, most / n)])
    draw = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 30)) / (1 << 30)
    sample = rows.filter(draw < share[F.col("lang")]).select("doc_id", "lang", "text")
    counts = sample.mapInArrow(_count_batches, "doc_id long, lang string, buckets array<short>, counts array<int>")
    got = counts.toArrow()
    names = got["lang"].to_pylist()
    ids = got["doc_id"].to_pylist()
    # As arrays: lists of Python numbers would be several times as large.
    rows = list(zip(*([x for chunk in got[c].chunks for x in _slices(chunk)] for c in ("buckets", "counts"))))
    order = _order(ids, names, rows)
    return _train([names[i] for i in order], [rows[i] for i in order], seed)


def _order(ids: list, names: list, rows: list[tuple]) -> list[int]:
    """The sample in one order, however it came. Digests stand for the rows, whose copies would be as large as the sample."""
    return sorted(range(len(ids)), key=lambda i: (ids[i], names[i], sha256(b"".join(x.tobytes() for x in rows[i])).digest()))


def _slices(lists: pa.ListArray) -> list[np.ndarray]:
    """The values of each list."""
    ends, values = lists.offsets.to_numpy(), lists.values.to_numpy()
    return [values[low:high] for low, high in zip(ends[:-1], ends[1:])]


def _dense(rows) -> np.ndarray:
    out = np.zeros((len(rows), BUCKETS))
    for i, (buckets, counts) in enumerate(rows):
        out[i, buckets] = counts
    return out / np.maximum(out.sum(1, keepdims=True), 1)


def _softmax(logits):
    e = np.exp(logits - logits.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def _train(labels: list[str], rows: list[tuple], seed: int) -> LanguageModel:
    languages = sorted(set(labels))
    if not languages:
        return LanguageModel([], np.zeros((BUCKETS, 0)), np.zeros(0), 1.0, 0.0)
    rng = np.random.default_rng(seed)
    target = np.searchsorted(np.array(languages), labels)
    order = rng.permutation(len(rows))
    kept = order[: len(rows) // 5]
    learn = order[len(rows) // 5:]
    embed = rng.normal(0, 0.5, (BUCKETS, WIDTH))
    layer, bias = rng.normal(0, 0.5, (WIDTH, len(languages))), np.zeros(len(languages))
    for epoch in range(EPOCHS):
        rate = RATE / (1 + epoch / 3)
        for low in range(0, len(learn), BATCH):
            some = learn[low:low + BATCH]
            x = _dense([rows[i] for i in some])
            mean = x @ embed
            slope = _softmax(mean @ layer + bias)
            slope[np.arange(len(some)), target[some]] -= 1
            slope /= len(some)
            step = x.T @ (slope @ layer.T)
            layer -= rate * mean.T @ slope
            bias -= 0.1 * rate * slope.sum(0)
            embed -= rate * len(languages) * WIDTH * step
    table = embed @ layer
    logits = np.concatenate([_dense([rows[i]]) @ table + bias for i in kept]) if len(kept) else np.zeros((0, len(languages)))
    temperature, threshold = _calibrate(logits, target[kept])
    return LanguageModel(languages, table, bias, temperature, threshold)


def _calibrate(logits, target) -> tuple[float, float]:
    if not len(target):
        return 1.0, 0.0
    spread = np.geomspace(0.1, 10, 60)
    at = np.arange(len(target))
    loss = [-np.log(np.maximum(_softmax(logits / t)[at, target], 1e-12)).mean() for t in spread]
    best = float(spread[int(np.argmin(loss))])
    scores = _softmax(logits / best)
    right = scores.argmax(1) == target
    return best, float(np.quantile(scores.max(1)[right], REJECTED, method="lower")) if right.any() else 0.0


# ----------------------------------------------------------------- predict

def predict_texts(texts: pa.Array, model: LanguageModel) -> tuple[np.ndarray, np.ndarray]:
    """The language's index (-1: unknown) and score of each text."""
    texts = _texts(texts)
    known = len(model.languages)
    sums, size = np.zeros((len(texts), known)), np.zeros(len(texts))
    if known and len(texts):
        for rows, buckets in _subwords(texts, max(1 << 14, PIECE * 8 // max(known, 8))):
            low, high = _runs(rows)
            sums[rows[low]] += np.add.reduceat(model.logits[buckets], low, axis=0)
            size[rows[low]] += high - low
    letter = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)
    good = letter & (size > 0) & (known > 0)
    best, score = np.full(len(texts), -1), np.zeros(len(texts))
    if good.any():
        share = _softmax((sums[good] / size[good, None] + model.bias) / model.temperature)
        best[good], score[good] = share.argmax(1), share.max(1)
    return best, score


def predicted(text: Column, model: LanguageModel) -> Column:
    """A struct (lang_pred, score, rejected) for a text column.

    Null texts and texts without a letter are ``und`` with score 0 and rejected;
    so is every text if the model knows no language.
    """

    @F.arrow_udf("lang_pred string, score double, rejected boolean")
    def predict(texts: pa.Array) -> pa.Array:
        best, score = predict_texts(texts, model)
        names = pa.array([*model.languages, UNKNOWN]).take(pa.array(best % (len(model.languages) + 1)))
        cut = (best < 0) | (score < model.threshold)
        return pa.StructArray.from_arrays([names, pa.array(score), pa.array(cut)], ["lang_pred", "score", "rejected"])

    return predict(text.cast("string"))


def languages(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, rejected) of each row of ``docs``.

    Repeated rows are repeated; a null id is not held out.
    """
    guess = predicted(F.col("text"), model).alias("guess")
    held = F.coalesce(fold(F.col("doc_id")) == 1, F.lit(False)).alias("held_out")
    return docs.select("doc_id", held, guess).select("doc_id", "held_out", "guess.*")


def without_rejected(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """The rows whose language is recognised, all columns kept."""
    guess = predicted(F.col("text"), model)
    return docs.filter(~guess["rejected"])
