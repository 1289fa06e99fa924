"""Quality of documents by a linear-chain conditional random field over lines.

Every line of a text is good or bad. A line's score for good is linear in its own
features and, with weights of their own, in those of the lines before and after;
a 2 x 2 table scores neighbouring labels. Forward-backward gives each line's
probability of being good, and the mean weighted by line length, calibrated,
is the document's score.

Features are shares and bins of byte classes: which classes each word mixes (one
of 128 masks), the share of every class in the line, lengths, how many words are
distinct, how the line begins and ends, and whether it repeats another line.

Labels are of documents, so in training each line bears its document's label. The
fit reads a bounded sample: ``PER_LABEL`` documents of each label, chosen by a
hash of their id, of each at most ``LINES`` lines in a row (a window chosen by
the same hash). A quarter of it is kept back for calibration. Scoring covers all
lines of all texts: whole lines are read a megabyte at a time, only a few numbers
a line are kept, and the chain is a scan of 2 x 2 products over all lines
of a batch at once, so neither many short nor one very long text is slow.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.tokens import BLANKS, _cut, pieces, word_spans

PER_LABEL, LINES = 1500, 256
STEPS, RATE, DECAY = 200, 0.1, 1e-4
GOOD = 0.7
SEED = 11


def _classes() -> np.ndarray:
    """The class bit of every byte: a-z, A-Z, digit, sentence mark, other ASCII
    mark, not ASCII, control; blanks have none."""
    bits = np.zeros(256, dtype=np.uint8)
    for b in range(256):
        c = chr(b)
        kinds = ("a" <= c <= "z", "A" <= c <= "Z", "0" <= c <= "9", c in ".,;:?'\"-()", 32 < b < 127, b >= 128, True)
        bits[b] = 0 if BLANKS[b] else 1 << kinds.index(True)
    return bits


CLASS = _classes()
KINDS, MASKS = 7, 128
NEWLINE = np.zeros(256, dtype=bool)
NEWLINE[[10, 13]] = True
SHARES = np.array([1e-9, 0.01, 0.03, 0.06, 0.1, 0.2, 0.4, 0.7])
WORD_SIZES = np.array([2, 3, 4, 5, 6, 8, 12, 20])
DISTINCT = np.array([0.2, 0.4, 0.6, 0.8, 0.9, 0.999])
# Sizes of the binned features: a share for each class and blanks, line length,
# number of words, mean word length, distinct words, begin and end, repeats.
BINS = [len(SHARES) + 1] * (KINDS + 1) + [16, 16, len(WORD_SIZES) + 1, len(DISTINCT) + 1, KINDS + 1, KINDS + 1, 3]
FIRST = MASKS + np.concatenate([[0], np.cumsum(BINS[:-1])])
WIDTH = MASKS + sum(BINS)


@dataclass
class QualityModel:
    weights: np.ndarray  # WIDTH x 3: the line's own, for the next line, for the line before
    ends: np.ndarray  # first and last line
    steps: np.ndarray  # 2 x 2, from label to label
    slope: float  # calibration of the mean's log odds
    shift: float
    empty: float  # score of a text without words


# ----------------------------------------------------------------- features

def _kind(bits: np.ndarray) -> np.ndarray:
    """0 for no class, else 1 + the class's number."""
    return np.where(bits > 0, np.log2(np.maximum(bits, 1)).astype(np.int64) + 1, 0)


def _piece(data, starts, ends):
    """The features of some lines: shares of word masks, bins (but for the last,
    repeats), bytes without blanks, hashes."""
    count = len(starts)
    bits = CLASS[data]
    size = ends - starts
    held = np.zeros((count, KINDS + 1))
    for k in range(KINDS):
        total = np.concatenate([[0], np.cumsum(bits == 1 << k)])
        held[:, k] = total[ends] - total[starts]
    full = held.sum(1)
    held[:, KINDS] = size - full
    low, high = word_spans(data, ~BLANKS)
    low, high = _cut(low, high, np.concatenate([[0], starts, [len(data)]]))
    line = np.searchsorted(starts, low, "right") - 1
    # A piece may hold the first bytes of a line that the next one has whole.
    inside = (line >= 0) & (high <= ends[np.maximum(line, 0)])
    low, high, line = low[inside], high[inside], line[inside]
    words = np.bincount(line, minlength=count)
    shares = np.zeros((count, MASKS))
    code = np.zeros(count, dtype=np.uint64)
    distinct = np.zeros(count)
    if len(low):
        mask = np.bitwise_or.reduceat(bits[:ends[-1]], low)
        shares = np.bincount(line * MASKS + mask, minlength=count * MASKS).reshape(count, MASKS) / np.maximum(words, 1)[:, None]
        hashes = _hashes(data, low, high)
        with np.errstate(over="ignore"):
            _, first = np.unique(hashes ^ (line.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), return_index=True)
        distinct = np.bincount(line[first], minlength=count) / np.maximum(words, 1)
        order = np.arange(len(line)) - np.concatenate([[0], np.cumsum(words)])[line]
        with np.errstate(over="ignore"):
            np.add.at(code, line, hashes * (2 * order.astype(np.uint64) + np.uint64(1)))
    bins = np.empty((count, len(BINS) - 1), dtype=np.int64)
    bins[:, :KINDS + 1] = np.searchsorted(SHARES, held / np.maximum(size, 1)[:, None], "right")
    bins[:, KINDS + 1] = np.minimum(np.log2(size + 1), 15)
    bins[:, KINDS + 2] = np.minimum(np.log2(words + 1), 15)
    bins[:, KINDS + 3] = np.searchsorted(WORD_SIZES, full / np.maximum(words, 1), "right")
    bins[:, KINDS + 4] = np.searchsorted(DISTINCT, distinct, "right")
    bins[:, KINDS + 5] = _kind(bits[starts])
    bins[:, KINDS + 6] = _kind(bits[ends - 1])
    return shares, bins, full, code


def _hashes(data, low, high) -> np.ndarray:
    """A hash of every word: the sum of its mixed bytes, each times an odd power
    of its place."""
    with np.errstate(over="ignore"):
        sizes = high - low
        begin = np.cumsum(sizes) - sizes
        index = np.repeat(low - begin, sizes) + np.arange(int(sizes.sum()))
        place = (index - np.repeat(low, sizes)).astype(np.uint64)
        mixed = (data[index].astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        mixed = (mixed ^ (mixed >> np.uint64(29))) * (place * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(1))
        total = np.add.reduceat(mixed ^ (mixed >> np.uint64(32)), begin)
        return total * np.uint64(0x94D049BB133111EB)


def _repeats(rows, code) -> np.ndarray:
    """2 for a line equal to the one before, 1 for one equal to another line of
    its text, else 0."""
    if not len(rows):
        return np.zeros(0, dtype=np.int64)
    order = np.lexsort((code, rows))
    equal = (rows[order][1:] == rows[order][:-1]) & (code[order][1:] == code[order][:-1])
    out = np.zeros(len(rows), dtype=np.int64)
    out[order[1:][equal]] = 1
    out[order[:-1][equal]] = 1
    out[1:][(rows[1:] == rows[:-1]) & (code[1:] == code[:-1])] = 2
    return out


def _lines(texts: pa.Array) -> Iterator[tuple]:
    """(rows, shares, bins, bytes, hashes) of the lines of some texts at a time.
    Lines end at line feeds and carriage returns; empty lines do not count."""
    for data, starts, ends, rows in pieces(texts, ~NEWLINE, 0, lower=False):
        if len(starts):
            yield rows, *_piece(data, starts, ends)


# -------------------------------------------------------------------- chain

def _scan(left: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Products of 2 x 2 matrices from the start of each run up to each member,
    scaled; ``place`` is the member's number in its run."""
    done, reach = left / left.max((1, 2), keepdims=True), 1
    while reach <= place.max(initial=0):
        at = np.flatnonzero(place >= reach)
        some = done[at - reach] @ done[at]
        done[at] = some / some.max((1, 2), keepdims=True)
        reach *= 2
    return done


def _bounds(rows) -> tuple[np.ndarray, np.ndarray]:
    """Of each line its number from the start and from the end of its text."""
    first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
    size = np.diff(np.r_[first, len(rows)])
    place = np.arange(len(rows)) - np.repeat(first, size)
    return place, np.repeat(size, size) - 1 - place


def _emissions(scores, rows, ends) -> np.ndarray:
    """The score for good of each line from its own and its neighbours' parts."""
    place, rest = _bounds(rows)
    out = scores[:, 0] + ends[0] * (place == 0) + ends[1] * (rest == 0)
    out[1:] += np.where(place[1:] > 0, scores[:-1, 1], 0)
    out[:-1] += np.where(rest[:-1] > 0, scores[1:, 2], 0)
    return out


def marginals(good: np.ndarray, steps: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each line the probability of label 1, and of each line but the first of
    its text the 2 x 2 probabilities of its own and the previous label (zeros for
    first lines). ``good`` are log odds, ``steps[a, b]`` scores b after a."""
    if not len(good):
        return np.zeros(0), np.zeros((0, 2, 2))
    place, rest = _bounds(rows)
    top = np.maximum(good, 0)
    emit = np.stack([np.exp(-top), np.exp(good - top)], 1)
    move = np.exp(steps - steps.max())
    into = np.where((place == 0)[:, None, None], 1.0, move) * emit[:, None, :]
    forward = _scan(into, place)[:, 0, :]
    # Backwards the same scan over the reversed, transposed matrices.
    back = np.where((rest == 0)[:, None, None], 1.0, (move[None] * np.roll(emit, -1, 0)[:, None, :]).transpose(0, 2, 1))
    behind = _scan(back[::-1], rest[::-1])[::-1][:, 0, :]
    both = forward * behind
    pair = np.zeros((len(good), 2, 2))
    later = np.flatnonzero(place > 0)
    pair[later] = forward[later - 1][:, :, None] * move[None] * (emit * behind)[later][:, None, :]
    pair[later] /= pair[later].sum((1, 2), keepdims=True)
    return both[:, 1] / both.sum(1), pair


# ---------------------------------------------------------------------- fit

def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def _window(doc_id: int | None, count: int, most: int) -> int:
    """Where a text's training lines begin."""
    return 0 if count <= most else (int(doc_id) * 2654435761 % 2**32) % (count - most + 1)


def _sampled(most: int):
    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            ids = batch.column(0).to_pylist()
            parts = list(_lines(batch.column(2)))
            rows = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.int64)
            shares = np.concatenate([p[1] for p in parts]) if parts else np.zeros((0, MASKS))
            bins = np.concatenate([p[2] for p in parts]) if parts else np.zeros((0, len(BINS) - 1), np.int64)
            size = np.concatenate([p[3] for p in parts]) if parts else np.zeros(0)
            code = np.concatenate([p[4] for p in parts]) if parts else np.zeros(0, np.uint64)
            bins = np.concatenate([bins, _repeats(rows, code)[:, None]], 1)
            out = []
            for r, doc_id in enumerate(ids):
                low, high = np.searchsorted(rows, [r, r + 1])
                low += _window(doc_id, high - low, most)
                some = slice(low, min(high, low + most))
                at, mask = np.nonzero(shares[some])
                out.append((size[some].astype(np.int64), bins[some].ravel(), np.bincount(at, minlength=len(size[some])),
                            mask, shares[some][at, mask]))
            kinds = [pa.int64(), pa.int16(), pa.int32(), pa.int16(), pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *[pa.array([list(o[k]) for o in out], pa.list_(kind)) for k, kind in enumerate(kinds)]],
                ["doc_id", "quality", "sizes", "bins", "held", "masks", "shares"])
    return batches


def _drawn(docs: DataFrame, labels: DataFrame, per_label: int, lines: int) -> tuple[list, dict[int, int]]:
    known = labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int")).filter(
        F.col("quality").isin(0, 1) & (fold(F.col("doc_id")) != 2))
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("most"))
    known = known.filter("quality = most").select("doc_id", "quality")
    size = {r.quality: r["count"] for r in known.groupBy("quality").count().collect()}
    if not size:
        return [], size
    share = F.create_map(*[F.lit(x) for label, n in size.items() for x in (label, per_label / n)])
    draw = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 30)) / (1 << 30)
    # Some per_label rows a label: never more than fit a broadcast.
    some = F.broadcast(known.filter(draw < share[F.col("quality")]))
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    rows = rows.join(some, "doc_id").select("doc_id", "quality", "text")
    found = rows.mapInArrow(_sampled(lines), "doc_id long, quality int, sizes array<long>, bins array<short>, "
                            "held array<int>, masks array<short>, shares array<double>")
    # Of rows that share an id one is taken, so that the sample stays bounded.
    whole = F.struct("sizes", "bins", "held", "masks", "shares")
    one = found.groupBy("doc_id", "quality").agg(F.min(whole).alias("row")).select("doc_id", "quality", "row.*")
    return sorted(one.collect(), key=lambda r: r.doc_id), size


def fit(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL, lines: int = LINES) -> QualityModel:
    """Learns from ``labels(doc_id, quality)`` outside the held-out fold (crc32
    of the id modulo 4 is 2) and their texts in ``docs(doc_id, text)``.

    Labels other than 0 and 1, null ids and ids whose labels disagree teach
    nothing. Without both labels every text scores the share of label 1, 0.5 if
    there is no label at all.
    """
    rows, size = _drawn(docs, labels, per_label, lines)
    return _train(rows, size)


def _table(rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature matrix, document number and size of the sample's lines."""
    count = [len(r.sizes) for r in rows]
    doc = np.repeat(np.arange(len(rows)), count)
    x = np.zeros((len(doc), WIDTH), dtype=np.float32)
    if len(doc):
        bins = np.concatenate([np.array(r.bins, dtype=np.int64).reshape(-1, len(BINS)) for r in rows if r.sizes])
        x[np.arange(len(doc))[:, None], bins + FIRST] = 1
        held = np.concatenate([np.array(r.held, dtype=np.int64) for r in rows])
        masks = np.concatenate([np.array(r.masks, dtype=np.int64) for r in rows])
        x[np.repeat(np.arange(len(doc)), held), masks] = np.concatenate([np.array(r.shares) for r in rows])
    return x, doc, np.concatenate([np.array(r.sizes, dtype=np.float64) for r in rows]) if rows else np.zeros(0)


def _train(rows: list, size: dict[int, int]) -> QualityModel:
    known = sum(size.values())
    prior = size.get(1, 0) / known if known else 0.5
    flat = QualityModel(np.zeros((WIDTH, 3)), np.zeros(2), np.zeros((2, 2)), 0.0, _odds(prior), prior)
    label = np.array([r.quality for r in rows], dtype=np.int64)
    if len(set(label)) < 2:
        return flat
    back = np.random.default_rng(SEED).random(len(rows)) < 0.25
    x, doc, weight = _table(rows)
    learn = ~back[doc]
    model = _gradient(x[learn], doc[learn], label)
    empty = [r.quality for r in rows if not sum(r.sizes)]
    model.empty = (sum(empty) + prior) / (len(empty) + 1)
    # Calibrated on all of the kept-back documents, each label at its true share.
    mean = _document_means(x @ model.weights.astype(np.float32), doc, weight, len(rows), model)
    use = back & ~np.isnan(mean)
    if len(set(label[use])) < 2:
        use = ~np.isnan(mean)
    share = np.array([size.get(k, 0) / max(1, (label[use] == k).sum()) for k in (0, 1)])
    model.slope, model.shift = _logistic(_odds(mean[use]), label[use], share[label[use]])
    return model


def _odds(p):
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def _gradient(x, doc, label) -> QualityModel:
    """Maximum likelihood of the labelled chains by Adam, with weight decay.
    Each label weighs half, each document of it the same."""
    count = np.bincount(doc, minlength=len(label))
    y = label[doc]
    share = np.array([0.5 / max(1, (label[count > 0] == k).sum()) for k in (0, 1)])
    weight = share[y] / count[doc]
    place, rest = _bounds(doc) if len(doc) else (np.zeros(0, int), np.zeros(0, int))
    later, sooner = np.flatnonzero(place > 0), np.flatnonzero(rest > 0)
    truth = np.zeros((2, 2))
    np.add.at(truth, (y[later - 1], y[later]), weight[later])
    theta = np.zeros(WIDTH * 3 + 6)
    speed, force = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        w, ends, steps = theta[:WIDTH * 3].reshape(WIDTH, 3), theta[-6:-4], theta[-4:].reshape(2, 2)
        p, pair = marginals(_emissions(x @ w.astype(np.float32), doc, ends), steps, doc)
        off = ((p - y) * weight).astype(np.float32)
        parts = np.zeros((len(off), 3), dtype=np.float32)
        parts[:, 0] = off
        parts[later - 1, 1] = off[later]
        parts[sooner + 1, 2] = off[sooner]
        slope = np.concatenate([
            (x.T @ parts).ravel(), [off[place == 0].sum(), off[rest == 0].sum()],
            ((pair * weight[:, None, None]).sum(0) - truth).ravel()]) + DECAY * theta
        speed = 0.9 * speed + 0.1 * slope
        force = 0.99 * force + 0.01 * slope**2
        theta = theta - RATE * (speed / (1 - 0.9**step)) / (np.sqrt(force / (1 - 0.99**step)) + 1e-8) / (1 + step / 50)
    return QualityModel(theta[:WIDTH * 3].reshape(WIDTH, 3), theta[-6:-4], theta[-4:].reshape(2, 2), 1.0, 0.0, 0.5)


def _logistic(odds, label, weight) -> tuple[float, float]:
    """Slope and shift of a logistic curve by Newton's method, slightly damped
    towards the identity so that clean samples do not make it infinite."""
    x = np.stack([odds, np.ones_like(odds)], 1)
    theta, weight = np.array([1.0, 0.0]), weight / weight.sum()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        slope = x.T @ (weight * (p - label)) + 1e-3 * (theta - [1, 0])
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        theta = theta - np.clip(np.linalg.solve(bend, slope), -1, 1)
    return max(float(theta[0]), 0.05), float(theta[1])


# -------------------------------------------------------------------- score

def _document_means(scores, doc, weight, count, model) -> np.ndarray:
    """The length-weighted mean probability of good lines; NaN without words."""
    p, _ = marginals(_emissions(scores.astype(np.float64), doc, model.ends), model.steps, doc)
    total = np.bincount(doc, weight, minlength=count)
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.where(total > 0, np.bincount(doc, weight * p, minlength=count) / total, np.nan)


def line_probabilities(texts: pa.Array, model: QualityModel) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bytes without blanks, probability of good) of each line of the texts."""
    rows, scores, sizes, codes = [np.zeros(0, np.int64)], [np.zeros((0, 3))], [np.zeros(0)], [np.zeros(0, np.uint64)]
    for row, shares, bins, size, code in _lines(texts):
        score = shares @ model.weights[:MASKS]
        for k in range(len(BINS) - 1):
            score += model.weights[FIRST[k] + bins[:, k]]
        rows.append(row)
        scores.append(score)
        sizes.append(size)
        codes.append(code)
    rows, scores, sizes, codes = (np.concatenate(a) for a in (rows, scores, sizes, codes))
    scores += model.weights[FIRST[-1] + _repeats(rows, codes)]
    return rows, sizes, marginals(_emissions(scores, rows, model.ends), model.steps, rows)[0]


def score_texts(texts: pa.Array, model: QualityModel) -> np.ndarray:
    rows, size, p = line_probabilities(texts, model)
    total = np.bincount(rows, size, minlength=len(texts))
    mean = np.bincount(rows, size * p, minlength=len(texts)) / np.maximum(total, 1e-300)
    score = 1 / (1 + np.exp(-np.clip(model.slope * _odds(mean) + model.shift, -30, 30)))
    return np.where(total > 0, score, model.empty)


def score(text: Column, model: QualityModel) -> Column:
    """The probability of label 1 of each whole text. Null texts and texts
    without words get the share of label 1 among such."""

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
        return pa.array(score_texts(texts.cast(pa.large_string()), model))

    return scored(text.cast("string"))


def judged(docs: DataFrame, model: QualityModel, good: float = GOOD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row of ``docs(doc_id, text)``;
    ``predicted`` is 1 from a score of ``good`` on. Only the text decides.

    Repeated rows are repeated; a null id is not held out; an empty table gives
    an empty result. Other columns are ignored.
    """
    held = F.coalesce(fold(F.col("doc_id")) == 2, F.lit(False)).alias("held_out")
    rows = docs.select("doc_id", held, score(F.col("text"), model).alias("score"))
    return rows.select("*", (F.col("score") >= good).cast("int").alias("predicted"))
