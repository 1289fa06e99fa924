"""Benchmark passages in documents, found by spaced-seed hashing.

A seed is a fixed mask laid over a run of tokens: the positions of its zeros are
ignored, so a substituted token there does no harm. Seeds of the test items meet
those of the documents in a join; for each meeting the item is laid along the
document at that offset and the overlap is verified over its whole length.

A document overlaps an item if at some offset a run of at least ``OVERLAP``
aligned tokens (the whole item, if that is shorter) has at least four fifths of its
tokens equal. The masks miss no such run: a longer one can be cut in two of which
one is such a run, and in each of 13 to 25 tokens with up to a fifth substituted,
wherever, some mask of ``MASKS`` fits. Shorter items have ``SHORT_MASKS``: of
their tokens, five in a row have at most one substituted. Items of fewer than
``SHORTEST`` tokens are too common to name an item and are never found.

Tokens are runs of letters, digits and non-ASCII bytes of the lower-cased text.
Documents' seeds pass a bit filter of the test seeds (at most 32 MB, whatever the
benchmark's size) before they are shuffled; what the filter lets through in
error is lost in the join. The token hashes around the seeds, as far as the longest
item reaches, go along in segments, so no text is shuffled or read twice. Equal texts are one key, verified alike.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.staging import staged
from millrace.llm.tokens import WORD_BYTES, pieces

MASKS = ("1110111", "11010001011", "110100001011")
SHORT_MASKS = ("1111", "11101", "11011", "10111")
OVERLAP, SHORTEST = 13, 5
FILTER_BITS = 28
BASE = 0x9E3779B97F4A7C15


# ------------------------------------------------------------------ hashes

def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _token_hashes(data, starts, ends) -> np.ndarray:
    """A polynomial hash of each span of the bytes, modulo 2**64."""
    n = len(data)
    power = np.full(n + 1, BASE, dtype=np.uint64)
    power[0] = 1
    back = np.full(n + 1, pow(BASE, -1, 1 << 64), dtype=np.uint64)
    back[0] = 1
    power, back = np.cumprod(power), np.cumprod(back)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:n], out=sums[1:])
    return _mixed((sums[ends] - sums[starts]) * back[starts])


def _seeds(tokens: np.ndarray, mask: str) -> np.ndarray:
    """The seed at each position where the mask fits."""
    size = len(tokens) - len(mask) + 1
    total = np.full(size, int(mask, 2) * BASE % (1 << 64), dtype=np.uint64)
    for k, bit in enumerate(mask):
        if bit == "1":
            odd = _mixed(np.array([k + 1], dtype=np.uint64))[0] | np.uint64(1)
            total += tokens[k:k + size] * odd
    return _mixed(total)


def _texts(column) -> pa.Array:
    return pc.utf8_lower(column.cast(pa.large_string()))


def _whole(texts: pa.Array) -> list[np.ndarray]:
    """The token hashes of each text."""
    found = [[] for _ in range(len(texts))]
    for data, starts, ends, rows in pieces(_texts(texts), WORD_BYTES, 0):
        if len(starts):
            hashes = _token_hashes(data, starts, ends)
            first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
            for low, high in zip(first, np.r_[first[1:], len(rows)]):
                found[rows[low]].append(hashes[low:high])
    return [np.concatenate(f) if f else np.zeros(0, np.uint64) for f in found]


# -------------------------------------------------------------- test items

def _item_batches(batches):
    for batch in batches:
        tokens = [t.view(np.int64) for t in _whole(batch.column(1))]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(tokens, pa.list_(pa.int64()))], ["item_id", "tokens"])


def _masks_of(size: int) -> tuple[str, ...]:
    if size >= OVERLAP:
        return MASKS
    return SHORT_MASKS if size >= SHORTEST else ()


def _item_seed_batches(batches):
    for batch in batches:
        for item, tokens in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            array = np.array(tokens, dtype=np.int64).view(np.uint64)
            for mask in _masks_of(len(array)):
                seeds = _seeds(array, mask).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(seeds), pa.array(np.full(len(seeds), item)), pa.array(np.arange(len(seeds)))],
                    ["seed", "item", "item_at"])


def _bit_filter(seeds: DataFrame) -> np.ndarray:
    """Two bits for each seed, from its lower and upper half; its size is bounded."""
    count = seeds.count()
    bits = min(FILTER_BITS, max(16, (1024 * count).bit_length()))
    halves = F.explode(F.array(F.col("seed"), F.shiftrightunsigned("seed", 32))).alias("half")
    place = F.col("half").bitwiseAND((1 << bits) - 1)
    one = F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(63).cast("int"))
    words = seeds.select(halves).groupBy(F.shiftright(place, 6).alias("word")).agg(F.bit_or(one).alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 6), dtype=np.uint64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    return out


def _passes(have: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    low_bits = np.uint64(64 * len(have) - 1)

    def on(place):
        place = place & low_bits
        return (have[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1)

    hit = np.flatnonzero(on(seeds))
    return hit[on(seeds[hit] >> np.uint64(32)) == 1]


# --------------------------------------------------------------- documents

def _lists(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> pa.Array:
    """An Arrow list of values[low:high] for each pair of bounds."""
    size = high - low
    ends = np.cumsum(size)
    index = np.repeat(low - ends + size, size) + np.arange(ends[-1])
    return pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), pa.array(values[index]))


SEGMENTS = "k1 long, k2 long, segment long, tokens array<long>, seeds array<long>, places array<long>"


def _segment_batches(masks, bits, reach: int = 4 * OVERLAP):
    """The runs of tokens up to ``reach`` around the seeds that pass the filter, and
    the seeds with their places in the run; ``segment`` is the run's place in its text."""
    def batches(source):
        have = bits.value
        overlap = 2 * reach + max(map(len, masks))
        for batch in source:
            k1, k2 = (batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
            seen = np.zeros(batch.num_rows, dtype=np.int64)
            for data, starts, ends, rows in pieces(_texts(batch.column(2)), WORD_BYTES, overlap):
                if not len(starts):
                    continue
                tokens = _token_hashes(data, starts, ends)
                first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
                size = np.diff(np.r_[first, len(rows)])
                begin, end = np.repeat(first, size), np.repeat(first + size, size)
                again = np.where(seen[rows[first]] > 0, overlap, 0)
                base = np.repeat(seen[rows[first]] - again - first, size)
                seen[rows[first]] += size - again
                at, seeds, spans = [], [], []
                for mask in masks:
                    if len(tokens) < len(mask):
                        continue
                    all_seeds = _seeds(tokens, mask)
                    on = _passes(have, all_seeds)
                    on = on[rows[on] == rows[on + len(mask) - 1]]
                    at.append(on)
                    seeds.append(all_seeds[on])
                    spans.append(np.full(len(on), len(mask)))
                at = np.concatenate(at) if at else np.zeros(0, np.int64)
                if not len(at):
                    continue
                order = np.argsort(at, kind="stable")
                at, seeds, spans = at[order], np.concatenate(seeds)[order], np.concatenate(spans)[order]
                low = np.maximum(at - reach, begin[at])
                high = np.maximum.accumulate(np.minimum(at + spans + reach, end[at]))
                cut = np.flatnonzero(np.r_[True, low[1:] >= high[:-1]])
                stop = np.r_[cut[1:], len(at)]
                place = at - np.repeat(low[cut], stop - cut)
                owner = rows[low[cut]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(k1[owner]), pa.array(k2[owner]), pa.array(low[cut] + base[low[cut]]),
                     _lists(tokens.view(np.int64), low[cut], high[stop - 1]),
                     _lists(seeds.view(np.int64), cut, stop), _lists(place, cut, stop)],
                    ["k1", "k2", "segment", "tokens", "seeds", "places"])
    return batches


def overlaps(doc: np.ndarray, item: np.ndarray, offset: int) -> bool:
    """Whether the item laid at ``offset`` has a long enough run of equal tokens."""
    low, high = max(0, offset), min(len(doc), offset + len(item))
    need = min(OVERLAP, len(item))
    if high - low < need:
        return False
    equal = doc[low:high] == item[low - offset:high - offset]
    sums = np.r_[0, np.cumsum(5 * equal.astype(np.int64) - 4)]
    return bool((sums[need:] >= np.minimum.accumulate(sums[:len(sums) - need])).any())


def longest_runs(runs: DataFrame) -> DataFrame:
    """Each run once. One that a cut of a long text clipped comes whole from the
    next piece, which has all its seeds."""
    whole = F.max_by(F.struct("tokens", "seeds", "places"), F.struct(F.size("tokens"), F.size("seeds")))
    return runs.groupBy("k1", "k2", "segment").agg(whole.alias("run")).select("k1", "k2", "segment", "run.*")


def _verify_batches(batches):
    for batch in batches:
        out = [[], [], []]
        for k1, k2, tokens, laid in zip(*(c.to_pylist() for c in batch.columns)):
            doc = np.array(tokens, dtype=np.int64)
            for one in laid:
                item = np.array(one["item_tokens"], dtype=np.int64)
                if any(overlaps(doc, item, offset) for offset in one["offsets"]):
                    for column, value in zip(out, (k1, k2, one["item"])):
                        column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["k1", "k2", "item"])


def text_keys() -> tuple[Column, Column]:
    """128 bits that stand for a text."""
    text = F.col("text").cast("string")
    return F.xxhash64(text), F.xxhash64(F.lit(7), text)


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(k1, k2, items array<long>): the text keys of the documents that overlap
    items of ``benchmark(item_id, text)``, with the items' ids, each once, in order.

    Null, empty and short texts overlap nothing. An item with a null id is found
    but not named; repeated items are named once.
    """
    spark = docs.sparkSession
    k1, k2 = text_keys()
    texts = docs.select(k1.alias("k1"), k2.alias("k2"), F.col("text").cast("string").alias("text"))
    texts = texts.filter("text IS NOT NULL")
    rows = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    items = rows.mapInArrow(_item_batches, "item_id long, tokens array<long>")
    items = items.select(F.monotonically_increasing_id().alias("item"), "item_id", "tokens")
    items, _ = staged(items, "benchmark-items")
    seeds = items.select("item", "tokens").mapInArrow(_item_seed_batches, "seed long, item long, item_at long")
    seeds, _ = staged(seeds, "benchmark-seeds")
    short = items.filter(F.size("tokens").between(SHORTEST, OVERLAP - 1)).limit(1).count()
    masks = (*MASKS, *SHORT_MASKS) if short else MASKS
    bits = spark.sparkContext.broadcast(_bit_filter(seeds))
    longest = items.agg(F.max(F.size("tokens"))).first()[0] or 0
    runs, _ = staged(texts.mapInArrow(_segment_batches(masks, bits, longest), SEGMENTS), "benchmark-segments")
    where = ["k1", "k2", "segment"]
    runs = longest_runs(runs)
    pair = F.explode(F.arrays_zip("seeds", "places")).alias("hit")
    met = runs.select(*where, pair).select(*where, F.col("hit.seeds").alias("seed"), F.col("hit.places").alias("at"))
    met = met.join(seeds, "seed").groupBy(*where, "item")
    met = met.agg(F.collect_set(F.col("at") - F.col("item_at")).alias("offsets"))
    met = met.join(items.select("item", F.col("tokens").alias("item_tokens")), "item")
    laid = met.groupBy(*where).agg(F.collect_list(F.struct("item", "item_tokens", "offsets")).alias("laid"))
    found = runs.join(laid, where).select("k1", "k2", "tokens", "laid")
    found = found.mapInArrow(_verify_batches, "k1 long, k2 long, item long").distinct()
    named = found.join(items.select("item", "item_id"), "item").groupBy("k1", "k2")
    return staged(named.agg(F.array_sort(F.collect_set("item_id")).alias("items")), "contaminated")[0]


def judged(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, contaminated, items) of each row of ``docs(doc_id, text)``."""
    k1, k2 = text_keys()
    rows = docs.select("doc_id", k1.alias("k1"), k2.alias("k2"))
    rows = rows.join(contaminated(docs, benchmark), ["k1", "k2"], "left")
    return rows.select("doc_id", F.col("items").isNotNull().alias("contaminated"), "items")


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows that overlap no item, all columns kept; null texts stay."""
    k1, k2 = text_keys()
    found = contaminated(docs, benchmark)
    hit = (k1 == found["k1"]) & (k2 == found["k2"])
    return docs.join(found, hit, "left_anti")
