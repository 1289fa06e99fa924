"""Near-duplicate documents by SimHash and Golay-code fuzzy hashing.

A fingerprint is cut into three segments, each of at most 23 bits. The perfect
Golay code (23, 12) puts every segment value within three bits of exactly one of
4096 codewords, whose index is a fuzzy hash: the indices of a value and of its
one-bit neighbours are one or a few keys. Three differing bits leave, by
pigeonhole, either a segment without errors and another with at most one, or
exactly one error in each. So seven key families find every pair:

* six (exact segment, fuzzy segment) families: 21 or 22 bits and 12 bits;
* one family for one error each: two fuzzy segments and the three segment
  parities, all of which such a pair differs in.

One side of the join carries the index of the value itself, the other those of
the neighbours; the pairs met are verified on all 64 bits.

Fingerprints are collapsed to distinct values before the search, so thousands
of copies are one node. Words, shingles and hashes follow the rule stated at
``fingerprints``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.graph import components
from millrace.llm.staging import staged
from millrace.llm.tokens import BLANKS, joined, pieces
from millrace.llm.xxh64 import hash_ranges

WORDS, SEED, RADIUS = 3, 42, 3
# Low bit and width of each segment of the 64 bits.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
# Generator polynomial of the binary Golay code: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GENERATOR = 0b101011100011


# ------------------------------------------------------------ fingerprints

def _text_bits(texts: pa.Array) -> np.ndarray:
    """The fingerprint of every text of a column, as int64."""
    ones = np.zeros((len(texts), 64), dtype=np.int64)
    count = np.zeros(len(texts), dtype=np.int64)
    for data, starts, ends, rows in pieces(texts, ~BLANKS, WORDS - 1):
        if not len(starts):
            continue
        out, begins, stops = joined(data, starts, ends)
        n = len(rows)
        first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
        last = np.r_[first[1:], n] - 1
        # Whole sequence of the texts with fewer words than a shingle.
        few = (last - first + 1 < WORDS) & (count[rows[first]] == 0)
        full = np.flatnonzero(rows[WORDS - 1:] == rows[:n - WORDS + 1]) if n >= WORDS else np.zeros(0, int)
        begin = np.concatenate([begins[first[few]], begins[full]])
        stop = np.concatenate([stops[last[few]], stops[full + WORDS - 1]])
        owner = np.concatenate([rows[first[few]], rows[full]])
        if not len(owner):
            continue
        order = np.argsort(owner, kind="stable")
        owner = owner[order]
        hashes = hash_ranges(out, begin[order], stop[order], SEED)
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        cut = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        ones[owner[cut]] += np.add.reduceat(bits, cut, axis=0, dtype=np.int64)
        count[owner[cut]] += np.diff(np.r_[cut, len(owner)])
    major = (2 * ones > count[:, None]).astype(np.uint8)
    return np.packbits(major, axis=1, bitorder="little").view("<i8").ravel()


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bits = _text_bits(batch.column(1)) if batch.num_rows else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits, pa.int64())], ["doc_id", "bits"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, bits long), one row for each row of ``docs(doc_id, text)``.

    A to Z are lower-cased; words are runs without space, tab, line feed,
    vertical tab, form feed or carriage return; shingles are 3 words joined by
    one space, repeats included; of 1 or 2 words the whole sequence is one
    shingle. A bit is 1 if it is set in over half of the shingles' XXH64 (seed
    42). A null text or one without words has fingerprint zero.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(_fingerprint_batches, "doc_id long, bits long")


def hex_bits(bits: Column) -> Column:
    return F.lpad(F.lower(F.hex(bits)), 16, "0")


# ------------------------------------------------------------- fuzzy keys

def _remainder(value: int) -> int:
    for bit in range(22, 10, -1):
        if value >> bit & 1:
            value ^= GENERATOR << (bit - 11)
    return value


def golay_indices() -> np.ndarray:
    """The index (12 bits) of the codeword nearest to each 22-bit value."""
    single = [_remainder(1 << k) for k in range(23)]
    leaders = np.zeros(2048, dtype=np.int32)
    for i in range(23):
        leaders[single[i]] = 1 << i
        for j in range(i):
            leaders[single[i] ^ single[j]] = 1 << i | 1 << j
            for k in range(j):
                leaders[single[i] ^ single[j] ^ single[k]] = 1 << i | 1 << j | 1 << k
    rest = np.zeros(1, dtype=np.int32)
    for k in range(22):
        rest = np.concatenate([rest, rest ^ single[k]])
    values = np.arange(1 << 22, dtype=np.int32)
    return ((values ^ leaders[rest]) >> 11).astype(np.int16)


def _segments(bits: np.ndarray) -> list[np.ndarray]:
    unsigned = bits.view(np.uint64)
    return [(unsigned >> np.uint64(low)).astype(np.int64) & ((1 << width) - 1) for low, width in SEGMENTS]


def _near(table, values, width, itself):
    """Indices of the one-bit neighbours, -1 where one is a repeat."""
    flips = np.array([0] * itself + [1 << k for k in range(width)], dtype=np.int64)
    found = np.sort(table[values[:, None] ^ flips].astype(np.int64), axis=1)
    found[:, 1:][found[:, 1:] == found[:, :-1]] = -1
    return found


def _parity(segments) -> np.ndarray:
    return sum((np.bitwise_count(s) & 1).astype(np.int64) << k for k, s in enumerate(segments))


def _own_keys(table, bits) -> list[np.ndarray]:
    parts = _segments(bits)
    code = [table[p].astype(np.int64) for p in parts]
    keys = [(code[0] << 15 | code[1] << 3 | _parity(parts))[:, None]]
    for family, (z, y) in enumerate(_ORDERED, 1):
        keys.append((family << 34 | parts[z] << 12 | code[y])[:, None])
    return keys


def _near_keys(table, bits) -> list[np.ndarray]:
    parts = _segments(bits)
    a, b = (_near(table, parts[k], SEGMENTS[k][1], False) for k in (0, 1))
    both = a[:, :, None] << 15 | b[:, None, :] << 3 | (7 ^ _parity(parts))[:, None, None]
    both[(a[:, :, None] < 0) | (b[:, None, :] < 0)] = -1
    keys = [both.reshape(len(bits), -1)]
    codes = [_near(table, p, SEGMENTS[k][1], True) for k, p in enumerate(parts)]
    for family, (z, y) in enumerate(_ORDERED, 1):
        key = family << 34 | parts[z][:, None] << 12 | codes[y]
        key[codes[y] < 0] = -1
        keys.append(key)
    return keys


_ORDERED = ((0, 1), (0, 2), (1, 0), (1, 2), (2, 0), (2, 1))


def _keyed(make):
    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = golay_indices()
        for batch in source:
            bits = batch.column(0).to_numpy(zero_copy_only=False)
            for low in range(0, len(bits), 2048):
                some = bits[low:low + 2048]
                for keys in make(table, some):
                    row, at = np.nonzero(keys >= 0)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys[row, at]), pa.array(some[row])], ["key", "bits"])
    return batches


def links(values: DataFrame) -> DataFrame:
    """All pairs (a, b), a < b, of the distinct fingerprints ``values(bits)``
    that differ in at most three bits."""
    schema = "key long, bits long"
    own = values.mapInArrow(_keyed(_own_keys), schema).withColumnRenamed("bits", "b")
    near = values.mapInArrow(_keyed(_near_keys), schema).withColumnRenamed("bits", "a")
    apart = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    return near.join(own, "key").filter((F.col("a") < F.col("b")) & (apart <= RADIUS)).select("a", "b").distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, component_id) for each row of ``docs(doc_id, text)``.

    ``component_id`` is the smallest doc_id that links reach. Rows without
    words have fingerprint zero and link like any other. Null ids have no say in
    ``component_id``; it is null where a component has no other. Repeated rows
    are repeated in the result; an empty table gives an empty one. Other columns
    are ignored.
    """
    prints, _ = staged(fingerprints(docs), "fingerprints")
    values, _ = staged(prints.groupBy("bits").agg(F.min("doc_id").alias("first")), "fingerprint-values")
    found = components(links(values.select("bits")))
    label = F.coalesce("component", "bits").alias("label")
    member = values.join(found.withColumnRenamed("node", "bits"), "bits", "left").select("bits", "first", label)
    lowest = member.groupBy("label").agg(F.min("first").alias("component_id"))
    member = member.join(lowest, "label").select("bits", "component_id")
    return prints.join(member, "bits").select("doc_id", hex_bits(F.col("bits")).alias("fingerprint"), "component_id")


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """The documents without near copies: of each component the one with the
    smallest doc_id stays, with all its columns.

    Rows that share an id are one document: it stays if any of them would, as
    its row with the smallest text hash. Rows with a null id cannot be told
    apart by id and stay.
    """
    groups = near_duplicates(docs).filter("doc_id IS NOT NULL")
    first = F.max(F.col("doc_id") == F.col("component_id"))
    gone, _ = staged(groups.groupBy("doc_id").agg(first.alias("stays")).filter("NOT stays").select("doc_id"), "copies")
    named = docs.filter("doc_id IS NOT NULL").join(gone, "doc_id", "left_anti").select(*_columns(docs))
    order = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"), F.xxhash64(*_columns(docs)))
    rank = _free(docs.columns, "rank")
    named = named.withColumn(rank, F.row_number().over(order)).filter(F.col(rank) == 1).drop(rank)
    return named.unionByName(docs.filter("doc_id IS NULL"))


def _columns(df: DataFrame) -> list[str]:
    return [f"`{c}`" for c in df.columns]


def _free(names: list[str], base: str) -> str:
    """A column name that is not taken."""
    taken = {n.lower() for n in names}
    while base in taken:
        base = f"_{base}"
    return base
