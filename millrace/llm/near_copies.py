"""Near copies at a similarity of shingles, by wide SimHash and Golay-code fuzzy hashing.

A text has a fingerprint of 16 words of 64 bits, and two more of its shingles for checks.
Each word is cut into three segments, 48 in all. The perfect Golay code gives a segment the
index of the codeword nearest to it, and two nearby segments' indices together are a
key: 144 keys for a text. Errors spread over 48 segments leave, by pigeonhole, some
pair of segments that decode alike, although few single ones do. With a five-word
Jaccard similarity of 0.8 a bit differs with probability 0.117 where single words
are changed (0.151 where a passage is added or left out), a segment decodes alike with
0.21 (0.14), and one of the 144 keys is shared with 0.97 (0.86), as simulated.
Two unlike texts share one with 1e-5, and the words for checks let 5e-8 of those pass.

Every pair that is met is verified on the sets of its shingles, so nothing is
linked below the similarity. Pairs within a group are not made: each text is first
compared with the one that meets most others among those it meets (the original of a
group of copies), then with the likest of its neighbours in its keys'
order. Only then are the texts of different components that share a key compared, all of them.

Keys are 24 bits wide, so rows that share one by chance grow with the square of the texts. In a
key of few rows, as chance makes them, all are compared by their words for checks at once, and those
like no other leave.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.graph import components
from millrace.llm.simhash import SEED, SEGMENTS, golay_indices
from millrace.llm.staging import packed, staged, unpacked
from millrace.llm.tokens import BLANKS, joined, pieces
from millrace.llm.xxh64 import hash_ranges

WORDS, SIMILARITY = 5, 0.8
# Words of a fingerprint's features; shorter than a shingle, as one changed word then changes fewer bits.
FEATURE = 3
WIDE, STEPS = 16, (1, 2, 3)
# Bits of the two words for checks that may differ: 3e-4 of the pairs at 0.151 a bit differ in more.
CHECKS, CHECKED = 2, 34
SLICE = 1 << 23
# Words of the bitmap of a text's shingles that others have too.
MARKS = 8
# Rows of a key up to which each is held against all others of the key.
FEW = 8
# Linear turns before the last comparison (a second and third joined one text each of some 5000), and the most nodes sent to all tasks (about 10 MB).
TURNS, BROADCAST = 1, 100_000


# ------------------------------------------------------------ fingerprints

def _shingles(texts: pa.Array, words: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, hashes) of the word runs of some of the texts, sorted by row. A
    text of fewer words has one run, the whole of it; one without has none."""
    seen = np.zeros(len(texts), dtype=bool)
    for data, starts, ends, rows in pieces(texts, ~BLANKS, words - 1):
        if not len(starts):
            continue
        out, begins, stops = joined(data, starts, ends)
        first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
        last = np.r_[first[1:], len(rows)] - 1
        few = (last - first + 1 < words) & ~seen[rows[first]]
        full = np.arange(max(len(rows) - words + 1, 0))
        full = full[rows[full + words - 1] == rows[full]]
        seen[rows[first]] = True
        owner = np.concatenate([rows[first[few]], rows[full]])
        if len(owner):
            order = np.argsort(owner, kind="stable")
            begin = np.concatenate([begins[first[few]], begins[full]])[order]
            stop = np.concatenate([stops[last[few]], stops[full + words - 1]])[order]
            yield owner[order], hash_ranges(out, begin, stop, SEED)


def _mixed(hashes: np.ndarray, word: int) -> np.ndarray:
    """A further hash for each word (the public splitmix64 finalizer, fixed values)."""
    z = hashes + np.uint64((word + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def _wide_bits(texts: pa.Array, words: int, wide: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints (rows x ``wide``) of runs of ``words`` words, and the number of runs of each text."""
    ones = np.zeros((len(texts), wide, 64), dtype=np.int32)
    count = np.zeros(len(texts), dtype=np.int64)
    lanes = np.uint64(0x0101010101010101)
    for rows, hashes in _shingles(texts, words):
        for low in range(0, len(rows), 1 << 14):
            owner, some = rows[low:low + (1 << 14)], hashes[low:low + (1 << 14)]
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            sizes = np.diff(np.r_[first, len(owner)])
            np.add.at(count, owner[first], sizes)
            # A byte counts up to 255, so longer runs are cut.
            cuts = np.unique(np.concatenate([first, *[first[sizes > k] + k for k in range(255, int(sizes.max()), 255)]]))
            to = owner[cuts]
            for word in range(wide):
                mixed = _mixed(some, word)
                sums = np.stack([np.add.reduceat(mixed >> np.uint64(s) & lanes, cuts) for s in range(8)], axis=1)
                # Byte j of lane s counts bit 8j + s.
                bits = sums.astype("<u8").view(np.uint8).reshape(len(cuts), 8, 8).transpose(0, 2, 1)
                np.add.at(ones[:, word], to, bits.reshape(len(cuts), 64).astype(np.int32))
    major = (2 * ones > count[:, None, None]).astype(np.uint8)
    return np.packbits(major, axis=2, bitorder="little").view("<u8")[:, :, 0], count


def _print_batches(words: int):
    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for part in _sliced(batch, 1):
                bits, count = _wide_bits(part.column(1), FEATURE, WIDE)
                bits = np.concatenate([bits, _wide_bits(part.column(1), words, CHECKS)[0]], axis=1)
                prints = pa.array([row.tobytes() if n else None for row, n in zip(bits, count)], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), prints], ["at", "prints"])
    return batches


def _sliced(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with at most ``SLICE`` bytes of text, one row at least, 2048 at most."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    total, low = np.cumsum(sizes, dtype=np.int64), 0
    while low < batch.num_rows:
        base = total[low - 1] if low else 0
        high = min(max(int(np.searchsorted(total, base + SLICE, "right")), low + 1), low + 2048)
        yield batch.slice(low, high - low)
        low = min(high, batch.num_rows)


# -------------------------------------------------------------------- keys

def _codes(table: np.ndarray, prints: np.ndarray) -> np.ndarray:
    """Codeword indices of the 48 segments of each fingerprint."""
    parts = [(prints[:, :WIDE] >> np.uint64(low)).astype(np.int64) & ((1 << width) - 1) for low, width in SEGMENTS]
    return table[np.stack(parts, axis=2)].astype(np.int64).reshape(len(prints), -1)


def _pair_keys(table: np.ndarray, prints: np.ndarray) -> np.ndarray:
    """The 144 keys of each fingerprint: which pair of segments, and both indices."""
    code = _codes(table, prints)
    segments = code.shape[1]
    keys = []
    for k, step in enumerate(STEPS):
        family = np.arange(segments) + k * segments
        keys.append(family << 24 | code << 12 | np.roll(code, -step, axis=1))
    return np.concatenate(keys, axis=1)


def _key_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (node, prints, ...) under each of their keys, without the prints."""
    table = golay_indices()
    for batch in batches:
        for low in range(0, batch.num_rows, 1024):
            some = batch.slice(low, 1024)
            prints = np.frombuffer(b"".join(some.column(1).to_pylist()), dtype="<u8").reshape(some.num_rows, WIDE + CHECKS)
            keys = _pair_keys(table, prints)
            node = some.column(0).to_numpy(zero_copy_only=False)
            each = keys.shape[1]
            more = range(2, batch.num_columns)
            owner = pa.array(np.repeat(np.arange(some.num_rows), each)) if more else None
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.ravel()), pa.array(np.repeat(node, each)),
                 *[pa.array(np.repeat(prints[:, WIDE + k].view(np.int64), each)) for k in range(CHECKS)],
                 *[some.column(k).take(owner) for k in more]],
                ["key", "node", *CHECK, *[batch.schema.names[k] for k in more]])


CHECK = [f"check{k}" for k in range(CHECKS)]
MARK = [f"mark{k}" for k in range(MARKS)]


def _under_keys(nodes: DataFrame, more: str = "") -> DataFrame:
    """Each of ``nodes(node, prints, ...)`` under its keys; ``more`` tells the types of the other columns."""
    return nodes.mapInArrow(_key_batches, "key long, node long, " + ", ".join(f"{c} long" for c in CHECK) + more)


def _apart(other: str) -> Column:
    """Differing bits of the words for checks of a row and another, named by a prefix."""
    return sum(F.bit_count(F.col(c).bitwiseXOR(F.col(other + c))) for c in CHECK)


# ------------------------------------------------------------ verification

def _set_batches(words: int):
    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for part in _sliced(batch, 1):
                found = list(_shingles(part.column(1), words))
                rows = np.concatenate([np.zeros(0, np.int64), *[r for r, _ in found]])
                hashes = np.concatenate([np.zeros(0, np.int64), *[h.view(np.int64) for _, h in found]])
                order = np.lexsort((hashes, rows))
                rows, hashes = rows[order], hashes[order]
                new = np.r_[True, (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])][:len(rows)]
                rows, hashes = rows[new], hashes[new]
                ends = np.searchsorted(rows, np.arange(part.num_rows + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(hashes))], ["node", "shingles"])
    return batches


class _Verifier:
    """Compares pairs of nodes; the sets of a node's shingles are made once."""

    def __init__(self, texts: DataFrame, nodes: DataFrame, words: int, least: float):
        self.texts, self.nodes, self.words, self.least = texts, nodes, words, least
        self.sets = None

    def fill(self, ends: DataFrame) -> None:
        """Makes the sets of these nodes that are not there yet."""
        if self.sets is not None:
            ends = ends.join(self.sets.select("node"), "node", "left_anti")
        wanted, _ = staged(self.nodes.join(ends, "node", "left_semi").select("digest", "node"), "copy-wanted")
        small = wanted.count() <= BROADCAST
        # One text for each digest; equal digests are equal texts.
        some = self.texts.join(F.broadcast(wanted) if small else wanted, "digest").select("node", "text")
        sets = some.dropDuplicates(["node"]).mapInArrow(_set_batches(self.words), "node long, shingles array<long>")
        sets, _ = staged(sets, "copy-shingles")
        self.sets = sets if self.sets is None else self.sets.union(sets)

    def similar(self, pairs: DataFrame, filled: bool = False) -> DataFrame:
        """Those of the staged ``pairs(a, b)`` whose sets have at least the Jaccard similarity, staged.
        ``filled`` tells that their sets are there."""
        if not filled:
            self.fill(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct())
        left = self.sets.select(F.col("node").alias("a"), F.col("shingles").alias("s"))
        right = self.sets.select(F.col("node").alias("b"), F.col("shingles").alias("t"))
        shared = F.size(F.array_intersect("s", "t"))
        both = F.size("s") + F.size("t") - shared
        found = pairs.join(left, "a").join(right, "b").filter(shared >= both * F.lit(self.least))
        return staged(found.select("a", "b"), "copy-edges")[0]


# ------------------------------------------------------------------ groups

def _nodes(texts: DataFrame, words: int) -> DataFrame:
    """(node, digest, first, prints) of the different texts, staged so that the numbers hold."""
    prints = texts.select("digest", "text").mapInArrow(_print_batches(words), "at string, prints binary")
    first = texts.groupBy("digest").agg(F.min("doc_id").alias("first"))
    # The text is hashed where it lies; only digests and fingerprints are shuffled.
    prints = prints.groupBy(F.col("at").alias("digest")).agg(F.first("prints").alias("prints"))
    nodes = prints.join(first, "digest")
    return staged(nodes.select(F.monotonically_increasing_id().alias("node"), "digest", "first", "prints"), "copy-nodes")[0]


def _turned(check: str, bits: int) -> Column:
    return F.shiftleft(check, bits).bitwiseOR(F.shiftrightunsigned(check, 64 - bits)) if bits else F.col(check)


def _grouped(met: DataFrame, group: DataFrame) -> DataFrame:
    """The rows of ``met`` with their component so far."""
    return met.join(group, "node", "left").withColumn("component", F.coalesce("component", "node"))


def _pair(a: str, b: str) -> list[Column]:
    return [F.greatest(a, b).alias("a"), F.least(a, b).alias("b")]


def _alike(rows: DataFrame, *differ: str) -> DataFrame:
    """``rows`` without those that are like no other row of their key, of another value in
    ``differ``. Only keys of at most ``FEW`` rows, by the column ``n``, are looked through, the rest stay whole."""
    order = Window.partitionBy("key").orderBy("node")
    one = F.struct(*CHECK, *differ)
    others = {f"other{far % (2 * FEW)}": F.lag(one, far).over(order) for k in range(1, FEW) for far in (k, -k)}

    def like(other: str) -> Column:
        near = F.coalesce(_apart(other + ".") <= CHECKED, F.lit(False))
        return reduce(lambda met, c: met & (F.col(c) != F.col(f"{other}.{c}")), differ, near)

    near = reduce(lambda met, other: met | like(other), others, F.col("n") > FEW)
    return rows.withColumns(others).filter(near).drop(*others)


def _stars(met: DataFrame) -> DataFrame:
    """Each node with the node that meets most others among those it meets."""
    best = F.max(F.struct("meets", "node", *CHECK)).over(Window.partitionBy("key"))
    stars = met.select("node", *CHECK, best.alias("best"))
    stars = stars.filter((F.col("node") != F.col("best.node")) & (_apart("best.") <= CHECKED))
    stars = stars.groupBy("node").agg(F.max("best").alias("best")).select(F.col("best.node").alias("other"), "node")
    return stars.select(*_pair("node", "other")).distinct()


def _neighbours(rows: DataFrame, turn: int) -> DataFrame:
    """Each node with the likest of its neighbours in the order of its buckets' words for checks."""
    order = Window.partitionBy("key").orderBy(_turned("check0", 16 * turn), "node")
    one = F.struct("node", *CHECK, "component")
    rows = rows.select("node", *CHECK, "component", F.lag(one).over(order).alias("o"), F.lead(one).over(order).alias("p"))

    def near(other: str) -> Column:
        differ = F.col("component") != F.col(other + ".component")
        return F.when(differ & (_apart(other + ".") <= CHECKED), F.struct(_apart(other + ".").alias("apart"), F.col(other + ".node")))

    best = rows.select("node", F.least(near("o"), near("p")).alias("best")).filter("best IS NOT NULL")
    best = best.groupBy("node").agg(F.min("best").alias("best")).select("node", F.col("best.node").alias("other"))
    return best.select(*_pair("node", "other")).distinct()


def _shared(nodes: DataFrame, verifier: _Verifier) -> DataFrame:
    """(node, size, shared, marks): how many of a node's shingles another of ``nodes`` has too, and a bitmap of those."""
    verifier.fill(nodes)
    sets = verifier.sets.join(nodes, "node", "left_semi")
    each, _ = staged(sets.select("node", F.size("shingles").alias("size"), F.explode("shingles").alias("shingle")), "copy-each")
    twice = each.groupBy("shingle").count().filter("count > 1").select("shingle")
    word, bit = F.pmod(F.shiftright("shingle", 6), F.lit(MARKS)), F.expr("shiftleft(1L, CAST(shingle & 63 AS int))")
    marks = [F.coalesce(F.bit_or(F.when(word == k, bit)), F.lit(0)).cast("long").alias(c) for k, c in enumerate(MARK)]
    return each.join(twice, "shingle", "left_semi").groupBy("node", "size").agg(F.count("*").alias("shared"), *marks)


def _in_common(one: str, other: str) -> Column:
    """The most shingles that a row, named by a prefix, can have in common with another: each bit that the
    other's bitmap lacks stands for a shared shingle at least that the other lacks."""
    lacks = [F.bit_count(F.col(one + c).bitwiseAND(F.bitwise_not(F.col(other + c)))) for c in MARK]
    return F.col(one + "shared") - sum(lacks)


def _between(rows: DataFrame) -> DataFrame:
    """Rows of the keys of more than one component, with the key's number ``n`` of rows, that may be alike."""
    key = Window.partitionBy("key")
    rows = rows.withColumns({"n": F.count("*").over(key), "low": F.min("component").over(key), "high": F.max("component").over(key)})
    return _alike(rows.filter("low <> high").drop("low", "high"), "component")


def _crossing(rows: DataFrame, verifier: _Verifier) -> DataFrame:
    """All pairs of different components that share a key and may be alike: under each key all
    but the most frequent component's rows meet all rows.

    A pair has no more shingles in common than either text shares with any text that could be its
    partner, so a text of many shingles of its own is left out, whatever it shares with the rest of its group. A pair's
    bitmaps of those shared shingles bound what it has in common closer; what they leave out is below the similarity for certain.
    """
    mixed, _ = staged(_between(rows).select("node", "component").distinct(), "copy-mixed")
    shared, _ = staged(_shared(mixed.select("node"), verifier), "copy-shared")
    able = shared.filter(F.col("shared") >= F.col("size") * verifier.least - 1e-6)
    able = verifier.nodes.select("node", "prints").join(mixed.join(able, "node"), "node")
    able = _between(_under_keys(able, ", component long, size int, shared long, " + ", ".join(f"{c} long" for c in MARK)))
    rows = able.withColumn("count", F.count("*").over(Window.partitionBy("key", "component")))
    most = F.max(F.struct("count", "component")).over(Window.partitionBy("key"))
    rows, _ = staged(rows.withColumn("most", most["component"]).drop("n", "count"), "copy-able")

    def few(frame: DataFrame) -> DataFrame:
        few = frame.filter("component <> most").drop("most")
        return few.select("key", *[F.col(c).alias(f"few_{c}") for c in few.columns if c != "key"])

    cross = few(rows).join(rows, "key")
    cross = cross.filter("component <> few_component AND (component = most OR node > few_node)")
    enough = F.least(_in_common("", "few_"), _in_common("few_", "")) * (1 + verifier.least) >= (F.col("size") + F.col("few_size")) * verifier.least - 1e-6
    return cross.filter(enough & (_apart("few_") <= CHECKED)).select(*_pair("node", "few_node")).distinct()


def _links(texts: DataFrame, nodes: DataFrame, words: int, least: float) -> DataFrame:
    """(node, component) of the nodes that have links."""
    able = nodes.filter("prints IS NOT NULL").select("node", "prints")
    met = _under_keys(able).withColumn("n", F.count("*").over(Window.partitionBy("key"))).filter("n > 1")
    met, _ = staged(_alike(met), "copy-met")
    meets = met.groupBy("node").agg(F.sum("n").alias("meets"))
    verifier = _Verifier(texts, nodes, words, least)
    tested, _ = staged(_stars(met.join(meets, "node")), "copy-pairs")
    edges = verifier.similar(tested)
    met = met.select("key", "node", *CHECK)
    # Linear turns join most of a group, so that few of its pairs are left for the last.
    for turn in range(TURNS + 1):
        last, group = turn == TURNS, components(edges)
        rows = _grouped(met, group)
        pairs = _crossing(rows, verifier) if last else _neighbours(rows, turn)
        pairs, _ = staged(pairs.join(tested, ["a", "b"], "left_anti"), "copy-pairs")
        # Groups so far stand for the edges that made them.
        edges = group.toDF("a", "b").union(verifier.similar(pairs, filled=last))
        tested = tested.union(pairs)
    return components(edges)


def _with_digest(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.sha2(text, 256).alias("digest"), F.col("doc_id").cast("long"), text.alias("text"))


def near_copies(docs: DataFrame, words: int = WORDS, least: float = SIMILARITY) -> DataFrame:
    """(digest, first, component) of each different text of ``docs(doc_id, text)``.

    Texts link if the Jaccard similarity of their sets of ``words``-word shingles
    is at least ``least``; A to Z are lower-cased, words are runs without blanks, a text
    of fewer words is one shingle. ``digest`` is the SHA-256 of the text, a null
    counting as empty; ``first`` the smallest doc_id that has the text, null if none
    has one; ``component`` the digest of the member with the smallest ``first`` (nulls
    last, then the smallest digest). Texts without words link with equal
    ones only. An empty table gives an empty one.
    """
    return _near_copies(_with_digest(docs), words, least)


def _near_copies(texts: DataFrame, words: int, least: float) -> DataFrame:
    nodes = _nodes(texts, words)
    found = _links(texts, nodes, words, least)
    member = nodes.join(found, "node", "left").select("digest", "first", F.coalesce("component", "node").alias("label"))
    rank = F.struct(F.col("first").isNull(), "first", "digest")
    best = member.groupBy("label").agg(F.min_by("digest", rank).alias("component"))
    return member.join(best, "label").select("digest", "first", "component")


def keep_one_of_each(docs: DataFrame, words: int = WORDS, least: float = SIMILARITY) -> DataFrame:
    """One document of each group of near copies (see ``near_copies``), with all its columns.

    Of a group the row with the smallest doc_id stays (null ids last, then by the digest and a
    hash of the row). Rows are told apart by their text, not their id: different texts under
    one id are different documents, and equal rows are copies.
    """
    gone = _near_copies(_with_digest(docs), words, least).filter("digest <> component").select("digest")
    gone, _ = staged(gone, "copies")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.sha2(text, 256).alias("digest"), F.col("doc_id").alias("id"), packed(docs).alias("row"))
    rows = rows.join(gone, "digest", "left_anti")
    order = Window.partitionBy("digest").orderBy(F.asc_nulls_last("id"), F.xxhash64("row"))
    rows = rows.withColumn("place", F.row_number().over(order)).filter("place = 1")
    return rows.select(*unpacked("row", docs.columns))
