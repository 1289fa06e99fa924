"""How far the sources of a language differ in their words.

Terms are runs of letters (A-Z, a-z and all that is not ASCII), A-Z lower-cased.
A language keeps its terms in at least ``MIN_DOCS`` documents; every source of it
gives each of these V terms the share ``p = 1 + floor(10^9 (count + 5) / (N + 5 V))``,
the language itself the share ``q``. All arithmetic is exact.

Two sources are compared over all kept terms through a frequent-pattern tree. A
term is a row of nonzero (source, count) items in source order, smaller sources
first, since their small counts are shared most. Equal rows are one path with a
multiplicity. With ``b`` a source's share of a term it does not have,

    sum |p_s - p_t|  =  sum_s |p_s - b_t| + sum_t |p_t - b_s| - V |b_s - b_t|
                        + sum over both (|p_s - p_t| + |b_s - b_t| - |p_s - b_t| - |p_t - b_s|),

so only the last sum needs terms that both have: it is added up once for every
tree node and ancestor, times the node's multiplicity. As it is a sum over terms,
any split of the sorted paths gives the same result: paths are dealt by range,
which keeps shared prefixes together, and a task walks its sorted paths with one
stack, so memory is one path, however many terms or however frequent they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.staging import staged
from millrace.llm.tokens import pieces

MIN_DOCS, TOP = 30, 50
PIECE = 1 << 22
LETTERS = np.array([b >= 128 or chr(b).isalpha() for b in range(256)])
# Sums of this many node-ancestor pairs are put together before they leave a task.
HELD = 1 << 20


# ------------------------------------------------------------------- counts

def _terms(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.DictionaryArray:
    """The words as a dictionary array."""
    sizes = ends - starts
    step = np.zeros(len(data) + 1, dtype=np.int8)
    step[starts] += 1
    step[ends] -= 1
    letters = data[np.cumsum(step[:-1], dtype=np.int8).astype(bool)]
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(letters))
    return words.dictionary_encode()


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, text) to (lang, source, term, n, docs), added up a few
    megabytes at a time, and one row without a term for each group met."""
    names = ["lang", "source", "term", "n", "docs"]
    for batch in batches:
        if not batch.num_rows:
            continue
        pairs = pa.table([batch.column(0), batch.column(1)], ["lang", "source"])
        groups = pairs.group_by(["lang", "source"]).aggregate([])
        index = {pair: i for i, pair in enumerate(zip(groups["lang"].to_pylist(), groups["source"].to_pylist()))}
        group = np.array([index[p] for p in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())])
        lang, source = (groups[c].combine_chunks().cast(pa.string()) for c in ("lang", "source"))
        zero = pa.array(np.zeros(len(lang), np.int64))
        yield pa.RecordBatch.from_arrays([lang, source, pa.nulls(len(lang), pa.string()), zero, zero], names)
        before, seen = -1, set()
        for data, starts, ends, rows in pieces(batch.column(2), LETTERS, 0, PIECE):
            if not len(starts):
                continue
            coded = _terms(data, starts, ends)
            width = len(coded.dictionary)
            by_row, n = np.unique(rows.astype(np.int64) * width + coded.indices.to_numpy(), return_counts=True)
            row, code = np.divmod(by_row, width)
            docs = np.ones(len(row), dtype=np.int64)
            if row[0] == before:  # a long text goes on: its terms so far count no second document
                head = np.flatnonzero(row == before)
                again = coded.dictionary.take(pa.array(code[head])).to_pylist()
                docs[head] = [term not in seen for term in again]
            if row[-1] != before:
                before, seen = int(row[-1]), set()
            if row[0] == row[-1]:  # only a text alone in its piece can go on
                seen.update(coded.dictionary.to_pylist())
            key, at = np.unique(group[row] * width + code, return_inverse=True)
            who, what = np.divmod(key, width)
            yield pa.RecordBatch.from_arrays(
                [lang.take(pa.array(who)), source.take(pa.array(who)),
                 coded.dictionary.take(pa.array(what)).cast(pa.string()),
                 pa.array(np.bincount(at, n).astype(np.int64)), pa.array(np.bincount(at, docs).astype(np.int64))], names)


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs) of ``docs(text, lang, source)``: how often
    and in how many rows a group has a term; one row with a null term for each
    group. Null text, lang and source are ''."""
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")]
    found = docs.select(*text).mapInArrow(
        _count_batches, "lang string, source string, term string, n long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


# ------------------------------------------------------------------- shares

def _share(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(10^9 (n + 5) / (total + 5 kept)), exact for any counts; 0 where
    nothing is kept."""
    def wide(x):
        return x.cast("decimal(20,0)")

    parts = F.call_function("div", wide(n + 5) * F.lit(10**9).cast("decimal(10,0)"), wide(total + 5 * kept))
    return F.when(kept > 0, parts.cast("long") + 1).otherwise(F.lit(0).cast("long"))


def kept_terms(counts: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, term, total, parts array<(source, n)>) of each language's kept terms.

    ``parts`` has one entry for each source with the term, that is no more than
    the language has sources."""
    by_term = counts.filter("term IS NOT NULL").groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.collect_list(F.struct("source", "n")).alias("parts"))
    return by_term.filter(F.col("docs") >= min_docs).select("lang", "term", "total", "parts")


def group_shares(counts: DataFrame, kept: DataFrame) -> DataFrame:
    """(lang, source, size, kept, lang_size, base) of every group of documents."""
    size = kept.select("lang", F.explode("parts").alias("part"))
    size = size.groupBy("lang", "part.source").agg(F.sum("part.n").alias("size"))
    of_lang = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("total").alias("lang_size"))
    rows = counts.filter("term IS NULL").select("lang", "source")
    rows = rows.join(size, ["lang", "source"], "left").join(of_lang, "lang", "left").fillna(0)
    base = _share(F.lit(0), F.col("size"), F.col("kept")).alias("base")
    return rows.select("lang", "source", "size", "kept", "lang_size", base)


# --------------------------------------------------------------------- tree

def _tree_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted paths (lang, path, times) to sums (lang, source, item, value).

    The stack is the current path from the root; a node is done, and its pairs
    with all its ancestors are added up, when the walk leaves it."""
    codes: dict[str, int] = {}
    item: list[tuple] = []  # (source, n) of the nodes on the stack
    code, share, base = (np.zeros(64, np.int64) for _ in range(3))
    times: list[int] = []
    held: list[tuple[int, np.ndarray, np.ndarray]] = []
    at_lang, size = None, 0

    def leave(depth: int) -> None:
        nonlocal size
        while len(item) > depth:
            k, m = len(item) - 1, times[-1]
            if k:
                p, b = share[k], base[k]
                both = np.abs(p - share[:k]) + np.abs(b - base[:k]) - np.abs(p - base[:k]) - np.abs(share[:k] - b)
                held.append((int(code[k]), code[:k].copy(), m * both))
                size += k
                times[-2] += m
            item.pop()
            times.pop()

    def out() -> pa.RecordBatch:
        nonlocal held, size
        names = list(codes)
        left = np.repeat(np.array([h[0] for h in held]), [len(h[1]) for h in held])
        right = np.concatenate([h[1] for h in held])
        key, at = np.unique(left * len(names) + right, return_inverse=True)
        value = np.zeros(len(key), np.int64)
        np.add.at(value, at, np.concatenate([h[2] for h in held]))
        held, size = [], 0
        some = [pa.array([names[i] for i in side], pa.string()) for side in np.divmod(key, len(names))]
        return pa.RecordBatch.from_arrays(
            [pa.array([at_lang] * len(key), pa.string()), *some, pa.array(value)], ["lang", "source", "item", "value"])

    for batch in batches:
        path = batch.column(1)
        bounds = path.offsets.to_numpy()
        flat = path.values
        sources, counts, shares, bases = (flat.field(f) for f in ("source", "n", "p", "base"))
        sources, counts = sources.to_pylist(), counts.to_pylist()
        shares, bases = shares.to_numpy(), bases.to_numpy()
        for r, (lang, m) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())):
            low, high = int(bounds[r]), int(bounds[r + 1])
            if lang != at_lang:
                leave(0)
                if size:
                    yield out()
                at_lang = lang
                codes.clear()
            same = 0
            while same < len(item) and low + same < high and item[same] == (sources[low + same], counts[low + same]):
                same += 1
            leave(same)
            while high - low > len(code):
                code, share, base = (np.concatenate([a, np.zeros_like(a)]) for a in (code, share, base))
            for k in range(same, high - low):
                item.append((sources[low + k], counts[low + k]))
                code[k] = codes.setdefault(sources[low + k], len(codes))
                share[k], base[k] = shares[low + k], bases[low + k]
                times.append(0)
            if times:
                times[-1] += m
            if size >= HELD:
                yield out()
    leave(0)
    if size:
        yield out()


def shared_terms(entries: DataFrame) -> DataFrame:
    """(lang, source, item, value): the tree's sum for pairs of sources, each
    pair once, over the terms that both have. ``entries`` is one row (lang, term,
    source, n, p, size, base) for each nonzero count."""
    part = F.struct("size", "source", "n", "p", "base")
    rows = entries.groupBy("lang", "term").agg(F.sort_array(F.collect_list(part)).alias("path"))
    paths, _ = staged(rows.groupBy("lang", "path").agg(F.count(F.lit(1)).alias("times")), "term-paths")
    # The first items place a path: what the driver samples for the ranges stays a few numbers a row.
    begin = F.transform(F.slice("path", 1, 3), lambda x: F.struct(x["size"], x["n"]))
    dealt = paths.repartitionByRange("lang", begin).sortWithinPartitions("lang", "path")
    return dealt.mapInArrow(_tree_batches, "lang string, source string, item string, value long")


# ------------------------------------------------------------------ results

def _ranked(rows: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value",
                       F.row_number().over(order).alias("rank"))


def pair_distances(entries: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value): the sum of |p_s - p_t| over the kept terms
    for every ordered pair of a language's sources. The result has one row for
    each pair; the shares joined to it are first counted by value."""
    other = groups.select("lang", F.col("source").alias("item"), F.col("base").alias("other"))
    base = groups.join(other, "lang").filter("source <> item").select(
        "lang", "source", "item", (-F.col("kept") * F.abs(F.col("base") - F.col("other"))).alias("value"))
    some = entries.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("times"))
    held = entries.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("held"))
    none = groups.join(held, ["lang", "source"], "left").select(
        "lang", "source", F.col("base").alias("p"), (F.col("kept") - F.coalesce("held", F.lit(0))).alias("times"))
    single = some.unionByName(none).join(other, "lang").filter("source <> item")
    single = single.groupBy("lang", "source", "item").agg(
        F.sum(F.col("times") * F.abs(F.col("p") - F.col("other"))).alias("value"))

    def turned(rows: DataFrame) -> DataFrame:
        return rows.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")

    shared = shared_terms(entries)
    every = base.unionByName(single).unionByName(turned(single)).unionByName(shared).unionByName(turned(shared))
    return every.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank) of ``docs(text, lang, source)``.

    Part ``pair``: every other source of the language by falling distance. Part
    ``term``: the group's terms that it uses more than its language does, by
    falling p - q, to rank ``top``. Equals come in the order of their UTF-8 bytes.

    Null text, lang and source are ''; rows without terms still make their group
    known. A language that keeps no term has distance 0 throughout. Repeated rows
    count as often as they come; an empty table gives an empty result. Other
    columns are ignored.
    """
    counts, _ = staged(term_counts(docs), "term-counts")
    kept, _ = staged(kept_terms(counts, min_docs), "kept-terms")
    groups, _ = staged(group_shares(counts, kept), "group-shares")
    entries = kept.select("lang", "term", "total", F.explode("parts").alias("part"))
    entries = entries.select("lang", "term", "total", "part.source", "part.n").join(groups, ["lang", "source"])
    p = _share(F.col("n"), F.col("size"), F.col("kept"))
    q = _share(F.col("total"), F.col("lang_size"), F.col("kept"))
    entries, _ = staged(entries.select("lang", "source", "term", "n", "size", "base", p.alias("p"), q.alias("q")), "term-shares")
    pairs = _ranked(pair_distances(entries, groups), "pair")
    more = entries.filter("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    return pairs.unionByName(_ranked(more, "term").filter(F.col("rank") <= top))


# --------------------------------------------------------------- DuckDB SQL

SQL = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS id, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source
  FROM documents
), words AS (
  SELECT id, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM docs
), counts AS MATERIALIZED (
  SELECT lang, source, term, count(*) AS n, count(DISTINCT id) AS docs FROM words GROUP BY ALL
), kept AS MATERIALIZED (
  SELECT lang, term, sum(n)::HUGEINT AS total FROM counts GROUP BY ALL HAVING sum(docs) >= {MIN_DOCS}
), langs AS (
  SELECT lang, count(*) AS v, sum(total) AS lang_size FROM kept GROUP BY ALL
), cells AS MATERIALIZED (
  SELECT g.lang, g.source, k.term, k.total, coalesce(c.n, 0)::HUGEINT AS n,
    sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source)::HUGEINT AS size, v, lang_size
  FROM (SELECT DISTINCT lang, source FROM docs) g JOIN kept k USING (lang) JOIN langs USING (lang)
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), shares AS MATERIALIZED (
  SELECT lang, source, term, n, 1 + 1000000000 * (n + 5) // (size + 5 * v) AS p,
    1 + 1000000000 * (total + 5) // (lang_size + 5 * v) AS q FROM cells
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(x.value, 0) AS value
  FROM (SELECT DISTINCT lang, source FROM docs) a
  JOIN (SELECT DISTINCT lang, source FROM docs) b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (
    SELECT s.lang, s.source, t.source AS item, sum(abs(s.p - t.p)) AS value FROM shares s
    JOIN shares t ON s.lang = t.lang AND s.term = t.term AND s.source <> t.source GROUP BY ALL
  ) x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
), parts AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs
  UNION ALL SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value::BIGINT AS value,
  (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
FROM parts QUALIFY part = 'pair' OR rank <= {TOP}
"""
