"""Full-text search: an inverted index built by shuffles, ranked by BM25.

Terms are runs of ASCII letters and digits and of all that is not ASCII, with A-Z
lower-cased. The index is three tables: postings (term, id, times), sorted by
term so that a search reads the row groups of its terms only; terms (term,
documents); and one row of totals. No posting list is ever gathered: a search
filters, joins the few terms it has and sums by document.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import documents
from millrace.session import shared_dir

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# What lies between terms. Texts are split at it, which took a sixth of the time of
# extracting all matches.
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
# The usual weights of BM25: saturation of repeats, and of length.
K1, B = 1.2, 0.75
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lowered(text: Column) -> Column:
    return F.translate(text, _UPPER, _UPPER.lower())


def words(text: Column) -> Column:
    """The terms of a text, in order."""
    return F.filter(F.split(lowered(text), f"{GAP}+"), lambda term: term != "")


def phrase_test(phrase: tuple[str, ...]) -> str:
    """A pattern that finds a phrase's terms, whole and one after the other."""
    cased = lambda c: f"[{c}{c.upper()}]" if "a" <= c <= "z" else c
    terms = f"{GAP}++".join("".join(map(cased, term)) for term in phrase)
    return f"(?:^|{GAP}){terms}(?:{GAP}|\\z)"


def _terms(text: str) -> list[str]:
    """The terms of a search text, in order."""
    return [t.translate(str.maketrans(_UPPER, _UPPER.lower())) for t in re.findall(TERM, text)]


@dataclass(frozen=True)
class Search:
    """Any of ``terms``, all ``phrases``, none of ``without``."""

    terms: tuple[str, ...]
    phrases: tuple[tuple[str, ...], ...]
    without: tuple[str, ...]


def parsed(text: str) -> Search:
    """Words, "quoted phrases" and -excluded words."""
    phrases = [tuple(_terms(p)) for p in re.findall(r'"([^"]*)"', text)]
    rest = re.sub(r'"[^"]*"', " ", text).split()
    without = [t for w in rest if w.startswith("-") for t in _terms(w)]
    terms = [t for w in rest if not w.startswith("-") for t in _terms(w)]
    phrases = [p for p in phrases if p]
    terms += [t for p in phrases for t in p]
    return Search(tuple(dict.fromkeys(terms)), tuple(phrases), tuple(dict.fromkeys(without)))


class TextIndex:
    """An index over one text column, by the id of its rows.

    Rows that share an id are one document; rows with a null id or text are not
    indexed. An index is as of its building.
    """

    def __init__(self, spark: SparkSession, path: str, id_column: str, text: str):
        self.spark, self.path, self.id_column, self.text = spark, path, id_column, text

    @classmethod
    def build(cls, df: DataFrame, id_column: str, text: str, path: str | None = None) -> TextIndex:
        spark = df.sparkSession
        index = cls(spark, path or shared_dir(spark, "text-index"), id_column, text)
        rows = df.filter(F.col(id_column).isNotNull() & F.col(text).isNotNull())
        counted = rows.select(F.col(id_column).alias("id"), F.explode(words(F.col(text))).alias("term"))
        counted = counted.groupBy("term", "id").agg(F.count("*").alias("times"))
        # A frequent term may fill several ranges: the id breaks it up.
        counted = counted.repartitionByRange("term", "id").sortWithinPartitions("term", "id")
        counted.write.parquet(f"{index.path}/postings")
        held = index.postings()
        by_term = held.groupBy("term").agg(F.count("*").alias("documents"))
        by_term.repartitionByRange("term").sortWithinPartitions("term").write.parquet(f"{index.path}/terms")
        lengths = held.groupBy("id").agg(F.sum("times").alias("length"))
        lengths.write.parquet(f"{index.path}/lengths")
        every = rows.agg(F.count_distinct(id_column).alias("documents"))
        total = held.agg(F.coalesce(F.sum("times"), F.lit(0)).alias("words"))
        every.select("documents", F.lit(1).alias("one")).join(
            F.broadcast(total.select("words", F.lit(1).alias("one"))), "one"
        ).drop("one").write.parquet(f"{index.path}/totals")
        return index

    def postings(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/postings")

    def _totals(self) -> tuple[int, float]:
        row = self.spark.read.parquet(f"{self.path}/totals").first()
        return row["documents"], row["words"] / max(row["documents"], 1)

    def scores(self, text: str) -> DataFrame:
        """(id, score) of the documents with any of the terms and none of the
        excluded ones. Phrases count as their words here (see ``find``)."""
        search = parsed(text)
        documents_, mean = self._totals()
        hits = self.postings().filter(F.col("term").isin(list(search.terms)))
        # At most one row for each term of the search.
        terms = self.spark.read.parquet(f"{self.path}/terms").filter(F.col("term").isin(list(search.terms)))
        lengths = self.spark.read.parquet(f"{self.path}/lengths")
        rare = F.log(1 + (F.lit(documents_) - F.col("documents") + 0.5) / (F.col("documents") + 0.5))
        long = 1 - B + B * F.col("length") / F.lit(max(mean, 1e-9))
        weight = rare * F.col("times") * (K1 + 1) / (F.col("times") + K1 * long)
        found = hits.join(F.broadcast(terms), "term").join(lengths, "id")
        found = found.groupBy("id").agg(F.sum(weight).alias("score"))
        if search.without:
            out = self.postings().filter(F.col("term").isin(list(search.without))).select("id").distinct()
            found = found.join(out, "id", "left_anti")
        return found

    def find(self, df: DataFrame, query: Mapping) -> DataFrame:
        """The rows of ``df`` that pass a filter with ``$text``, with their ``score``.

        ``{"$text": {"$search": "red \\"old town\\" -sea"}, ...}``: the other parts
        are a plain filter, phrases are looked up in the rows found."""
        rest = dict(query)
        text = rest.pop("$text")["$search"]
        rows = documents.matching(df, rest) if rest else df
        if "score" in rows.columns:
            raise ValueError("the rows have a column named score already")
        found = rows.join(self.scores(text).withColumnRenamed("id", self.id_column), self.id_column)
        for phrase in parsed(text).phrases:
            found = found.filter(F.rlike(F.col(self.text), F.lit(phrase_test(phrase))))
        return found.select(*df.columns, "score")
