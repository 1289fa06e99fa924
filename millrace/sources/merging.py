"""Collections whose updates and deletes write what they change.

Rows lie in Parquet files under ``data/mr_op=<write>/mr_bucket=<hash of the id>``.
A delete writes the positions of its rows (write, bucket, file, row number), an
update those of the old rows and the new rows; no file is rewritten. A numbered
log entry says which writes count, and making the next one is what commits: of
two writers that start from the same version the second is refused. Readers keep
the version they began with.

Reading leaves deleted positions out with an anti-join, in those (write, bucket)
parts only that have any; the others are plain scans. ``compact`` rewrites the
parts with many deleted rows, ``vacuum`` removes what no version in use needs.

An id lies in one bucket, its files are sorted by id and carry Bloom filters, so
an insert looks for taken ids in the buckets it meets and a filter on the id
reads one bucket.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, replace

from pyspark.errors.exceptions.base import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import documents
from millrace.session import shared_dir

OP, BUCKET, FILE, ROW = "mr_op", "mr_bucket", "mr_file", "mr_row"
PLACE = [OP, BUCKET, FILE, ROW]
BUCKETS = 32
# Up to so many new ids are looked up by value, so that the scan can skip row groups.
FEW_IDS = 1000


class Conflict(Exception):
    """Someone else has written to the collection meanwhile."""


@dataclass(frozen=True)
class Version:
    """What one log entry says: the writes that hold rows and deleted positions,
    the (write, bucket) parts with deleted rows, and those rewritten elsewhere."""

    number: int
    schema: T.StructType
    buckets: int
    data: tuple[str, ...] = ()
    deletes: tuple[str, ...] = ()
    touched: frozenset[str] = frozenset()
    dropped: frozenset[str] = frozenset()

    def text(self) -> str:
        return json.dumps({
            "schema": self.schema.jsonValue(), "buckets": self.buckets, "data": self.data,
            "deletes": self.deletes, "touched": sorted(self.touched), "dropped": sorted(self.dropped),
        })


def _part() -> Column:
    return F.concat_ws("/", OP, F.col(BUCKET).cast("string"))


class MergedCollection:
    """A collection of typed rows or ``(_id, doc)`` documents, merged on read."""

    def __init__(self, spark: SparkSession, root: str | None = None, id_column: str = "_id"):
        self.spark, self.id_column = spark, id_column
        self.root = root or shared_dir(spark, "merged")

    # ------------------------------------------------------------------ log

    def _fs(self, path: str):
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark._jsc.hadoopConfiguration()), target

    def version(self) -> Version | None:
        """The newest version, or None before the first write."""
        fs, log = self._fs(f"{self.root}/log")
        if not fs.exists(log):
            return None
        names = [s.getPath().getName() for s in fs.listStatus(log)]
        numbers = [int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()]
        if not numbers:
            return None
        path = f"{self.root}/log/{max(numbers):012d}.json"
        entry = json.loads(self.spark.read.text(path, wholetext=True).first()[0])
        return Version(
            max(numbers), T.StructType.fromJson(entry["schema"]), entry["buckets"], tuple(entry["data"]),
            tuple(entry["deletes"]), frozenset(entry["touched"]), frozenset(entry["dropped"]),
        )

    def _commit(self, version: Version) -> None:
        """Make a log entry; there can be one of each number."""
        fs, path = self._fs(f"{self.root}/log/{version.number:012d}.json")
        try:
            out = fs.create(path, False)
        except Exception as error:
            raise Conflict(f"version {version.number} exists already") from error
        try:
            out.write(bytearray(version.text().encode()))
        finally:
            out.close()

    def exists(self) -> bool:
        return self.version() is not None

    # ---------------------------------------------------------------- reads

    def _stored(self, version: Version) -> DataFrame:
        """All rows of the version's writes with their places, deleted or not."""
        fields = [*version.schema.fields, T.StructField(OP, T.StringType()), T.StructField(BUCKET, T.IntegerType())]
        rows = self.spark.read.schema(T.StructType(fields)).parquet(f"{self.root}/data")
        rows = rows.filter(F.col(OP).isin(list(version.data)))
        if version.dropped:
            rows = rows.filter(~_part().isin(sorted(version.dropped)))
        return rows.withColumns({FILE: F.col("_metadata.file_name"), ROW: F.col("_metadata.row_index")})

    def _live(self, version: Version, buckets: list[int] | None = None) -> DataFrame:
        """The rows that count, with their places."""
        rows = self._stored(version)
        if buckets is not None:
            rows = rows.filter(F.col(BUCKET).isin(buckets))
        if not version.touched:
            return rows
        marked = _part().isin(sorted(version.touched))
        gone = self.spark.read.schema(f"{FILE} string, {ROW} bigint, {OP} string, {BUCKET} int, by string").parquet(
            f"{self.root}/deletes")
        gone = gone.filter(F.col("by").isin(list(version.deletes)) & marked)
        if buckets is not None:
            gone = gone.filter(F.col(BUCKET).isin(buckets))
        rest = rows.filter(marked).join(gone.select(*PLACE), PLACE, "left_anti")
        return rows.filter(~marked).unionByName(rest.select(*rows.columns))

    def read(self) -> DataFrame:
        version = self.version()
        if version is None:
            return self.spark.createDataFrame([], documents.schema_of_collection())
        return self._live(version).select(*_quoted(version.schema.names))

    def find(self, query=None, sort=None, skip: int = 0, limit: int = 0) -> DataFrame:
        version = self.version()
        if version is None:
            return documents.find(self.read(), query, sort, skip, limit, self.id_column)
        rows = self._live(version, self._buckets_of(version, query))
        return documents.find(rows.select(*_quoted(version.schema.names)), query, sort, skip, limit, self.id_column)

    def count(self, query=None) -> int:
        return self.find(query).count()

    def _buckets_of(self, version: Version, query) -> list[int] | None:
        """The one bucket a filter on a single id needs, or None."""
        pinned = documents._equalities(documents._spec(query))
        value = pinned.get(self.id_column)
        if value is None or isinstance(value, (dict, list)):
            return None
        kind = version.schema[self.id_column].dataType
        try:
            key = F.lit(value).cast(kind)
            return [self.spark.range(1).select(_bucket(key, version.buckets)).first()[0]]
        except PySparkException:  # no value of the id's type; the filter will say so
            return None

    # --------------------------------------------------------------- writes

    def _write_rows(self, rows: DataFrame, buckets: int) -> str:
        """A new write of rows, in no version yet."""
        op = uuid.uuid4().hex
        placed = rows.withColumn(BUCKET, _bucket(F.col(f"`{self.id_column}`"), buckets))
        placed = placed.hint("rebalance", BUCKET).sortWithinPartitions(BUCKET, F.col(f"`{self.id_column}`"))
        writer = placed.write.partitionBy(BUCKET)
        # Filters as large as their row groups need; a fixed size would outweigh small writes.
        writer = writer.option(f"parquet.bloom.filter.enabled#{self.id_column}", "true")
        writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
        writer.parquet(f"{self.root}/data/{OP}={op}")
        return op

    def _write_places(self, places: DataFrame) -> str:
        by = uuid.uuid4().hex
        places.select(*PLACE).write.parquet(f"{self.root}/deletes/by={by}")
        return by

    def _drop(self, path: str) -> None:
        fs, target = self._fs(path)
        fs.delete(target, True)

    def insert_one(self, document) -> None:
        self.insert_many(documents.one_document(self.spark, document))

    def insert_many(self, texts: DataFrame) -> None:
        """Add JSON documents; an ``_id`` that is taken is refused."""
        version = self.version()
        schema = version.schema if version else documents.schema_of_collection()
        self.insert(documents.parsed(texts, schema["_id"].dataType))

    def insert(self, rows: DataFrame, buckets: int = BUCKETS) -> None:
        """Add rows; an id that is taken is refused and nothing changes. ``buckets``
        counts for the first write. Null ids are not compared."""
        if clash := {c.lower() for c in rows.columns} & {*PLACE}:
            raise ValueError(f"reserved column names: {sorted(clash)}")
        version = self.version() or Version(-1, _nullable(rows.schema), buckets)
        rows = rows.select(*_quoted(version.schema.names))
        op = self._write_rows(rows, version.buckets)
        taken = self._taken(version, op)
        if taken is not None:
            self._drop(f"{self.root}/data/{OP}={op}")
            raise ValueError(f"duplicate {self.id_column}: {taken}")
        self._commit(replace(version, number=version.number + 1, data=(*version.data, op)))

    def _taken(self, version: Version, op: str):
        """An id of the new write that is there twice or in the version already."""
        name = f"`{self.id_column}`"
        new = self._stored(replace(version, data=(op,), dropped=frozenset())).filter(f"{name} IS NOT NULL")
        twice = new.groupBy(name).count().filter("count > 1").first()
        if twice is not None:
            return twice[0]
        if not version.data:
            return None
        met = [r[0] for r in new.select(BUCKET).distinct().collect()]
        held = self._live(version, met).select(name)
        some = [r[0] for r in new.select(name).limit(FEW_IDS + 1).collect()]
        if len(some) <= FEW_IDS:
            found = held.filter(F.col(name).isin(some)).first()
        else:
            found = held.join(new.select(name), self.id_column, "left_semi").first()
        return found[0] if found is not None else None

    def _hits(self, version: Version, query, many: bool) -> DataFrame:
        """The rows an operation applies to, with their places: all matches, or
        the first by id and place. Rows with a null id are never the one."""
        rows = documents.matching(self._live(version, self._buckets_of(version, query)), query)
        if many:
            return rows
        own = rows.filter(F.col(f"`{self.id_column}`").isNotNull())
        first = own.agg(F.min(F.struct(f"`{self.id_column}`", *PLACE))).first()[0]
        if first is None:
            return rows.filter(F.lit(False))
        place = [F.col(c) == first[c] for c in PLACE]
        return rows.filter(place[0] & place[1] & place[2] & place[3])

    def update(self, query, change, many: bool = False, upsert: bool = False) -> dict:
        """As ``documents.update``; what is written grows with the rows that change."""
        version = self.version()
        if version is None:
            version = Version(-1, documents.schema_of_collection(), BUCKETS)
            hits = self.read().select("*", *[F.lit(None).alias(c) for c in PLACE])
        else:
            hits = self._hits(version, query, many)
        changes = documents._updates(change)
        plain = hits.select(*_quoted(version.schema.names))
        new, differs = documents._with_changes(plain, changes)
        names = [*version.schema.names, *[n for n in new if n not in version.schema.names]]
        after = [new[n].alias(n) if n in new else F.col(f"`{n}`") for n in names]
        path = f"{self.root}/work/{uuid.uuid4().hex}"
        hits.select(F.struct(*after).alias("row"), differs.alias("differs"), *PLACE).write.parquet(path)
        found = self.spark.read.parquet(path)
        matched, modified = found.agg(F.count("*"), F.count_if("differs")).first()
        counts = {"matched_count": matched, "modified_count": modified, "upserted_count": 0}
        schema = _nullable(found.schema["row"].dataType)
        following = replace(version, number=version.number + 1, schema=schema)
        if modified:
            changed = found.filter("differs")
            op = self._write_rows(changed.select("row.*"), version.buckets)
            self._commit(self._without(following, changed, (op,)))
        elif upsert and not matched:
            counts["upserted_count"] = 1
            made = documents.update(
                self.spark.createDataFrame([], schema), query, change, many, True, self.id_column).rows
            op = self._write_rows(made.select(*_quoted(schema.names)), version.buckets)
            self._commit(replace(following, data=(*version.data, op)))
        self._drop(path)
        return counts

    def delete(self, query, many: bool = False) -> int:
        """Number of rows deleted; only their places are written."""
        version = self.version()
        if version is None:
            return 0
        path = f"{self.root}/work/{uuid.uuid4().hex}"
        self._hits(version, query, many).select(*PLACE).write.parquet(path)
        found = self.spark.read.parquet(path)
        gone = found.count()
        if gone:
            self._commit(self._without(replace(version, number=version.number + 1), found, ()))
        self._drop(path)
        return gone

    def _without(self, version: Version, places: DataFrame, added: tuple[str, ...]) -> Version:
        """A version without the rows at some places and with other writes. The
        parts met, at most a write's buckets each, are noted in the log."""
        by = self._write_places(places)
        parts = {r[0] for r in places.select(_part()).distinct().collect()}
        return replace(
            version, data=(*version.data, *added), deletes=(*version.deletes, by),
            touched=version.touched | parts,
        )

    # ---------------------------------------------------------- maintenance

    def deleted_shares(self) -> DataFrame:
        """(mr_op, mr_bucket, stored, live) of the parts that have deleted rows."""
        version = self.version()
        some = _part().isin(sorted(version.touched))
        stored = self._stored(version).filter(some).groupBy(OP, BUCKET).agg(F.count("*").alias("stored"))
        live = self._live(version).filter(some).groupBy(OP, BUCKET).agg(F.count("*").alias("live"))
        return stored.join(live, [OP, BUCKET], "left").fillna(0, ["live"])

    def compact(self, share: float = 0.2) -> int:
        """Rewrite the parts of which at least ``share`` is deleted; their number.
        The same rows are read before and after."""
        version = self.version()
        if version is None or not version.touched:
            return 0
        worn = self.deleted_shares().filter(F.col("stored") - F.col("live") >= share * F.col("stored"))
        parts = {f"{r[OP]}/{r[BUCKET]}" for r in worn.select(OP, BUCKET).collect()}
        if not parts:
            return 0
        rows = self._live(version).filter(_part().isin(sorted(parts)))
        op = self._write_rows(rows.select(*_quoted(version.schema.names)), version.buckets)
        touched = version.touched - parts
        self._commit(replace(
            version, number=version.number + 1, data=(*version.data, op), touched=touched,
            dropped=version.dropped | parts, deletes=version.deletes if touched else (),
        ))
        return len(parts)

    def vacuum(self) -> None:
        """Remove files that the newest version does not need. Older versions and
        writes under way must not be in use any more."""
        version = self.version()
        if version is None:
            return
        keep = {f"data/{OP}={op}" for op in version.data} | {f"deletes/by={by}" for by in version.deletes}
        for folder in ("data", "deletes", "work"):
            fs, path = self._fs(f"{self.root}/{folder}")
            for entry in fs.listStatus(path) if fs.exists(path) else []:
                if f"{folder}/{entry.getPath().getName()}" not in keep:
                    fs.delete(entry.getPath(), True)
        for part in version.dropped:
            op, bucket = part.split("/")
            self._drop(f"{self.root}/data/{OP}={op}/{BUCKET}={bucket}")

    def bytes_stored(self) -> int:
        """Bytes of all data and delete files, those of old versions included."""
        total = 0
        for folder in ("data", "deletes"):
            fs, path = self._fs(f"{self.root}/{folder}")
            if fs.exists(path):
                total += fs.getContentSummary(path).getLength()
        return total


def _bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _quoted(names: list[str]) -> list[str]:
    return [f"`{n}`" for n in names]


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])


def stored(rows: DataFrame, id_column: str, buckets: int = BUCKETS, root: str | None = None) -> MergedCollection:
    """A new collection that holds the given rows."""
    made = MergedCollection(rows.sparkSession, root, id_column)
    made.insert(rows, buckets)
    return made



