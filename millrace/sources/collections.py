"""Stored collections: versioned folders behind catalog tables, and listings."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from millrace.operators import documents
from millrace.session import plan_size, shared_dir


def _require(database: str, collection: str = "x") -> None:
    if not database:
        raise ValueError("database name is required")
    if not collection:
        raise ValueError("database and collection names are required")


def ensure_database(spark: SparkSession, name: str) -> None:
    """Create a database whose folder all executors can reach."""
    if not spark.catalog.databaseExists(name):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION '{shared_dir(spark, name)}'")


class Collection:
    """A named collection. An insert adds files; an update or delete makes a new
    folder and then points the table at it, so a folder being read is never
    overwritten."""

    def __init__(self, spark: SparkSession, database: str, name: str, root: str | None = None):
        _require(database, name)
        self.spark, self.database, self.name = spark, database, name
        self.root = root or shared_dir(spark, f"{database}-{name}")
        self.id_column = "_id"

    @property
    def table(self) -> str:
        return f"`{self.database}`.`{self.name}`"

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(f"{self.database}.{self.name}")

    def read(self) -> DataFrame:
        if not self.exists():
            return self.spark.createDataFrame([], documents.schema_of_collection())
        return self.spark.table(self.table)

    def replace(self, rows: DataFrame) -> None:
        path = f"{self.root}/v-{uuid.uuid4().hex}"
        rows.write.parquet(path)
        ensure_database(self.spark, self.database)
        if self.exists():
            self.spark.sql(f"ALTER TABLE {self.table} SET LOCATION '{path}'")
            self.spark.catalog.refreshTable(self.table)
        else:
            columns = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes)
            self.spark.sql(f"CREATE TABLE {self.table} ({columns}) USING parquet LOCATION '{path}'")

    def insert_one(self, document) -> None:
        self.insert_many(documents.one_document(self.spark, document))

    def insert_many(self, texts: DataFrame) -> None:
        """Adds files and rewrites none; an ``_id`` that is taken is refused."""
        held = self.read()
        fresh = documents.parsed(texts, held.schema["_id"].dataType)
        ids = fresh.select("_id")
        taken = ids.groupBy("_id").count().filter("count > 1").select("_id")
        taken = taken.union(ids.join(held.select("_id"), "_id", "left_semi"))
        if first := taken.first():
            raise ValueError(f"duplicate _id: {first['_id']}")
        if self.exists():
            fresh.select(*held.columns).write.insertInto(self.table)
        else:
            self.replace(fresh)

    def find(self, query=None, sort=None, skip: int = 0, limit: int = 0) -> DataFrame:
        return documents.find(self.read(), query, sort, skip, limit, self.id_column)

    def count(self, query=None) -> int:
        return documents.count(self.read(), query).first()["count"]

    def update(self, query, change, many: bool = False, upsert: bool = False) -> dict:
        done = documents.update(self.read(), query, change, many, upsert, self.id_column)
        counts = done.counts.first().asDict()
        if counts["modified_count"] or counts["upserted_count"]:
            self.replace(done.rows)
        return counts

    def delete(self, query, many: bool = False) -> int:
        rows = self.read()
        gone = documents.deleted_count(rows, query, many, self.id_column).first()[0]
        if gone:
            self.replace(documents.delete(rows, query, many, self.id_column))
        return gone


def list_collections(spark: SparkSession, database: str) -> DataFrame:
    """Name and kind of each collection (catalog entries, not rows)."""
    _require(database)
    rows = [(t.name, t.tableType.lower()) for t in spark.catalog.listTables(database)]
    return spark.createDataFrame(rows, "name string, type string")


def list_databases(spark: SparkSession) -> DataFrame:
    """Name, size on disk and emptiness of each database."""
    rows = []
    for db in spark.catalog.listDatabases():
        tables = [t for t in spark.catalog.listTables(db.name) if not t.isTemporary]
        sizes = [plan_size(spark.table(f"`{db.name}`.`{t.name}`")) for t in tables]
        rows.append((db.name, sum(sizes), not tables))
    return spark.createDataFrame(rows, "name string, size_on_disk bigint, empty boolean")
