"""Document collections: find, insert, update and delete over DataFrames.

A collection is a typed table with an id column, or a frame ``(_id, doc)`` with
``doc`` a VARIANT. Filters and updates are the usual JSON documents. Writes
return the new contents; ``Collection`` in ``millrace.sources.collections``
stores them as a new version and moves the pointer.
"""

from __future__ import annotations

import json
import logging
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.fields import (
    DocFields, ElementFields, add_to, append_to, as_variant, fields_of, set_path, unset_path,
    variant_kind,
)
from millrace.session import shared_dir

log = logging.getLogger(__name__)

# Supported comparison operators and the comparison they make.
_ORDER = {"$gt": "gt", "$gte": "gte", "$lt": "lt", "$lte": "lte"}
_UPDATES = ("$set", "$unset", "$inc", "$push")
# Type names a filter may ask for, and their numbers.
_TYPES = {
    1: "double", 2: "string", 3: "object", 4: "array", 5: "binData", 8: "bool", 9: "date",
    10: "null", 16: "int", 18: "long", 19: "decimal",
}


def _spec(value: str | Mapping | None) -> dict:
    if value in (None, ""):
        return {}
    parsed = json.loads(value) if isinstance(value, str) else dict(value)
    if not isinstance(parsed, dict):
        raise ValueError("a filter must be a JSON object")
    return parsed


def _all(parts: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, parts, F.lit(True)) if parts else F.lit(True)


def _any(parts: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, parts)


def _sure(test: Column) -> Column:
    """A definite answer: unknown counts as no."""
    return F.coalesce(test, F.lit(False))


def _operator(fields, name: str, op: str, value, options: str) -> Column:
    """One operator. Unknown (SQL NULL) means no match; negations settle that
    first, positive tests leave it so that Spark can push them to the scan."""
    if op == "$eq":
        return fields.compare(name, "eq", value)
    if op == "$ne":
        return ~_sure(fields.compare(name, "eq", value))
    if op in _ORDER:
        return fields.compare(name, _ORDER[op], value)
    if op == "$in":
        return _any([fields.compare(name, "eq", v) for v in value]) if value else F.lit(False)
    if op == "$nin":
        return ~_sure(_operator(fields, name, "$in", value, options))
    if op == "$exists":
        present = fields.present(name)
        return present if value else ~present
    if op == "$regex":
        return fields.matches(name, f"(?{options}){value}" if options else value)
    if op == "$not":
        return ~_sure(_field(fields, name, value))
    if op == "$all":
        return _all([fields.compare(name, "eq", v) for v in value]) if value else F.lit(False)
    if op == "$size":
        return fields.size(name) == value
    if op == "$mod":
        divisor, rest = value
        if not divisor:
            raise ValueError("$mod needs a divisor")
        return fields.number(name).cast("long") % int(divisor) == int(rest)
    if op == "$type":
        return _any([_of_type(fields, name, v) for v in (value if isinstance(value, list) else [value])])
    if op == "$elemMatch":
        return F.exists(fields.elements(name), lambda item: _element(item, value))
    raise ValueError(f"unsupported filter operator: {op}")


def _of_type(fields, name: str, wanted) -> Column:
    if wanted == "number":
        return _any([fields.of_type(name, k) for k in ("int", "long", "double", "decimal")])
    wanted = _TYPES.get(wanted, wanted)
    if wanted not in _TYPES.values():
        raise ValueError(f"unknown type in filter: {wanted!r}")
    return fields.of_type(name, wanted)


def _element(item: Column, test: Mapping) -> Column:
    """Whether one array element passes operators, or, if it is an object, a filter."""
    inside = ElementFields(item)
    if test and all(k.startswith("$") and k not in ("$and", "$or", "$nor") for k in test):
        return _sure(_field(inside, "", test))
    return variant_kind(item).startswith("OBJECT") & _sure(_build(inside, inside, test))


def _field(fields, name: str, test) -> Column:
    if isinstance(test, dict) and test and all(k.startswith("$") for k in test):
        options = test.get("$options", "")
        return _all(
            [
                _operator(fields, name, op, value, options)
                for op, value in test.items()
                if op != "$options"
            ]
        )
    return fields.compare(name, "eq", test)


def _names(spec: Mapping) -> list[str]:
    """Fields a filter reads."""
    out = []
    for name, test in spec.items():
        if name in ("$and", "$or", "$nor"):
            out += [n for part in test for n in _names(part)]
        elif not name.startswith("$"):
            out.append(name)
    return out


def _build(fields, ids, spec: Mapping) -> Column:
    parts = []
    for name, test in spec.items():
        if name == "$and":
            parts.append(_all([_build(fields, ids, s) for s in test]))
        elif name == "$or":
            parts.append(_any([_build(fields, ids, s) for s in test]))
        elif name == "$nor" and test:
            parts += [~_sure(_build(fields, ids, s)) for s in test]
        elif name.startswith("$"):
            raise ValueError(f"unsupported filter operator: {name}")
        else:
            parts.append(_field(ids if name == "_id" else fields, name, test))
    return _all(parts)


def _prepared(df: DataFrame, query: str | Mapping | None) -> tuple[DataFrame, Column]:
    """``df`` with the filter's fields looked up, and the filter as a column."""
    spec = _spec(query)
    fields = fields_of(df)
    ids = fields
    if isinstance(fields, DocFields) and "_id" in df.columns:
        ids = fields_of(df.select("_id"))
    rows = fields.prepare(df, [n for n in _names(spec) if ids is fields or n != "_id"])
    return rows, _build(fields, ids, spec)


def matching(df: DataFrame, query: str | Mapping | None) -> DataFrame:
    """Rows that satisfy a JSON filter."""
    if not _spec(query):
        return df
    rows, test = _prepared(df, query)
    return rows.filter(test).select(*df.columns)


def sort_columns(df: DataFrame, sort: str | Mapping | None) -> list[Column]:
    """Sort keys in document order; null and absent come first ascending. A
    sort that is not valid JSON is skipped with a warning."""
    try:
        spec = _spec(sort)
    except ValueError:
        log.warning("ignoring invalid sort: %r", sort)
        return []
    fields = fields_of(df)
    return [c for name, way in spec.items() for c in fields.sort_keys(name, way > 0)]


# Pages that end within so many rows are taken from the sort directly.
PAGE = 10_000


def find(
    df: DataFrame,
    query: str | Mapping | None = None,
    sort: str | Mapping | None = None,
    skip: int = 0,
    limit: int = 0,
    id_column: str | None = None,
) -> DataFrame:
    """Filter, then sort, skip and limit (0 means no limit).

    Paging needs a total order, so ``id_column`` is appended to the sort; rows
    with equal ids are told apart by place. A skip without a limit, or one that
    goes more than ``PAGE`` rows deep, numbers the sorted rows by partition and
    cuts by number, however deep it is; a plain offset would keep all rows up to
    the page's end in every task and merge them in one.
    """
    out = matching(df, query)
    order = sort_columns(df, sort)
    if skip < 0 or limit < 0:
        raise ValueError("skip and limit must not be negative")
    if skip > 0 and id_column is None:
        id_column = _id_of(df, None)
    if id_column and (order or skip > 0 or limit > 0):
        order.append(F.col(id_column).asc())
    if skip > 0 and (limit <= 0 or skip + limit > PAGE):
        rest = _without_first(out.orderBy(*order), skip)
        return rest.limit(limit) if limit > 0 else rest
    if order:
        out = out.orderBy(*order)
    if skip > 0:
        out = out.offset(skip)
    return out.limit(limit) if limit > 0 else out


def _without_first(ordered: DataFrame, skip: int) -> DataFrame:
    """A sorted frame without its first rows, still in order. The sorted rows
    are kept in the shared folder; one count for each partition is read."""
    spark, path = ordered.sparkSession, shared_dir(ordered.sparkSession, "skip")
    numbered = ordered.withColumn("__at", F.monotonically_increasing_id())
    numbered.write.parquet(path)
    rows = spark.read.schema(numbered.schema).parquet(path)
    counts = rows.groupBy(F.shiftright("__at", 33).alias("part")).count().orderBy("part").collect()
    first = None
    for r in counts:
        if skip < r["count"]:
            first = (r["part"] << 33) + skip
            break
        skip -= r["count"]
    rest = rows.filter(F.lit(False)) if first is None else rows.filter(F.col("__at") >= first)
    return rest.orderBy("__at").drop("__at")


def render_json(df: DataFrame) -> DataFrame:
    """Each row as JSON text; ``(_id, doc)`` rows as the document with its id."""
    if isinstance(fields_of(df), DocFields) and "_id" in df.columns:
        body = F.to_json(set_path(F.col("doc"), "_id", as_variant(F.col("_id"))))
    else:
        body = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    return df.select(body.alias("json_data"))


def count(df: DataFrame, query: str | Mapping | None = None) -> DataFrame:
    """One row with the number of matches."""
    return matching(df, query).agg(F.count("*").alias("count"))


# --------------------------------------------------------------------- writes

def _id_of(df: DataFrame, id_column: str | None) -> str:
    name = id_column or "_id"
    if name not in df.columns:
        raise ValueError(f"no id column {name!r}")
    return name


def insert_many(df: DataFrame, documents: DataFrame, text: str = "json_data") -> DataFrame:
    """Append JSON documents to a ``(_id, doc)`` collection (see ``parsed``)."""
    return df.unionByName(parsed(documents, df.schema["_id"].dataType, text))


def parsed(documents: DataFrame, id_type: T.DataType, text: str = "json_data") -> DataFrame:
    """JSON documents as ``(_id, doc)`` rows.

    Any document that is not a JSON object fails the whole job, so nothing is
    written. Documents keep their own ``_id`` (of any type, as text) or get one
    from a hash of this call's own id and their position, so that no two inserts
    share one.
    """
    call = F.lit(uuid.uuid4().hex)
    doc = F.try_parse_json(F.col(text))
    entries = F.try_variant_get(doc, "$", "map<string,variant>")
    bad = F.concat(F.lit("invalid JSON document: "), F.coalesce(F.col(text), F.lit("null")))
    checked = F.when(entries.isNull(), F.raise_error(bad).cast("variant")).otherwise(doc)
    own = F.try_variant_get(doc, "$._id", "string")
    made = F.substring(F.sha2(F.concat_ws("/", call, F.monotonically_increasing_id()), 256), 1, 24)
    body = F.to_variant_object(F.map_filter(entries, lambda k, _: k != "_id"))
    return documents.select(
        F.coalesce(own, made).cast(id_type).alias("_id"),
        F.when(checked.isNotNull(), body).alias("doc"),
    )


def insert_one(df: DataFrame, document: str | Mapping) -> DataFrame:
    """Append one document; invalid JSON is refused before any job runs."""
    return insert_many(df, one_document(df.sparkSession, document))


def one_document(spark, document: str | Mapping) -> DataFrame:
    text = document if isinstance(document, str) else json.dumps(document)
    if not isinstance(json.loads(text), dict):
        raise ValueError("a document must be a JSON object")
    return spark.createDataFrame([(text,)], "json_data string")


@dataclass(frozen=True)
class Update:
    """Contents after an update, and its one-row counts."""

    rows: DataFrame
    counts: DataFrame


def _updates(update: str | Mapping) -> dict[str, tuple]:
    """path -> (operator, value); no path may lie inside another."""
    spec = _spec(update)
    unknown = [op for op in spec if op not in _UPDATES]
    if unknown or not spec:
        raise ValueError(f"unsupported update operator: {unknown or 'none given'}")
    out: dict[str, tuple] = {}
    for op, values in spec.items():
        for path, value in values.items():
            if any(f"{path}.".startswith(f"{p}.") or f"{p}.".startswith(f"{path}.") for p in out):
                raise ValueError(f"two updates of {path}")
            if op == "$inc" and (isinstance(value, bool) or not isinstance(value, (int, float))):
                raise ValueError(f"$inc needs a number: {value!r}")
            if op == "$push":
                value = list(value["$each"]) if isinstance(value, dict) and set(value) == {"$each"} else [value]
            out[path] = (op, value)
    return out


def _inserted(start: Mapping, changes: Mapping[str, tuple]) -> dict:
    """The values an upsert's new row gets: the filter's, then the update's."""
    out = dict(start)
    for path, (op, value) in changes.items():
        if op == "$unset":
            out.pop(path, None)
        elif op == "$inc":
            out[path] = out.get(path, 0) + value
        elif op == "$push":
            out[path] = [*out.get(path, []), *value]
        else:
            out[path] = value
    return out


def _chosen(df: DataFrame, query, many: bool, id_column: str | None) -> DataFrame:
    """``df`` with a boolean ``__hit`` on the rows an operation applies to: all
    matches, or one row, that which comes first by id and place."""
    if many:
        rows, test = _prepared(df, query)
        return rows.withColumn("__hit", _sure(test)).select(*df.columns, "__hit")
    key = _id_of(df, id_column)
    rows = df.withColumn("__row", F.monotonically_increasing_id())
    found = matching(rows, query).filter(F.col(key).isNotNull())
    first = found.agg(F.min(F.struct(key, "__row"))["__row"].alias("__first")).filter("__first IS NOT NULL")
    return (
        rows.join(F.broadcast(first), F.col("__row") == F.col("__first"), "left")
        .withColumn("__hit", F.col("__first").isNotNull())
        .drop("__first", "__row")
    )


def _literal(value) -> Column:
    return F.array(*map(F.lit, value)) if isinstance(value, list) else F.lit(value)


def _changed_doc(changes: Mapping[str, tuple]) -> Column:
    old = DocFields("doc")
    doc = F.col("doc")
    for path, (op, value) in changes.items():
        if op == "$unset":
            doc = unset_path(doc, path)
        elif op == "$inc":
            doc = set_path(doc, path, add_to(old.lookup(path), value))
        elif op == "$push":
            doc = set_path(doc, path, append_to(old.lookup(path), value))
        else:
            doc = set_path(doc, path, as_variant(value))
    return doc


def _changed_column(df: DataFrame, name: str, op: str, value) -> Column:
    """A typed column's new value; a column that is not there begins as null."""
    if name not in df.columns:
        return F.array(*map(F.lit, value)) if op == "$push" else F.lit(None if op == "$unset" else value)
    kind, column = df.schema[name].dataType, F.col(name)
    if op == "$unset":
        return F.lit(None).cast(kind)
    if op == "$inc":
        if not isinstance(kind, T.NumericType):
            raise ValueError(f"$inc needs a number, {name} is {kind.simpleString()}")
        return F.coalesce(column + F.lit(value), F.lit(value)).cast(kind)
    if op == "$push":
        if not isinstance(kind, T.ArrayType):
            raise ValueError(f"$push needs an array, {name} is {kind.simpleString()}")
        return F.concat(F.coalesce(column, F.array().cast(kind)), F.array(*map(F.lit, value)).cast(kind))
    return F.lit(value).cast(kind)


def _with_changes(df: DataFrame, changes: Mapping[str, tuple]) -> tuple[dict[str, Column], Column]:
    """New column values for hit rows, and whether they differ from the old."""
    if isinstance(fields_of(df), DocFields):
        doc = _changed_doc(changes)
        return {"doc": doc}, F.to_json(F.col("doc")) != F.to_json(doc)
    new, changed = {}, []
    for name, (op, value) in changes.items():
        column = _changed_column(df, name, op, value)
        if name in df.columns:
            changed.append(~F.col(name).eqNullSafe(column))
        elif op == "$unset":
            continue
        else:
            changed.append(column.isNotNull())
        new[name] = column
    return new, _any(changed) if changed else F.lit(False)


def _equalities(spec: Mapping) -> dict:
    """The fields a filter pins to one value; an upsert starts from them."""
    out = {}
    for name, test in spec.items():
        if name == "$and":
            for part in test:
                out.update(_equalities(part))
        elif not name.startswith("$"):
            if not isinstance(test, dict):
                out[name] = test
            elif set(test) == {"$eq"}:
                out[name] = test["$eq"]
    return out


def update(
    df: DataFrame,
    query: str | Mapping,
    change: str | Mapping,
    many: bool = False,
    upsert: bool = False,
    id_column: str | None = None,
    new_id=None,
) -> Update:
    """``$set``, ``$unset``, ``$inc`` and ``$push`` on all matches (``many``) or on
    the first by id. A ``$inc`` or ``$push`` on a value of the wrong type fails.

    With ``upsert`` and no match, one row made of the filter's equalities and
    the new values is added.
    """
    changes = _updates(change)
    marked = _chosen(df, query, many, id_column)
    new, differs = _with_changes(df, changes)
    hit = F.col("__hit")
    rows = marked.withColumns(
        {
            name: F.when(hit, column).otherwise(
                F.col(name) if name in df.columns else F.lit(None)
            )
            for name, column in new.items()
        }
    ).drop("__hit")
    tally = marked.agg(
        F.count_if(hit).alias("matched_count"),
        F.count_if(hit & differs).alias("modified_count"),
    )
    added = F.when(F.col("matched_count") == 0, 1).otherwise(0) if upsert else F.lit(0)
    counts = tally.withColumn("upserted_count", added.cast("bigint"))
    if upsert:
        fresh = _inserted(_equalities(_spec(query)), changes)
        name = _id_of(df, id_column)
        made = F.lit(new_id) if new_id is not None else F.uuid()
        seed = counts.filter("upserted_count = 1")
        if isinstance(fields_of(df), DocFields):
            own = fresh.pop("_id", None)
            doc = F.parse_json(F.lit("{}"))
            for path, value in fresh.items():
                doc = set_path(doc, path, as_variant(value))
            key = F.lit(own) if own is not None else made
            seed = seed.select(key.cast(df.schema["_id"].dataType).alias("_id"), doc.alias("doc"))
        else:
            fresh.setdefault(name, None)
            seed = seed.select(
                *[
                    (made if n == name and v is None else _literal(v))
                    .cast(rows.schema[n].dataType)
                    .alias(n)
                    for n, v in fresh.items()
                ]
            )
        rows = rows.unionByName(seed, allowMissingColumns=True)
    return Update(rows, counts)


def delete(
    df: DataFrame, query: str | Mapping, many: bool = False, id_column: str | None = None
) -> DataFrame:
    """What remains after deleting all matches, or the first by id."""
    marked = _chosen(df, query, many, id_column)
    return marked.filter(~F.col("__hit")).drop("__hit")


def deleted_count(
    df: DataFrame, query: str | Mapping, many: bool = False, id_column: str | None = None
) -> DataFrame:
    marked = _chosen(df, query, many, id_column)
    return marked.agg(F.count_if("__hit").alias("deleted_count"))


def from_json_text(df: DataFrame, id_column: str, text: str) -> DataFrame:
    """A ``(_id, doc)`` collection from an id and a JSON text column."""
    return df.select(F.col(id_column).alias("_id"), F.try_parse_json(F.col(text)).alias("doc"))


def schema_of_collection() -> T.StructType:
    return T.StructType(
        [T.StructField("_id", T.StringType()), T.StructField("doc", T.VariantType())]
    )
