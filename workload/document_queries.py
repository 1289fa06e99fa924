"""Document collections: ``customer`` and ``part`` as typed documents, the
events' ``props`` as JSON documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import documents as docs
from millrace.operators import text_search
from millrace.session import shared_dir
from millrace.sources import collections, merging
from workload.common import events, query, table

_C = "c_custkey, c_name, c_acctbal, c_mktsegment"


def _people(spark, sf):
    return table(spark, sf, "customer").select(*_C.split(", "))


def _parts(spark, sf):
    return table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_size", "p_retailprice")


def _props(spark, sf):
    """Events as documents ``{"k": n, "type": .., "user": {"id": n}}``."""
    body = F.to_json(
        F.struct(
            F.get_json_object("props", "$.k").cast("bigint").alias("k"),
            F.col("event_type").alias("type"),
            F.when(F.col("value") > 5, F.col("value")).alias("value"),
            F.struct(F.col("user_id").alias("id")).alias("user"),
        )
    )
    return docs.from_json_text(events(spark, sf).withColumn("body", body), "event_id", "body")


_K = "CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT)"
_DOC = f"d AS (SELECT event_id AS _id, {_K} AS k, event_type AS type, CASE WHEN value > 5 THEN value END AS value, user_id FROM events)"


def _ids(df):
    return df.select("_id")


# ---------------------------------------------------------------------- reads

@query("find_all", f"SELECT {_C} FROM customer")
def find_all(spark, sf):
    return docs.find(_people(spark, sf), "{}")


@query("match_eq", f"SELECT {_C} FROM customer WHERE c_mktsegment = 'MACHINERY'")
def match_eq(spark, sf):
    return docs.find(_people(spark, sf), {"c_mktsegment": "MACHINERY"})


@query("match_null", f"WITH {_DOC} SELECT _id FROM d WHERE value IS NULL")
def match_null(spark, sf):
    """Null matches documents without the field."""
    return _ids(docs.find(_props(spark, sf), {"value": None}))


@query("match_gt", f"SELECT {_C} FROM customer WHERE c_acctbal > 2500")
def match_gt(spark, sf):
    return docs.find(_people(spark, sf), '{"c_acctbal": {"$gt": 2500}}')


@query("match_gte", f"WITH {_DOC} SELECT _id FROM d WHERE k >= 90")
def match_gte(spark, sf):
    return _ids(docs.find(_props(spark, sf), {"k": {"$gte": 90}}))


@query("match_lt", f"WITH {_DOC} SELECT _id FROM d WHERE value < 10")
def match_lt(spark, sf):
    return _ids(docs.find(_props(spark, sf), {"value": {"$lt": 10}}))


@query("match_regex", "SELECT doc_id, lang FROM documents WHERE regexp_matches(text, '[0-9]{4}')")
def match_regex(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", "lang", "text")
    return docs.find(rows, {"text": {"$regex": "[0-9]{4}"}}).drop("text")


@query(
    "match_and",
    f"SELECT {_C} FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal >= 0 AND c_acctbal < 5000",
)
def match_and(spark, sf):
    query_ = {"c_mktsegment": "BUILDING", "c_acctbal": {"$gte": 0, "$lt": 5000}}
    return docs.find(_people(spark, sf), query_)


@query(
    "match_more",
    f"""WITH {_DOC} SELECT _id FROM d
        WHERE (type IN ('click', 'view') OR k <= 5) AND (value IS NULL OR value <> 10.5)
          AND type NOT IN ('error') AND NOT (k > 50) AND user_id < 120""",
)
def match_more(spark, sf):
    query_ = {
        "$or": [{"type": {"$in": ["click", "view"]}}, {"k": {"$lte": 5}}],
        "$and": [{"value": {"$ne": 10.5}}, {"type": {"$nin": ["error"]}}],
        "k": {"$not": {"$gt": 50}},
        "user.id": {"$lt": 120},
    }
    return _ids(docs.find(_props(spark, sf), query_))


@query(
    "match_nor_mod",
    """SELECT c_custkey FROM customer
       WHERE NOT (c_mktsegment = 'BUILDING') AND NOT (c_acctbal < 0) AND c_custkey % 7 = 3""",
)
def match_nor_mod(spark, sf):
    query_ = {"$nor": [{"c_mktsegment": "BUILDING"}, {"c_acctbal": {"$lt": 0}}], "c_custkey": {"$mod": [7, 3]}}
    return docs.find(_people(spark, sf), query_).select("c_custkey")


@query("match_type", f"WITH {_DOC} SELECT _id FROM d WHERE value IS NOT NULL AND k % 2 = 0")
def match_type(spark, sf):
    """``k`` is a whole number, ``value`` one with a fraction, or absent."""
    return _ids(docs.find(_props(spark, sf), {"value": {"$type": "double"}, "k": {"$type": [16, "long"], "$mod": [2, 0]}}))


_ORDERED = """o AS (SELECT l_orderkey, bool_or(l_quantity > 40 AND l_returnflag = 'R') AS big
                    FROM lineitem GROUP BY l_orderkey)"""


@query("match_element", f"WITH {_ORDERED} SELECT l_orderkey AS _id FROM o WHERE big")
def match_element(spark, sf):
    """Orders with one line that is both large and returned."""
    line = F.struct(F.col("l_quantity").cast("double").alias("quantity"), F.col("l_returnflag").alias("flag"))
    orders = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("_id")).agg(F.collect_list(line).alias("lines"))
    test = {"lines": {"$elemMatch": {"quantity": {"$gt": 40}, "flag": "R"}}}
    return _ids(docs.find(orders, test))


@query("match_exists", f"WITH {_DOC} SELECT _id FROM d WHERE value IS NOT NULL AND type = 'view'")
def match_exists(spark, sf):
    return _ids(docs.find(_props(spark, sf), {"value": {"$exists": True}, "type": {"$eq": "view"}}))


@query(
    "sort_documents",
    f"SELECT {_C} FROM customer ORDER BY c_mktsegment NULLS FIRST, c_acctbal DESC NULLS LAST, c_custkey LIMIT 100",
)
def sort_documents(spark, sf):
    order = '{"c_mktsegment": 1, "c_acctbal": -1}'
    return docs.find(_people(spark, sf), sort=order, limit=100, id_column="c_custkey")


@query(
    "skip_documents",
    f"SELECT {_C} FROM customer ORDER BY c_acctbal DESC NULLS LAST, c_custkey OFFSET 40",
)
def skip_documents(spark, sf):
    return docs.find(_people(spark, sf), sort={"c_acctbal": -1}, skip=40, id_column="c_custkey")


@query(
    "limit_documents",
    f"SELECT {_C} FROM customer ORDER BY c_acctbal DESC NULLS LAST, c_custkey LIMIT 25 OFFSET 10",
)
def limit_documents(spark, sf):
    """A page: the eleventh to the thirty-fifth."""
    return docs.find(
        _people(spark, sf), sort={"c_acctbal": -1}, skip=10, limit=25, id_column="c_custkey"
    )


@query(
    "render_json",
    """SELECT '{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '","c_mktsegment":"'
              || c_mktsegment || '"}' AS json_data FROM customer""",
)
def render_json(spark, sf):
    return docs.render_json(_people(spark, sf).select("c_custkey", "c_name", "c_mktsegment"))


@query(
    "render_json_documents",
    f"""WITH {_DOC} SELECT '{{"_id":' || _id || ',"k":' || k || ',"type":"' || type ||
        '","user":{{"id":' || user_id || '}}}}' AS json_data FROM d WHERE value IS NULL""",
)
def render_json_documents(spark, sf):
    return docs.render_json(docs.find(_props(spark, sf), {"value": None}))


@query("count_documents", "SELECT count(*) AS count FROM customer WHERE c_acctbal >= 3000")
def count_documents(spark, sf):
    return docs.count(_people(spark, sf), {"c_acctbal": {"$gte": 3000}})


# --------------------------------------------------------------------- writes

@query(
    "insert_one",
    f"WITH {_DOC} SELECT type, count(*) AS documents FROM (SELECT type FROM d UNION ALL SELECT 'refund') GROUP BY type",
)
def insert_one(spark, sf):
    grown = docs.insert_one(_props(spark, sf), {"type": "refund", "k": 1, "_id": "10000001"})
    kind = F.try_variant_get("doc", "$.type", "string").alias("type")
    return grown.groupBy(kind).agg(F.count("*").alias("documents"))


@query(
    "insert_many",
    f"""WITH {_DOC} SELECT CAST(_id AS VARCHAR) AS _id, type FROM d
        UNION ALL SELECT 'c' || c_custkey, c_mktsegment FROM customer""",
)
def insert_many(spark, sf):
    """Every customer inserted, as JSON text, into the events collection."""
    fresh = table(spark, sf, "customer").select(
        F.to_json(
            F.struct(
                F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("_id"),
                F.col("c_mktsegment").alias("type"),
            )
        ).alias("json_data")
    )
    base = _props(spark, sf).withColumn("_id", F.col("_id").cast("string"))
    grown = docs.insert_many(base, fresh)
    return grown.select("_id", F.try_variant_get("doc", "$.type", "string").alias("type"))


@query(
    "update_many",
    f"""SELECT c_custkey, c_name, c_acctbal,
               CASE WHEN c_acctbal >= 3000 THEN 'SENIOR' ELSE c_mktsegment END AS c_mktsegment
        FROM customer""",
)
def update_many(spark, sf):
    change = {"$set": {"c_mktsegment": "SENIOR"}}
    done = docs.update(_people(spark, sf), {"c_acctbal": {"$gte": 3000}}, change, many=True)
    return done.rows


@query(
    "update_one",
    f"""SELECT c_custkey, c_name, c_acctbal,
               CASE WHEN c_custkey = (SELECT min(c_custkey) FROM customer WHERE c_mktsegment = 'MACHINERY')
                    THEN 'FIRST' ELSE c_mktsegment END AS c_mktsegment
        FROM customer""",
)
def update_one(spark, sf):
    change = '{"$set": {"c_mktsegment": "FIRST"}}'
    return docs.update(
        _people(spark, sf), {"c_mktsegment": "MACHINERY"}, change, id_column="c_custkey"
    ).rows


@query(
    "set_fields",
    f"""WITH {_DOC} SELECT _id, CASE WHEN k > 50 THEN 'big' END AS size,
               CASE WHEN k > 50 THEN -1 ELSE user_id END AS user_id, k FROM d""",
)
def set_fields(spark, sf):
    """A new field and a nested one, on documents."""
    change = {"$set": {"size": "big", "user.id": -1}}
    rows = docs.update(_props(spark, sf), {"k": {"$gt": 50}}, change, many=True).rows
    return rows.select(
        "_id",
        F.try_variant_get("doc", "$.size", "string").alias("size"),
        F.try_variant_get("doc", "$.user.id", "bigint").alias("user_id"),
        F.try_variant_get("doc", "$.k", "bigint").alias("k"),
    )


@query(
    "change_fields",
    f"""WITH {_DOC} SELECT _id, CASE WHEN k > 50 THEN k + 7 ELSE k END AS k,
               CASE WHEN k <= 50 THEN value END AS value, CASE WHEN k > 50 THEN 1 END AS seen,
               CASE WHEN k > 50 THEN '["a","b"]' END AS tags, user_id FROM d""",
)
def change_fields(spark, sf):
    """Counted up, removed and pushed to, whether or not the field is there."""
    change = {"$inc": {"k": 7, "seen": 1}, "$unset": {"value": ""}, "$push": {"tags": {"$each": ["a", "b"]}}}
    rows = docs.update(_props(spark, sf), {"k": {"$gt": 50}}, change, many=True).rows
    return rows.select(
        "_id",
        F.try_variant_get("doc", "$.k", "bigint").alias("k"),
        F.try_variant_get("doc", "$.value", "double").alias("value"),
        F.try_variant_get("doc", "$.seen", "int").alias("seen"),
        F.to_json(F.try_variant_get("doc", "$.tags", "variant")).alias("tags"),
        F.try_variant_get("doc", "$.user.id", "bigint").alias("user_id"),
    )


@query(
    "change_columns",
    """SELECT c_custkey, c_acctbal + CASE WHEN c_mktsegment = 'BUILDING' THEN 10 ELSE 0 END AS c_acctbal,
              CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS c_mktsegment FROM customer""",
)
def change_columns(spark, sf):
    change = {"$inc": {"c_acctbal": 10}, "$unset": {"c_mktsegment": ""}}
    rows = docs.update(_people(spark, sf), {"c_mktsegment": "BUILDING"}, change, many=True).rows
    return rows.select("c_custkey", "c_acctbal", "c_mktsegment")


@query(
    "upsert",
    f"""SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer
        UNION ALL SELECT -1, 'Jane Doe', 28.0, NULL""",
)
def upsert(spark, sf):
    done = docs.update(
        _people(spark, sf), {"c_name": "Jane Doe"}, {"$set": {"c_acctbal": 28.0}},
        upsert=True, id_column="c_custkey", new_id=-1,
    )
    return done.rows


@query(
    "update_counts",
    """SELECT count(*) AS matched_count,
              count(*) FILTER (c_mktsegment <> 'BUILDING') AS modified_count, 0 AS upserted_count
       FROM customer WHERE c_acctbal < 2000""",
)
def update_counts(spark, sf):
    change = {"$set": {"c_mktsegment": "BUILDING"}}
    return docs.update(_people(spark, sf), {"c_acctbal": {"$lt": 2000}}, change, many=True).counts


@query(
    "delete_one",
    """SELECT p_partkey, p_name FROM part
       WHERE p_partkey <> (SELECT min(p_partkey) FROM part WHERE p_name = 'red widget')""",
)
def delete_one(spark, sf):
    rows = _parts(spark, sf).select("p_partkey", "p_name")
    return docs.delete(rows, {"p_name": "red widget"}, id_column="p_partkey")


@query("delete_many", "SELECT p_partkey, p_retailprice FROM part WHERE NOT p_retailprice < 950")
def delete_many(spark, sf):
    rows = _parts(spark, sf).select("p_partkey", "p_retailprice")
    return docs.delete(rows, {"p_retailprice": {"$lt": 950}}, many=True)


_LISTED = "customer orders part".split()


def _database(spark, sf):
    """A database whose tables are the given files."""
    name = "millrace_given"
    collections.ensure_database(spark, name)
    for t in _LISTED:
        spark.sql(f"DROP TABLE IF EXISTS {name}.{t}")
        columns = ", ".join(f"`{n}` {k}" for n, k in table(spark, sf, t).dtypes)
        spark.sql(f"CREATE TABLE {name}.{t} ({columns}) USING parquet LOCATION '{sf}/{t}.parquet'")
    return name


@query(
    "list_collections",
    """SELECT 'customer' AS name, 'external' AS type, count(*) AS documents FROM customer
       UNION ALL SELECT 'orders', 'external', count(*) FROM orders
       UNION ALL SELECT 'part', 'external', count(*) FROM part""",
)
def list_collections(spark, sf):
    """Collections of a database, each with its number of documents."""
    name = _database(spark, sf)
    listed = collections.list_collections(spark, name)
    sizes = None
    for t in _LISTED:
        one = spark.table(f"{name}.{t}").agg(F.count("*").alias("documents")).withColumn("name", F.lit(t))
        sizes = one if sizes is None else sizes.unionByName(one)
    return listed.join(F.broadcast(sizes), "name")


@query(
    "collection_round_trip",
    f"""WITH {_DOC} SELECT type, count(*) AS documents, sum(k) AS k FROM d
        WHERE k >= 10 GROUP BY type""",
)
def collection_round_trip(spark, sf):
    """Stored, then deleted from, then read again."""
    name = shared_dir(spark, "c").rsplit("-", 1)[1]
    store = collections.Collection(spark, "millrace_docs", f"events_{name}")
    store.replace(_props(spark, sf))
    store.delete({"k": {"$lt": 10}}, many=True)
    kind = F.try_variant_get("doc", "$.type", "string").alias("type")
    k = F.try_variant_get("doc", "$.k", "bigint")
    return store.read().groupBy(kind).agg(F.count("*").alias("documents"), F.sum(k).alias("k"))


# ------------------------------------------------------------ merge on read

_ORDERS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]


def _merged(spark, sf):
    """The orders as a collection, one write; then each change writes its rows only."""
    return merging.stored(table(spark, sf, "orders").select(*_ORDERS), "o_orderkey")


@query(
    "merged_update_many",
    f"""SELECT {", ".join(_ORDERS)}, CASE WHEN o_custkey < 100 THEN 'watched' END AS note
        FROM orders""",
)
def merged_update_many(spark, sf):
    store = _merged(spark, sf)
    store.update({"o_custkey": {"$lt": 100}}, {"$set": {"note": "watched"}}, many=True)
    return store.read()


@query(
    "merged_update_counts",
    """SELECT 'many' AS change, count(*) AS matched_count, count(*) FILTER (o_orderstatus <> 'F') AS modified_count,
              0 AS upserted_count FROM orders WHERE o_custkey < 100
       UNION ALL SELECT 'one', 1, 1, 0 UNION ALL SELECT 'upsert', 0, 0, 1""",
)
def merged_update_counts(spark, sf):
    """What each update reports; the changes pile up."""
    store = _merged(spark, sf)
    done = {
        "many": store.update({"o_custkey": {"$lt": 100}}, {"$set": {"o_orderstatus": "F"}}, many=True),
        "one": store.update({"o_custkey": {"$gte": 100}}, {"$set": {"o_orderstatus": "one"}}),
        "upsert": store.update({"o_orderkey": -1}, {"$set": {"o_orderstatus": "new"}}, upsert=True),
    }
    rows = [(name, *counts.values()) for name, counts in done.items()]
    return spark.createDataFrame(rows, "change string, matched_count bigint, modified_count bigint, upserted_count bigint")


_MERGED_LEFT = f"""SELECT {", ".join(n if n != "o_totalprice" else "CASE WHEN o_custkey % 2 = 1 AND o_custkey < 500 THEN 0 ELSE o_totalprice END AS o_totalprice" for n in _ORDERS)}
    FROM orders WHERE NOT o_totalprice < 50000"""


def _changed_orders(spark, sf):
    store = _merged(spark, sf)
    store.delete({"o_totalprice": {"$lt": 50000}}, many=True)
    store.update(
        {"o_custkey": {"$lt": 500, "$mod": [2, 1]}}, {"$set": {"o_totalprice": 0.0}}, many=True
    )
    return store


@query("merged_delete_update", _MERGED_LEFT)
def merged_delete_update(spark, sf):
    return _changed_orders(spark, sf).read()


@query("merged_compacted", _MERGED_LEFT)
def merged_compacted(spark, sf):
    """The same rows once the worn parts are rewritten and the old files are gone."""
    store = _changed_orders(spark, sf)
    store.compact(0.0)
    store.vacuum()
    return store.read()


@query(
    "merged_insert",
    f"""SELECT {", ".join(_ORDERS)} FROM orders
        UNION ALL SELECT -o_orderkey, {", ".join(_ORDERS[1:])} FROM orders WHERE o_custkey < 50""",
)
def merged_insert(spark, sf):
    """New ids are compared with those of the buckets they fall in."""
    store = _merged(spark, sf)
    more = table(spark, sf, "orders").select(*_ORDERS).filter("o_custkey < 50")
    store.insert(more.withColumn("o_orderkey", -F.col("o_orderkey")))
    return store.read()


# -------------------------------------------------------------- text search

_TERMS_SQL = r"""words AS (
  SELECT doc_id AS id, translate(unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM documents),
postings AS (SELECT term, id, count(*) AS times FROM words GROUP BY ALL),
lengths AS (SELECT id, sum(times) AS length FROM postings GROUP BY id),
totals AS (SELECT (SELECT count(DISTINCT doc_id) FROM documents WHERE text IS NOT NULL) AS n,
  (SELECT sum(times) FROM postings) AS w),
terms AS (SELECT term, count(*) AS d FROM postings GROUP BY term),
scored AS (
  SELECT id, sum(ln(1 + (n - d + 0.5) / (d + 0.5)) * times * 2.2 / (times + 1.2 * (0.25 + 0.75 * length / (w / n)))) AS score
  FROM postings JOIN terms USING (term) JOIN lengths USING (id), totals
  WHERE term IN ({terms}) GROUP BY id)"""


def _text_sql(terms: list[str], test: str = "true") -> str:
    named = ", ".join(f"'{t}'" for t in terms)
    return f"""WITH {_TERMS_SQL.replace("{terms}", named)}
        SELECT doc_id, lang, round(score, 4) AS score FROM scored JOIN documents ON doc_id = id WHERE {test}"""


def _searched(spark, sf, query):
    rows = table(spark, sf, "documents").select("doc_id", "lang", "text")
    index = text_search.TextIndex.build(rows, "doc_id", "text")
    return index.find(rows, query).select("doc_id", "lang", F.round("score", 4).alias("score"))


@query("text_search", _text_sql(["erhe", "haor", "thing", "der"]))
def text_search_any(spark, sf):
    """All documents with any of four terms, one of them frequent."""
    return _searched(spark, sf, {"$text": {"$search": "Erhe haor THING der"}})


@query(
    "text_search_without",
    _text_sql(["thand", "with"], """lang = 'en' AND doc_id NOT IN
        (SELECT id FROM postings WHERE term IN ('thing', 'haor'))"""),
)
def text_search_without(spark, sf):
    """Excluded terms and a plain filter beside the search."""
    return _searched(spark, sf, {"lang": "en", "$text": {"$search": "thand with -thing -haor"}})


@query(
    "text_search_phrase",
    _text_sql(["of", "the", "erhe"], r"""' ' || array_to_string(list_transform(regexp_extract_all(text,
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz')), ' ') || ' ' LIKE '% of the %'"""),
)
def text_search_phrase(spark, sf):
    return _searched(spark, sf, {"$text": {"$search": 'erhe "Of the"'}})


@query(
    "page_deep",
    """SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 500 OFFSET 12000""",
)
def page_deep(spark, sf):
    """A page far into a sorted result: cut by number, no task keeps what is skipped."""
    rows = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return docs.find(rows, sort={"o_totalprice": -1}, skip=12000, limit=500, id_column="o_orderkey")
