"""Decoding, keys, rules, specifications: the edge rows."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from millrace.functions import durations
from millrace.functions.keys import canonical_key, variant_key
from millrace.operators import filters, tables, transforms
from millrace.plans import flows, spec
from millrace.session import shared_dir
from millrace.sources import ingest


def topic(spark, *values):
    rows = [("k", v, "t", 0, i) for i, v in enumerate(values)]
    return spark.createDataFrame(
        rows, "key string, value string, topic string, partition int, offset bigint"
    ).withColumn("timestamp", F.lit("2024-01-01 00:00:00").cast("timestamp"))


def test_decode(spark):
    raw = topic(spark, '{"a":1}', "null", "[1]", "nope", "{}", None, '  {"a":null}', '{"a":9007199254740993}')
    reasons = [r["error_reason"] for r in ingest.json_decode(raw).orderBy("offset").collect()]
    assert reasons == [
        None, "not_an_object", "not_an_object", "malformed_json", None, "malformed_json", None, None
    ]
    typed = ingest.json_decode(raw, spark.sql("select 1L a").schema).orderBy("offset").collect()
    assert [r["error_reason"] for r in typed] == reasons
    assert typed[0]["data"]["a"] == 1 and typed[7]["data"]["a"] == 9007199254740993
    keyed = ingest.require_key(ingest.json_decode(raw), "a").orderBy("offset").collect()
    assert [r["key_value"] for r in keyed if r["error_reason"] is None] == ["1", "null", "9007199254740993"]
    assert keyed[4]["error_reason"] == "missing_key"


def test_key_text(spark):
    values = ['"1"', "1", "1.0", "1.50", "true", "null", "[1,2]", '{"z":1,"a":2}', '"a*:b"', "1e3", "-2.0",
              "0.001", '"1.0"', "1e-3"]
    raw = spark.createDataFrame([(i, f'{{"k":{v}}}') for i, v in enumerate(values)], "i int, j string")
    key = variant_key(F.try_variant_get(F.parse_json("j"), "$.k", "variant"))
    got = [r[0] for r in raw.orderBy("i").select(key).collect()]
    assert got == ["1", "1", "1", "1.5", "true", "null", "[1,2]", '{"a":2,"z":1}', "a*:b", "1000", "-2",
                   "0.001", "1.0", "0.001"]
    df = spark.sql("select 1 a, 1.0D b, 1.5D c, true d, cast(null as string) e, array(1,2) f, 2.50BD g")
    assert [df.select(canonical_key(df, c)).first()[0] for c in "abcdefg"] == [
        "1", "1", "1.5", "true", "null", "[1,2]", "2.50"
    ]


def test_ids_fall_back_to_position(spark):
    rows = ingest.ensure_id(ingest.json_decode(topic(spark, '{"id":"x"}', "{}", "{}"))).collect()
    assert rows[0]["event_id"] == "x"
    assert len({r["event_id"] for r in rows}) == 3 and all(r["event_id"] for r in rows)


def rules(spark, text, *chain):
    good, _ = ingest.split_errors(ingest.json_decode(topic(spark, text)))
    out = transforms.apply_rules(good, [dict(zip(("type", "field", "value"), r)) for r in chain])
    return out.select(F.to_json("data")).first()[0]


def test_rules_on_events(spark):
    assert rules(spark, '{"a":1,"b":2}', ("rename", "a", "b")) == '{"b":1}'
    assert rules(spark, '{"a":1}', ("rename", "a", "a")) == '{"a":1}'
    assert rules(spark, '{"a":1}', ("rename", "x", "a")) == '{"a":1}'
    assert rules(spark, '{"a":null}', ("default", "a", "z"), ("default", "b", "z")) == '{"a":null,"b":"z"}'
    assert rules(spark, '{"a":1}', ("rename", "a", "b"), ("default", "a", "x"), ("cast", "b", "string")) == \
        '{"b":"1","a":"x"}'
    for text, want in [('"12"', "12"), ('" 12"', '" 12"'), ('"1.5"', '"1.5"'), ('"x"', '"x"'), ("7", "7"),
                       ("null", "null"), ('"+5"', "5"), ('"99999999999999999999"', '"99999999999999999999"')]:
        assert rules(spark, f'{{"a":{text}}}', ("cast", "a", "int")) == f'{{"a":{want}}}'
    for text, want in [('"12"', "12.0"), ('"1.5"', "1.5"), ('"1e400"', '"1e400"'), ('" 1"', '" 1"'), ("7", "7")]:
        assert rules(spark, f'{{"a":{text}}}', ("cast", "a", "float")) == f'{{"a":{want}}}'
    assert rules(spark, '{"a":[1]}', ("cast", "a", "string"), ("cast", "b", "string")) == '{"a":"[1]"}'


def test_rules_on_columns(spark):
    df = spark.createDataFrame([("12",), (" 12",), ("1.5",), ("x",), (None,)], "a string")
    got = [tuple(r) for r in transforms.cast(df, "a", "int").collect()]
    assert got == [(12, None), (None, " 12"), (None, "1.5"), (None, "x"), (None, None)]
    assert transforms.rename(df, "a", "a").columns == ["a"]
    assert transforms.rename(df, "zz", "a").columns == ["a"]
    kept = transforms.default(df, "a", "d", null_is_absent=False)
    assert kept.filter("a is null").count() == 1
    assert transforms.default(df, "a", "d").filter("a is null").count() == 0


def test_bad_rules_are_refused(spark):
    df = spark.range(1)
    with pytest.raises(ValueError, match="cast target"):
        transforms.apply_rules(df, [{"type": "cast", "field": "id", "value": "date"}])
    with pytest.raises(ValueError, match="unknown transform"):
        transforms.apply_rules(df, [{"type": "explode", "field": "id", "value": ""}])
    with pytest.raises(ValueError, match="operator"):
        filters.filter_rows(df, [{"field": "id", "operator": "like", "value": 1}])
    assert transforms.apply_rules(df, [{"type": "x"}], enabled=False) is df
    assert filters.filter_rows(df, [{"operator": "x"}], enabled=False) is df


def test_filters_ignore_nulls_and_other_types(spark):
    good, _ = ingest.split_errors(
        ingest.json_decode(topic(spark, '{"a":5}', '{"a":"5"}', '{"a":null}', "{}", '{"a":[5,6]}', '{"a":"x5"}'))
    )

    def kept(op, value):
        out = filters.filter_rows(good, [{"field": "a", "operator": op, "value": value}])
        return [r["offset"] for r in out.orderBy("offset").collect()]

    assert kept("eq", 5) == [0, 4]
    assert kept("eq", "5") == [1]
    assert kept("ne", 5) == [1, 5]
    assert kept("gt", 4) == [0, 4]
    assert kept("contains", "5") == [1, 5]
    assert kept("contains", 6) == [4]


def test_durations():
    assert durations.micros("24h") == 86_400_000_000
    assert durations.micros("5m30s") == 330_000_000
    assert durations.micros(3_600_000_000_000) == 3_600_000_000
    assert durations.micros(timedelta(days=1, microseconds=5)) == 86_400_000_005
    assert durations.window_micros("30d") == 7 * 86_400_000_000
    for bad in ("", "5", "h", "5 parsecs", "-3h", None, 1.5, True):
        with pytest.raises(ValueError):
            durations.micros(bad)
    with pytest.raises(ValueError):
        durations.window_micros(-5_000)


CLICKS = {
    "name": "clicks", "source": {"type": "kafka", "topic": "clicks"}, "sink": {"type": "kafka", "topic": "out"},
    "processing": {"deduplication": {"enabled": True, "key": "click", "time_window": "24h"}},
}
PAIRS = {
    "name": "pairs", "sink": {"type": "kafka", "topic": "out"}, "processing": {},
    "source": {"type": "kafka-join", "join": {
        "left_topic": "transactions", "right_topic": "user-profiles", "join_key": "user_id",
        "join_type": "temporal", "time_window": "5m"}},
}


def test_specs():
    assert spec.parse(CLICKS).dedup.key == "click"
    assert spec.parse(PAIRS).join.time_window == "5m"
    for change, message in [
        ({"name": ""}, "name"),
        ({"source": {"type": "files"}}, "source type"),
        ({"source": {"type": "kafka"}}, "topic"),
        ({"sink": {"type": "printer"}}, "sink type"),
        ({"processing": {"deduplication": {"key": "", "time_window": "1h"}}}, "key"),
        ({"processing": {"deduplication": {"key": "k", "time_window": "soon"}}}, "duration"),
        ({"processing": {"transformation": {"rules": [{"type": "cast", "field": "a", "value": "z"}]}}}, "cast"),
    ]:
        with pytest.raises(ValueError, match=message):
            spec.parse({**CLICKS, **change})


def test_switched_off_steps_are_left_out(spark):
    text = {
        "name": "n", "source": {"type": "kafka", "topic": "t"}, "sink": {"type": "kafka", "topic": "o"},
        "processing": {"deduplication": {"enabled": False, "key": "", "time_window": "x"}},
    }
    flow = flows.compile_flow(spec.parse(text), {"t": topic(spark, '{"id":"1"}', '{"id":"1"}', "x")})
    assert flows.sink_rows(flow).count() == 2 and flow.errors.count() == 1


def test_inner_join_flow(spark):
    text = dict(PAIRS)
    text["source"] = {"type": "kafka-join", "join": {**text["source"]["join"], "join_type": "inner"}}
    left = topic(spark, '{"id":"l1","user_id":1}', '{"id":"l2","user_id":"1"}')
    right = topic(spark, '{"id":"r1","user_id":1.0}', '{"id":"r2","user_id":2}')
    flow = flows.compile_flow(spec.parse(text), {"transactions": left, "user-profiles": right})
    got = flows.columns_of(flow.output, {"joined_id": "string", "join_delay": "bigint"}).collect()
    assert sorted(tuple(r) for r in got) == [("joined_l1_r1", 0), ("joined_l2_r1", 0)]


def test_table_rules(spark):
    source = spark.sql(
        "select 't1' transaction_id, 'u' user_id, timestamp'2024-01-01 00:00:00.75' timestamp, 10 amount, 1 extra"
    )
    table = tables.ENRICHED_TRANSACTIONS
    good, bad = tables.load_rows(source, table)
    row = good.first()
    assert row["currency"] == "USD" and str(row["amount"]) == "10.00" and row["timestamp"].microsecond == 0
    assert bad.count() == 0 and tables.extra_columns(source, table) == ["extra"]
    missing = source.drop("user_id")
    assert tables.load_rows(missing, table)[1].first()["error_reason"] == "null_user_id"
    as_of = source.first()["timestamp"]
    assert tables.retention(source, "timestamp", "1 DAY", as_of).count() == 1
    assert tables.retention(source, "timestamp", "1 DAY", as_of + timedelta(days=2)).count() == 0
    wrong = source.withColumns({"amount": F.lit("oops"), "timestamp": F.lit("never")})
    kept, dead = tables.load_rows(wrong, table)
    assert kept.count() == 0 and dead.first()["error_reason"] == "bad_timestamp: never"


def test_scratch_goes_to_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert root and shared_dir(spark, "x").startswith(f"{root}/x-")


def test_typed_default_must_fit(spark):
    rows = spark.sql("select cast(null as int) n, cast(null as timestamp) t, cast(null as string) s")
    for field, value in (("n", "abc"), ("t", "noon")):
        with pytest.raises(ValueError, match=field):
            transforms.default(rows, field, value)
    assert transforms.default(rows, "n", "7").first()["n"] == 7
    assert transforms.default(rows, "s", "abc").first()["s"] == "abc"
