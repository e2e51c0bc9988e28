"""Queries of the conform operators: whole tables, with bad values mixed in."""

from __future__ import annotations

from pyspark.sql import functions as F

from quayload.functions import temporal, zones
from quayload.functions.hold import Hold
from quayload.operators import conform
from quayload.operators.planning import plan_schema
from quayload.plans.registry import query, table
from quayload.plans.sqltext import datetime2, fdiv, fmod, fragments, utf16
from quayload.policy import LoadPlan, PlannedColumn, PlanOptions, SourceType, TargetType
from quayload.sources.shapes import shaped, source


def conformed(df, keep, options=PlanOptions()):
    """Conform all columns but ``keep``."""
    plan = plan_schema(df.drop(*keep).schema, options)
    return conform.conform_columns(df, plan, keep)


def flat(df, names, fields):
    """Struct columns as one column per field."""
    for name in names:
        df = df.withColumns({f"{name}_{f}": F.col(name)[f] for f in fields}).drop(name)
    return df


@query("conform_widen", """
SELECT l_orderkey, l_linenumber,
       l_returnflag = 'R' AS is_returned, CAST(NULL AS VARCHAR) AS is_returned_code,
       l_linenumber::SMALLINT AS line8, CAST(NULL AS VARCHAR) AS line8_code,
       l_linenumber::SMALLINT AS line16, CAST(NULL AS VARCHAR) AS line16_code,
       l_linenumber AS line32, CAST(NULL AS VARCHAR) AS line32_code,
       l_partkey AS part64, CAST(NULL AS VARCHAR) AS part64_code,
       (l_suppkey % 65536)::INTEGER AS supp_u16, CAST(NULL AS VARCHAR) AS supp_u16_code,
       l_partkey AS part_u32, CAST(NULL AS VARCHAR) AS part_u32_code
FROM lineitem""")
def conform_widen(spark, sf_dir):
    line = F.col("l_linenumber")
    df = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        (F.col("l_returnflag") == "R").alias("is_returned"),
        line.cast("tinyint").alias("line8"), line.cast("smallint").alias("line16"), line.alias("line32"),
        F.col("l_partkey").alias("part64"),
        source((F.col("l_suppkey") % 65536).cast("int"), "supp_u16", "uint16"),
        source(F.col("l_partkey"), "part_u32", "uint32"),
    )
    return conformed(df, ["l_orderkey", "l_linenumber"])


@query("conform_tinyint", """
SELECT event_id, CASE WHEN v BETWEEN 0 AND 255 THEN v::SMALLINT END AS small,
       CASE WHEN NOT v BETWEEN 0 AND 255 THEN 'IntegerOutOfRange' END AS small_code
FROM (SELECT event_id, CASE WHEN event_id % 31 <> 0 THEN event_id % 300 - 20 END AS v FROM events)""")
def conform_tinyint(spark, sf_dir):
    value = F.when(F.col("event_id") % 31 != 0, F.col("event_id") % 300 - 20)
    df = table(spark, sf_dir, "events").select("event_id", source(value, "small", "uint8"))
    return conformed(df, ["event_id"])


@query("conform_uint64_decimal", """
SELECT event_id,
       CAST(event_id % 1000000000 AS DECIMAL(20,0)) AS u64_small, CAST(NULL AS VARCHAR) AS u64_small_code,
       CAST(9223372036854775807::HUGEINT - event_id % 1000000 AS DECIMAL(20,0)) AS u64_mid,
       CAST(NULL AS VARCHAR) AS u64_mid_code,
       CAST(18446744073709551615::HUGEINT - event_id % 1000000 AS DECIMAL(20,0)) AS u64_full,
       CAST(NULL AS VARCHAR) AS u64_full_code,
       CASE WHEN event_id % 13 <> 0
            THEN CAST(18446744073709551615::HUGEINT - event_id % 1000000 AS DECIMAL(20,0)) END AS maybe_u64_full,
       CAST(NULL AS VARCHAR) AS maybe_u64_full_code
FROM events""")
def conform_uint64_decimal(spark, sf_dir):
    df = shaped(table(spark, sf_dir, "events"), "event_id", "uint64_policy", ["event_id"]).drop("row_id")
    return conformed(df, ["event_id"], PlanOptions(uint64="decimal"))


@query("conform_uint64_bigint", """
SELECT event_id,
       (event_id % 1000000000) AS u64_small, CAST(NULL AS VARCHAR) AS u64_small_code,
       9223372036854775807 - event_id % 1000000 AS u64_mid, CAST(NULL AS VARCHAR) AS u64_mid_code,
       CAST(NULL AS BIGINT) AS u64_full, 'IntegerOutOfRange' AS u64_full_code,
       CAST(NULL AS BIGINT) AS maybe_u64_full,
       CASE WHEN event_id % 13 <> 0 THEN 'IntegerOutOfRange' END AS maybe_u64_full_code
FROM events""")
def conform_uint64_bigint(spark, sf_dir):
    df = shaped(table(spark, sf_dir, "events"), "event_id", "uint64_policy", ["event_id"]).drop("row_id")
    return conformed(df, ["event_id"], PlanOptions(uint64="bigint"))


def with_non_finite(value, key, kind):
    return (
        F.when(key % 97 == 0, F.lit("NaN").cast(kind))
        .when(key % 101 == 0, F.lit("Infinity").cast(kind))
        .when(key % 103 == 0, F.lit("-Infinity").cast(kind))
        .otherwise(value.cast(kind))
    )


@query("conform_real", """
SELECT event_id,
       CASE WHEN event_id % 97 <> 0 AND event_id % 101 <> 0 AND event_id % 103 <> 0 THEN value::FLOAT END AS reading,
       CASE WHEN event_id % 97 = 0 OR event_id % 101 = 0 OR event_id % 103 = 0
            THEN 'NonFiniteFloat' END AS reading_code
FROM events""")
def conform_real(spark, sf_dir):
    reading = with_non_finite(F.col("value"), F.col("event_id"), "float").alias("reading")
    return conformed(table(spark, sf_dir, "events").select("event_id", reading), ["event_id"])


@query("conform_float", """
SELECT l_orderkey, l_linenumber, l_partkey,
       CASE WHEN l_partkey % 97 <> 0 AND l_partkey % 101 <> 0 AND l_partkey % 103 <> 0
            THEN l_extendedprice END AS price,
       CASE WHEN l_partkey % 97 = 0 OR l_partkey % 101 = 0 OR l_partkey % 103 = 0
            THEN 'NonFiniteFloat' END AS price_code
FROM lineitem""")
def conform_float(spark, sf_dir):
    price = with_non_finite(F.col("l_extendedprice"), F.col("l_partkey"), "double").alias("price")
    keep = ["l_orderkey", "l_linenumber", "l_partkey"]
    return conformed(table(spark, sf_dir, "lineitem").select(*keep, price), keep)


@query("conform_nvarchar", f"""
WITH s AS (SELECT doc_id, text, lang || '😀' AS tag, lang || source AS origin FROM documents)
SELECT doc_id,
       CASE WHEN {utf16('text')} <= 1000 THEN text END AS text,
       CASE WHEN {utf16('text')} > 1000 THEN 'ValueTooLong' END AS text_code,
       CASE WHEN {utf16('tag')} <= 3 THEN tag END AS tag,
       CASE WHEN {utf16('tag')} > 3 THEN 'ValueTooLong' END AS tag_code,
       origin, CAST(NULL AS VARCHAR) AS origin_code
FROM s""")
def conform_nvarchar(spark, sf_dir):
    df = table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.concat("lang", F.lit("😀")).alias("tag"), F.concat("lang", "source").alias("origin"))
    utf8 = SourceType("utf8")
    plan = LoadPlan((
        PlannedColumn(1, "text", True, utf8, TargetType("nvarchar", length=1000)),
        PlannedColumn(2, "tag", True, utf8, TargetType("nvarchar", length=3)),
        PlannedColumn(3, "origin", True, utf8, TargetType("nvarchar")),
    ))
    return conform.conform_columns(df, plan, ["doc_id"])


@query("conform_varbinary", """
SELECT doc_id,
       CASE WHEN octet_length(encode(text)) <= 1000 THEN encode(text) END AS body,
       CASE WHEN octet_length(encode(text)) > 1000 THEN 'ValueTooLong' END AS body_code,
       encode(source) AS origin, CAST(NULL AS VARCHAR) AS origin_code
FROM documents""")
def conform_varbinary(spark, sf_dir):
    df = table(spark, sf_dir, "documents").select(
        "doc_id", F.encode("text", "UTF-8").alias("body"), F.encode("source", "UTF-8").alias("origin"))
    return conformed(df, ["doc_id"], PlanOptions(binary=1000))


@query("conform_binary_n", """
SELECT doc_id,
       CASE WHEN doc_id % 7 <> 0 THEN unhex(md5(text)) END AS digest,
       CASE WHEN doc_id % 7 = 0 THEN 'ValueTypeMismatch' END AS digest_code
FROM documents""")
def conform_binary_n(spark, sf_dir):
    digest = F.unhex(F.md5("text"))
    short = F.when(F.col("doc_id") % 7 == 0, F.substring(digest, 1, 15)).otherwise(digest)
    df = table(spark, sf_dir, "documents").select("doc_id", source(short, "digest", "fixed_binary(16)"))
    return conformed(df, ["doc_id"])


@query("conform_decimal", """
WITH s AS (SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_extendedprice AS DECIMAL(18,2))
                  * CASE WHEN l_partkey % 3 = 0 THEN -1 ELSE 1 END AS amount FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey,
       CASE WHEN abs(amount) <= 99999.99 THEN CAST(amount AS DECIMAL(7,2)) END AS amount,
       CASE WHEN abs(amount) > 99999.99 THEN 'DecimalOutOfRange' END AS amount_code
FROM s""")
def conform_decimal(spark, sf_dir):
    sign = F.when(F.col("l_partkey") % 3 == 0, F.lit(-1)).otherwise(F.lit(1))
    keep = ["l_orderkey", "l_linenumber", "l_partkey"]
    amount = (F.col("l_extendedprice").cast("decimal(18,2)") * sign).cast("decimal(18,2)")
    df = table(spark, sf_dir, "lineitem").select(*keep, amount.alias("amount"))
    plan = LoadPlan((PlannedColumn(
        3, "amount", True, SourceType("decimal", precision=18, scale=2), TargetType("decimal", precision=7, scale=2)),))
    return conform.conform_columns(df, plan, keep)


@query("conform_negative_scale", """
WITH s AS (SELECT o_orderkey, CASE WHEN o_orderkey % 50 = 0 THEN 1000000000000 + o_orderkey
                                   WHEN o_orderkey % 2 = 0 THEN -o_orderkey ELSE o_custkey END AS u FROM orders)
SELECT o_orderkey,
       CASE WHEN abs(u) * 100 <= 99999999999 THEN CAST(u * 100 AS DECIMAL(11,0)) END AS hundreds,
       CASE WHEN abs(u) * 100 > 99999999999 THEN 'DecimalOutOfRange' END AS hundreds_code
FROM s""")
def conform_negative_scale(spark, sf_dir):
    key = F.col("o_orderkey")
    unscaled = F.when(key % 50 == 0, F.lit(1_000_000_000_000) + key).when(key % 2 == 0, -key).otherwise(F.col("o_custkey"))
    df = table(spark, sf_dir, "orders").select("o_orderkey", source(unscaled, "hundreds", "decimal(9,-2)"))
    return conformed(df, ["o_orderkey"], PlanOptions(decimal="normalize"))


@query("conform_wide_decimal", """
WITH s AS (SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN '-' ELSE '' END AS sign,
                  '1' || lpad(o_orderkey::VARCHAR, 12, '0') || repeat('7', (o_orderkey % 40)::INTEGER) AS digits
           FROM orders)
SELECT o_orderkey,
       CASE WHEN length(digits) <= 38
            THEN CAST(sign || left(digits, length(digits) - 6) || '.' || right(digits, 6) AS DECIMAL(38,6)) END AS total,
       CASE WHEN length(digits) > 38 THEN 'DecimalOutOfRange' END AS total_code
FROM s""")
def conform_wide_decimal(spark, sf_dir):
    key = F.col("o_orderkey")
    sign = F.when(key % 2 == 0, F.lit("-")).otherwise(F.lit(""))
    digits = F.concat(F.lit("1"), F.lpad(key.cast("string"), 12, "0"), F.repeat(F.lit("7"), (key % 40).cast("int")))
    df = table(spark, sf_dir, "orders").select(
        "o_orderkey", source(F.concat(sign, digits), "total", "wide_decimal(38,6)"))
    return conformed(df, ["o_orderkey"])


@query("conform_date", """
WITH s AS (SELECT o_orderkey, CASE WHEN o_orderkey % 89 = 0 THEN DATE '9999-12-31' + (o_orderkey % 5)::INTEGER
                                   WHEN o_orderkey % 97 = 0 THEN DATE '0001-01-01' - (o_orderkey % 3)::INTEGER
                                   ELSE o_orderdate::DATE END AS d FROM orders),
     n AS (SELECT o_orderkey, (d - DATE '0001-01-01')::INTEGER AS day FROM s)
SELECT o_orderkey, CASE WHEN day BETWEEN 0 AND 3652058 THEN day END AS ordered,
       CASE WHEN NOT day BETWEEN 0 AND 3652058 THEN 'TimestampOutOfRange' END AS ordered_code
FROM n""")
def conform_date(spark, sf_dir):
    key = F.col("o_orderkey")
    day = (
        F.when(key % 89 == 0, F.date_add(F.lit("9999-12-31").cast("date"), (key % 5).cast("int")))
        .when(key % 97 == 0, F.date_sub(F.lit("0001-01-01").cast("date"), (key % 3).cast("int")))
        .otherwise(F.col("o_orderdate").cast("date"))
    )
    return conformed(table(spark, sf_dir, "orders").select("o_orderkey", day.alias("ordered")), ["o_orderkey"])


MILLIS = "CASE WHEN event_id % 97 = 0 THEN 253402300800000 + event_id ELSE (event_id - 5000) * 17123457 END"


@query("conform_date64", f"""
WITH s AS (SELECT event_id, {MILLIS} AS ms FROM events),
     d AS (SELECT event_id, {fdiv('ms', 86400000)} + 719162 AS day, {fmod('ms', 86400000)} AS inc FROM s)
SELECT event_id,
       CASE WHEN day BETWEEN 0 AND 3652058 THEN day::INTEGER END AS posted_day,
       CASE WHEN day BETWEEN 0 AND 3652058 THEN inc::BIGINT END AS posted_increments,
       CASE WHEN NOT day BETWEEN 0 AND 3652058 THEN 'TimestampOutOfRange' END AS posted_code
FROM d""")
def conform_date64(spark, sf_dir):
    key = F.col("event_id")
    millis = F.when(key % 97 == 0, F.lit(253_402_300_800_000) + key).otherwise((key - 5000) * 17_123_457)
    df = table(spark, sf_dir, "events").select("event_id", source(millis, "posted", "date64"))
    return flat(conformed(df, ["event_id"], PlanOptions(date64="datetime2")), ["posted"], ["day", "increments"])


@query("conform_time", """
WITH s AS (SELECT event_id, event_id * 131 % 90000 - 50 AS s, event_id * 131071 % 86500000 AS ms,
                  event_id % 1000003 * 8191000007 % 86400000000 AS us, event_id % 1000003 * 7919000000077 % 86400000000000 AS raw FROM events),
     n AS (SELECT *, CASE WHEN event_id % 53 = 0 THEN 86399999999950 + event_id % 60 ELSE raw END AS ns FROM s),
     t AS (SELECT *, (ns + 50) // 100 AS tick FROM n)
SELECT event_id,
       CASE WHEN s BETWEEN 0 AND 86399 THEN s END AS at_s,
       CASE WHEN NOT s BETWEEN 0 AND 86399 THEN 'TimestampOutOfRange' END AS at_s_code,
       CASE WHEN ms < 86400000 THEN ms END AS at_ms,
       CASE WHEN ms >= 86400000 THEN 'TimestampOutOfRange' END AS at_ms_code,
       us AS at_us, CAST(NULL AS VARCHAR) AS at_us_code,
       CASE WHEN ns < 86400000000000 AND tick < 864000000000 THEN tick END AS at_ns,
       CASE WHEN ns >= 86400000000000 OR tick >= 864000000000 THEN 'TimestampOutOfRange' END AS at_ns_code
FROM t""")
def conform_time(spark, sf_dir):
    key = F.col("event_id")
    nanos = F.when(key % 53 == 0, F.lit(86_399_999_999_950) + key % 60).otherwise(
        key % 1_000_003 * 7_919_000_000_077 % 86_400_000_000_000)
    df = table(spark, sf_dir, "events").select(
        "event_id",
        source(key * 131 % 90_000 - 50, "at_s", "time(s)"),
        source(key * 131_071 % 86_500_000, "at_ms", "time(ms)"),
        source(key % 1_000_003 * 8_191_000_007 % 86_400_000_000, "at_us", "time(us)"),
        source(nanos, "at_ns", "time(ns)"),
    )
    return conformed(df, ["event_id"], PlanOptions(nanosecond="round"))


def _datetime2_sql(name: str, ticks: str, precision: int) -> str:
    day, inc, ok = datetime2(ticks, precision)
    return (f"CASE WHEN {ok} THEN ({day})::INTEGER END AS {name}_day, "
            f"CASE WHEN {ok} THEN ({inc})::BIGINT END AS {name}_increments, "
            f"CASE WHEN NOT {ok} THEN 'TimestampOutOfRange' END AS {name}_code")


@query("conform_datetime2", f"""
WITH s AS (SELECT event_id, epoch_us(ts)::HUGEINT * 10 AS t,
                  (event_id::HUGEINT % 1000000 - 5000) * 51000001 * 10000000 AS far,
                  CASE WHEN event_id % 11 = 0 THEN 253402300799999 - event_id % 3
                       ELSE (event_id % 1000000 - 5000) * 9876543211 END::HUGEINT * 10000 AS near FROM events)
SELECT event_id, {_datetime2_sql('p0', 't', 0)}, {_datetime2_sql('p3', 't', 3)}, {_datetime2_sql('p7', 't', 7)},
       {_datetime2_sql('far', 'far', 0)}, {_datetime2_sql('near', 'near', 2)}
FROM s""")
def conform_datetime2(spark, sf_dir):
    key = F.col("event_id")
    near = F.when(key % 11 == 0, F.lit(253_402_300_799_999) - key % 3).otherwise((key % 1_000_000 - 5000) * 9_876_543_211)
    df = table(spark, sf_dir, "events").select(
        "event_id", F.col("ts").alias("p0"), F.col("ts").alias("p3"), F.col("ts").alias("p7"),
        ((key % 1_000_000 - 5000) * 51_000_001).alias("far"), near.alias("near"))
    micros, seconds, millis = (SourceType("timestamp", unit=u) for u in ("us", "s", "ms"))
    plan = LoadPlan(tuple(
        PlannedColumn(i, name, True, kind, TargetType("datetime2", precision=p))
        for i, (name, kind, p) in enumerate(
            [("p0", micros, 0), ("p3", micros, 3), ("p7", micros, 7), ("far", seconds, 0), ("near", millis, 2)])
    ))
    return flat(conform.conform_columns(df, plan, ["event_id"]), ["p0", "p3", "p7", "far", "near"], ["day", "increments"])


def _fragments_sql(name: str, ticks: str, two_step: bool) -> str:
    day, part, ok = fragments(ticks, two_step)
    return (f"CASE WHEN {ok} THEN ({day})::INTEGER END AS {name}_day, "
            f"CASE WHEN {ok} THEN ({part})::INTEGER END AS {name}_fragments, "
            f"CASE WHEN NOT {ok} THEN 'TimestampOutOfRange' END AS {name}_code")


def _datetime_oracle(two_step: bool) -> str:
    return f"""
WITH s AS (SELECT event_id, epoch_us(ts)::HUGEINT * 10 AS t,
                  ((event_id % 1000000 - 5000) * 1600000007)::HUGEINT * 10000 AS far,
                  CASE WHEN event_id % 7 = 0 THEN 2534023007999985 + event_id % 20
                       ELSE (event_id % 1000000 - 5000) * 3333333331 END::HUGEINT AS tenth FROM events)
SELECT event_id, {_fragments_sql('at', 't', two_step)}, {_fragments_sql('far', 'far', two_step)},
       {_fragments_sql('fine', 'tenth', two_step)}
FROM s"""


def _datetime_query(spark, sf_dir, rounding):
    key = F.col("event_id")
    fine = F.when(key % 7 == 0, F.lit(2_534_023_007_999_985) + key % 20).otherwise((key % 1_000_000 - 5000) * 3_333_333_331)
    df = table(spark, sf_dir, "events").select(
        "event_id", F.col("ts").alias("at"),
        source((key % 1_000_000 - 5000) * 1_600_000_007, "far", "timestamp(ms)"),
        source(fine * 100, "fine", "timestamp(ns)"))
    options = PlanOptions(timestamp="datetime", datetime_rounding=rounding, nanosecond="reject")
    return flat(conformed(df, ["event_id"], options), ["at", "far", "fine"], ["day", "fragments"])


@query("conform_datetime_legacy", _datetime_oracle(True))
def conform_datetime_legacy(spark, sf_dir):
    return _datetime_query(spark, sf_dir, "two_step")


@query("conform_datetime_compat", _datetime_oracle(False))
def conform_datetime_compat(spark, sf_dir):
    return _datetime_query(spark, sf_dir, "one_step")


def _nanos_sql(name: str, ticks: str, reject: bool = False) -> str:
    day, inc, _ = datetime2(ticks, 7)
    good = "ns % 100 = 0" if reject else "true"
    return (f"CASE WHEN {good} THEN ({day})::INTEGER END AS {name}_day, "
            f"CASE WHEN {good} THEN ({inc})::BIGINT END AS {name}_increments, "
            f"CASE WHEN NOT ({good}) THEN 'LossyConversionRequiresPolicy' END AS {name}_code")


@query("conform_nanos", f"""
WITH s AS (SELECT event_id, (event_id % 70000 - 5000) * 123456789012345 + (event_id % 4) * 25 AS ns FROM events)
SELECT event_id, {_nanos_sql('strict', fdiv('ns', 100), True)},
       {_nanos_sql('rounded', fdiv('ns + 50', 100))}, {_nanos_sql('cut', fdiv('ns', 100))}
FROM s""")
def conform_nanos(spark, sf_dir):
    key = F.col("event_id")
    nanos = (key % 70_000 - 5000) * 123_456_789_012_345 + (key % 4) * 25
    df = table(spark, sf_dir, "events")
    columns, hold = [], Hold()
    for name, rule in (("strict", "reject"), ("rounded", "round"), ("cut", "truncate")):
        checked = temporal.datetime2(temporal.instant_from_nanos(nanos, rule, hold), 7, hold)
        columns += [checked.value.alias(name), checked.code.alias(f"{name}_code")]
    return flat(hold.add_to(df).select("event_id", *columns), ["strict", "rounded", "cut"], ["day", "increments"])


@query("conform_tz_utc", f"""
WITH s AS (SELECT event_id, ((event_id % 4000000 - 2000) * 86399999999)::HUGEINT * 10 AS t FROM events)
SELECT event_id, {_datetime2_sql('moment', 't', 3)}, {_fragments_sql('legacy', 't', True)} FROM s""")
def conform_tz_utc(spark, sf_dir):
    moment = F.timestamp_micros((F.col("event_id") % 4_000_000 - 2000) * 86_399_999_999)
    df = table(spark, sf_dir, "events").select("event_id", moment.alias("moment"), moment.alias("legacy"))
    zoned = SourceType("timestamp", unit="us", zone="America/New_York")
    plan = LoadPlan((
        PlannedColumn(0, "moment", True, zoned, TargetType("datetime2", precision=3)),
        PlannedColumn(1, "legacy", True, zoned, TargetType("datetime")),
    ), PlanOptions(timezone="utc"))
    out = conform.conform_columns(df, plan, ["event_id"])
    return flat(flat(out, ["moment"], ["day", "increments"]), ["legacy"], ["day", "fragments"])


def _offset_sql(name: str, zone: str) -> str:
    us = "us"
    if zone[0] in "+-":
        sign = -1 if zone[0] == "-" else 1
        seconds = str(sign * (int(zone[1:3]) * 3600 + int(zone[-2:]) * 60))
    else:
        seconds = f"((epoch_us(timezone('{zone}', make_timestamptz({us}))) - {us}) // 1000000)"
    good = f"({seconds}) % 60 = 0"
    return (f"CASE WHEN {good} THEN ({fdiv(us, 86400000000)} + 719162)::INTEGER END AS {name}_day, "
            f"CASE WHEN {good} THEN ({fmod(us, 86400000000)} * 10)::BIGINT END AS {name}_increments, "
            f"CASE WHEN {good} THEN (({seconds}) // 60)::INTEGER END AS {name}_offset_minutes, "
            f"CASE WHEN NOT ({good}) THEN 'TimezoneUnsupported' END AS {name}_code")


ZONES = {"new_york": "America/New_York", "kolkata": "Asia/Kolkata", "half": "+02:30", "west": "-0800"}


@query("conform_datetimeoffset", f"""
WITH s AS (SELECT event_id, (event_id % 20000 - 12000) * 400000000123 + 1700000000000000 AS us FROM events)
SELECT event_id, {', '.join(_offset_sql(n, z) for n, z in ZONES.items())} FROM s""")
def conform_datetimeoffset(spark, sf_dir):
    moment = F.timestamp_micros((F.col("event_id") % 20_000 - 12_000) * 400_000_000_123 + 1_700_000_000_000_000)
    df = table(spark, sf_dir, "events").select("event_id", *[moment.alias(n) for n in ZONES])
    plan = LoadPlan(tuple(
        PlannedColumn(i, n, True, SourceType("timestamp", unit="us", zone=z), TargetType("datetimeoffset", precision=7))
        for i, (n, z) in enumerate(ZONES.items())
    ), PlanOptions(timezone="offset"))
    out = conform.conform_columns(df, plan, ["event_id"])
    return flat(out, list(ZONES), ["day", "increments", "offset_minutes"])


ZONE_NAMES = [
    "UTC", "z", "+01", "+0530", "-03:30", "+14:00", "+14:01", "+12:60", "+1", "America/New_York", "Europe/Paris",
    "Australia/Lord_Howe", "Asia/Kathmandu", "Mars/Olympus", "PST", "GMT+5", "america/new_york", "", "Etc/GMT+5",
]
_NAME_LIST = "[" + ", ".join(f"'{n}'" for n in ZONE_NAMES) + "]"


@query("conform_tz_names", f"""
WITH s AS (SELECT event_id, {_NAME_LIST}[(event_id % {len(ZONE_NAMES)})::INTEGER + 1] AS zone,
                  event_id % 1000000 * 3600000000 + 1600000000000000 AS us FROM events),
     named(name) AS (VALUES ('America/New_York'), ('Europe/Paris'), ('Australia/Lord_Howe'), ('Asia/Kathmandu'), ('Etc/GMT+5')),
     f AS (SELECT s.*, name, upper(zone) IN ('Z', 'UTC') AS utc,
                  regexp_full_match(zone, '[+-]([0-9]{{2}}|[0-9]{{2}}:?[0-9]{{2}})') AS shaped,
                  TRY_CAST(substr(zone, 2, 2) AS INTEGER) AS hh,
                  CASE WHEN length(zone) > 3 THEN TRY_CAST(right(zone, 2) AS INTEGER) ELSE 0 END AS mm
           FROM s LEFT JOIN named ON s.zone = named.name),
     o AS (SELECT event_id, zone,
                  CASE WHEN utc THEN 0
                       WHEN shaped AND mm < 60 AND hh * 60 + mm <= 840
                       THEN CASE WHEN zone[1] = '-' THEN -1 ELSE 1 END * (hh * 60 + mm)
                       WHEN name IS NOT NULL THEN (epoch_us(timezone(name, make_timestamptz(us))) - us) // 60000000 END AS m
           FROM f)
SELECT event_id, zone, m::INTEGER AS offset_minutes, CASE WHEN m IS NULL THEN 'TimezoneUnsupported' END AS code FROM o""")
def conform_tz_names(spark, sf_dir):
    key = F.col("event_id")
    names = F.array(*[F.lit(n) for n in ZONE_NAMES])
    df = table(spark, sf_dir, "events").select(
        "event_id", F.element_at(names, (key % len(ZONE_NAMES)).cast("int") + 1).alias("zone"),
        F.timestamp_micros(key % 1_000_000 * 3_600_000_000 + 1_600_000_000_000_000).alias("moment"))
    return zones.with_offsets(df, "moment", "zone").drop("moment")


@query("conform_not_null", """
SELECT event_id, CASE WHEN event_id % 53 <> 0 THEN value END AS required,
       CASE WHEN event_id % 53 = 0 THEN 'NullInNonNullableColumn' END AS required_code,
       CASE WHEN event_id % 53 <> 0 THEN value END AS optional, CAST(NULL AS VARCHAR) AS optional_code
FROM events""")
def conform_not_null(spark, sf_dir):
    value = F.when(F.col("event_id") % 53 != 0, F.col("value"))
    df = table(spark, sf_dir, "events").select("event_id", value.alias("required"), value.alias("optional"))
    double, target = SourceType("float64"), TargetType("float", precision=53)
    plan = LoadPlan((PlannedColumn(0, "required", False, double, target), PlannedColumn(1, "optional", True, double, target)))
    return conform.conform_columns(df, plan, ["event_id"])


@query("conform_table", f"""
WITH s AS (SELECT *, epoch_us(l_shipdate)::HUGEINT * 10 AS t FROM lineitem),
     c AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
                  CASE WHEN l_partkey % 97 <> 0 AND l_partkey % 101 <> 0 AND l_partkey % 103 <> 0
                       THEN l_extendedprice END AS price,
                  CASE WHEN l_quantity < 50 THEN l_quantity END AS quantity,
                  CASE WHEN length(l_returnflag || l_linestatus) <= 1 THEN l_returnflag || l_linestatus END AS flags,
                  {datetime2('t', 0)[0]}::INTEGER AS ship_day, {datetime2('t', 0)[1]}::BIGINT AS ship_increments
           FROM s)
SELECT *, concat_ws(',', CASE WHEN price IS NULL THEN 'price' END, CASE WHEN quantity IS NULL THEN 'quantity' END,
                    CASE WHEN flags IS NULL THEN 'flags' END) AS bad_fields,
       concat_ws(',', CASE WHEN price IS NULL THEN 'NonFiniteFloat' END,
                 CASE WHEN quantity IS NULL THEN 'NullInNonNullableColumn' END,
                 CASE WHEN flags IS NULL THEN 'ValueTooLong' END) AS codes,
       CASE WHEN price IS NULL THEN 1 ELSE 0 END + CASE WHEN quantity IS NULL THEN 1 ELSE 0 END
       + CASE WHEN flags IS NULL THEN 1 ELSE 0 END AS error_count
FROM c""")
def conform_table(spark, sf_dir):
    keep = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    df = table(spark, sf_dir, "lineitem").select(
        *keep,
        with_non_finite(F.col("l_extendedprice"), F.col("l_partkey"), "double").alias("price"),
        F.when(F.col("l_quantity") < 50, F.col("l_quantity")).alias("quantity"),
        F.concat("l_returnflag", "l_linestatus").alias("flags"),
        F.col("l_shipdate").alias("ship"),
    )
    double = SourceType("float64")
    plan = LoadPlan((
        PlannedColumn(0, "price", True, double, TargetType("float", precision=53)),
        PlannedColumn(1, "quantity", False, double, TargetType("float", precision=53)),
        PlannedColumn(2, "flags", False, SourceType("utf8"), TargetType("nvarchar", length=1)),
        PlannedColumn(3, "ship", False, SourceType("timestamp", unit="us"), TargetType("datetime2", precision=0)),
    ))
    out = conform.conform_table(df, plan, keep)
    out = out.withColumns({
        "bad_fields": F.array_join("errors.field_name", ","), "codes": F.array_join("errors.code", ",")})
    return flat(out.drop("errors"), ["ship"], ["day", "increments"])
