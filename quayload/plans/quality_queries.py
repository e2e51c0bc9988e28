"""Queries of diagnostics, batch acceptance and drift, on one load of ``events``."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from quayload.functions.exact import floor_div
from quayload.operators import conform, drift, quality
from quayload.plans.registry import query, table
from quayload.plans.sqltext import datetime2
from quayload.policy import LoadPlan, PlannedColumn, SourceType, TargetType
from quayload.session import shared_path
from quayload.sources import sinks
from quayload.sources.batching import batches_by_key

BATCH_ROWS = 256
KEYS = ["batch_id", "event_id"]

EVENTS_PLAN = LoadPlan((
    PlannedColumn(0, "event_id", False, SourceType("int64"), TargetType("bigint")),
    PlannedColumn(1, "ts", False, SourceType("timestamp", unit="us"), TargetType("datetime2", precision=3)),
    PlannedColumn(2, "user_id", False, SourceType("int64"), TargetType("bigint")),
    PlannedColumn(3, "event_type", True, SourceType("utf8"), TargetType("nvarchar", length=8)),
    PlannedColumn(4, "value", False, SourceType("float64"), TargetType("float", precision=53)),
))


def events_with_faults(spark, sf_dir):
    """Events in batches, with rare values that break a rule."""
    key = F.col("event_id")
    value = (
        F.when(key % 997 == 0, F.lit("NaN").cast("double"))
        .when(key % 1499 == 0, F.lit(None).cast("double"))
        .otherwise(F.col("value"))
    )
    kind = F.when(key % 997 == 1, F.concat("event_type", F.lit("_overlong"))).when(
        key % 997 == 0, F.lit("much_too_long")).otherwise(F.col("event_type"))
    df = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", kind.alias("event_type"), value.alias("value"))
    return batches_by_key(df, "event_id", BATCH_ROWS)


def events_conformed(spark, sf_dir):
    return conform.conform_table(events_with_faults(spark, sf_dir), EVENTS_PLAN, KEYS)


def violations(spark, sf_dir):
    return quality.diagnostics(events_conformed(spark, sf_dir), KEYS)


def events_with_unnamed_batch(spark, sf_dir, which: str):
    """The same load, the rows of some batches without a batch id."""
    return events_with_faults(spark, sf_dir).withColumn("batch_id", F.when(~F.expr(which), F.col("batch_id")))


def conformed_with_unnamed_batch(spark, sf_dir, which: str):
    return conform.conform_table(events_with_unnamed_batch(spark, sf_dir, which), EVENTS_PLAN, KEYS)


#: Batches that lose their id: together rejected (one has a bad value), or accepted.
UNNAMED_BAD, UNNAMED_GOOD = "batch_id % 13 = 4", "batch_id in (2, 36)"


def faults_sql(batch: str) -> str:
    """Batches and violations of the same load, stated without the operators."""
    return f"""
WITH src AS (SELECT event_id, {batch} AS batch_id FROM (SELECT event_id, event_id // {BATCH_ROWS} AS batch_id FROM events)),
     bad AS (
       SELECT batch_id, event_id, 'error' AS severity, 'ValueTooLong' AS code, 3 AS field_index, 'event_type' AS field_name
       FROM src WHERE event_id % 997 IN (0, 1)
       UNION ALL
       SELECT batch_id, event_id, 'error', CASE WHEN event_id % 997 = 0 THEN 'NonFiniteFloat' ELSE 'NullInNonNullableColumn' END,
              4, 'value' FROM src WHERE event_id % 997 = 0 OR event_id % 1499 = 0)
"""


FAULTS = faults_sql("batch_id")
_DAY, _INC, _ = datetime2("t", 3)
#: Events as they are stored, with the time as text.
STORED = f"""
, timed AS (SELECT *, epoch_us(ts)::HUGEINT * 10 AS t FROM events), split AS (SELECT *, {_DAY} AS day, {_INC} AS inc FROM timed),
  stored AS (SELECT * REPLACE (strftime(DATE '0001-01-01' + day::INTEGER, '%Y-%m-%d') || 'T' || printf('%02d:%02d:%02d.%03d',
    (inc // 3600000)::BIGINT, (inc // 60000 % 60)::BIGINT, (inc // 1000 % 60)::BIGINT, (inc % 1000)::BIGINT) AS ts) FROM split)
"""
#: Rows of accepted batches with all their columns; rows without a batch id are a batch.
ACCEPTED_ROWS = faults_sql(f"CASE WHEN NOT ({UNNAMED_BAD}) THEN batch_id END") + STORED + """
SELECT s.batch_id, e.event_id, e.ts, e.user_id, e.event_type, e.value{more} FROM stored e JOIN src s USING (event_id)
WHERE NOT EXISTS (SELECT 1 FROM bad b WHERE b.batch_id IS NOT DISTINCT FROM s.batch_id)"""


@query("diagnostics", FAULTS + "SELECT * FROM bad")
def diagnostics(spark, sf_dir):
    return violations(spark, sf_dir)


@query("diagnostic_messages", FAULTS + """
SELECT batch_id, event_id, severity, code, field_index, field_name, 'column ' || field_name || ': ' || CASE code
       WHEN 'ValueTooLong' THEN 'value is longer than the column' WHEN 'NonFiniteFloat' THEN 'value is not a finite number'
       ELSE 'NULL in a column that takes none' END AS message FROM bad""")
def diagnostic_messages(spark, sf_dir):
    return quality.with_messages(violations(spark, sf_dir))


@query("batch_load", ACCEPTED_ROWS.format(more=", 'nightly' AS load_id"))
def batch_load(spark, sf_dir):
    """Rows of good batches, published and read back; rows without a batch id are one bad batch."""
    target = shared_path(spark, "batches")
    sinks.batch_load(events_with_unnamed_batch(spark, sf_dir, UNNAMED_BAD), EVENTS_PLAN, "batch_id", target, "nightly")
    schema = T.StructType.fromDDL("batch_id long, event_id long, ts string, user_id long, event_type string, value double")
    return sinks.read_published(spark, target, schema)


@query("first_violation_row_major", FAULTS + """
SELECT batch_id, event_id, field_index, field_name, code FROM bad
QUALIFY row_number() OVER (PARTITION BY batch_id ORDER BY event_id, field_index) = 1""")
def first_violation_row_major(spark, sf_dir):
    return quality.first_violation(violations(spark, sf_dir), "batch_id", "event_id")


@query("first_violation_column_major", FAULTS + """
SELECT batch_id, event_id, field_index, field_name, code FROM bad
QUALIFY row_number() OVER (PARTITION BY batch_id ORDER BY field_index, event_id) = 1""")
def first_violation_column_major(spark, sf_dir):
    return quality.first_violation(violations(spark, sf_dir), "batch_id", "event_id", by_column=True)


@query("accepted_batches", FAULTS + """
SELECT batch_id, count(*) AS row_count FROM src
WHERE batch_id NOT IN (SELECT batch_id FROM bad) GROUP BY batch_id""")
def accepted_batches(spark, sf_dir):
    return quality.accepted_batches(events_conformed(spark, sf_dir), "batch_id")


@query("accepted_rows", ACCEPTED_ROWS.format(more=""))
def accepted_rows(spark, sf_dir):
    rows = quality.accepted_rows(conformed_with_unnamed_batch(spark, sf_dir, UNNAMED_BAD), "batch_id")
    return conform.loadable(rows, EVENTS_PLAN)


@query("rejected_batches", FAULTS + """
SELECT s.batch_id, count(DISTINCT s.event_id) AS row_count, count(DISTINCT b.event_id) AS bad_rows,
       count(b.event_id) AS violations
FROM src s LEFT JOIN bad b USING (event_id) GROUP BY s.batch_id HAVING count(b.event_id) > 0""")
def rejected_batches(spark, sf_dir):
    return quality.rejected_batches(events_conformed(spark, sf_dir), "batch_id")


@query("quarantine_rows", FAULTS + """
SELECT batch_id, event_id, string_agg(code, ',' ORDER BY field_index) AS codes FROM bad GROUP BY ALL""")
def quarantine_rows(spark, sf_dir):
    _, bad = quality.quarantine(events_conformed(spark, sf_dir))
    return bad.select(*KEYS, F.array_join("codes", ",").alias("codes"))


@query("quarantine_good_rows", FAULTS + """
SELECT batch_id, event_id FROM src WHERE event_id NOT IN (SELECT event_id FROM bad)""")
def quarantine_good_rows(spark, sf_dir):
    good, _ = quality.quarantine(events_conformed(spark, sf_dir))
    return good.select(*KEYS)


@query("diagnostic_summary", FAULTS + """
SELECT code, field_name, count(*) AS total_count, count(*) AS error_count, 0::BIGINT AS warning_count
FROM bad GROUP BY code, field_name""")
def diagnostic_summary(spark, sf_dir):
    return quality.summary(violations(spark, sf_dir))


@query("diagnostic_overview", FAULTS + """
SELECT count(*) AS total_count, count(*) AS error_count, 0::BIGINT AS warning_count,
       string_agg(DISTINCT code, ',' ORDER BY code) AS codes,
       string_agg(DISTINCT field_name, ',' ORDER BY field_name) AS field_names FROM bad""")
def diagnostic_overview(spark, sf_dir):
    return quality.overall_summary(violations(spark, sf_dir))


#: Far apart, from below zero.
_SPARSE = "batch_id * 25000000 - 300000000"


@query("running_load_stats", faults_sql(f"CASE WHEN NOT ({UNNAMED_GOOD}) THEN {_SPARSE} END") + f"""
, sent AS (SELECT DISTINCT batch_id FROM src UNION SELECT {_SPARSE} + 1 FROM (SELECT DISTINCT event_id // {BATCH_ROWS} AS batch_id FROM events) WHERE batch_id % 5 = 0),
  ok AS (SELECT t.batch_id, count(s.event_id) AS row_count FROM sent t LEFT JOIN src s ON s.batch_id IS NOT DISTINCT FROM t.batch_id
         WHERE NOT EXISTS (SELECT 1 FROM bad b WHERE b.batch_id IS NOT DISTINCT FROM t.batch_id) GROUP BY t.batch_id)
SELECT batch_id, row_count, sum(row_count) OVER (ORDER BY batch_id NULLS FIRST)::BIGINT AS rows_written,
       count(*) OVER (ORDER BY batch_id NULLS FIRST) AS batches_written FROM ok""")
def running_load_stats(spark, sf_dir):
    """Ids far apart, rows without a batch id, and batches that were sent without rows."""
    conformed = conformed_with_unnamed_batch(spark, sf_dir, UNNAMED_GOOD).withColumn("batch_id", F.expr(_SPARSE))
    batches = table(spark, sf_dir, "events").select(floor_div(F.col("event_id"), BATCH_ROWS).alias("batch_id")).distinct()
    named = batches.where(f"not ({UNNAMED_GOOD})").select(F.expr(_SPARSE).alias("batch_id"))
    empty = batches.where("batch_id % 5 = 0").select(F.expr(f"{_SPARSE} + 1").alias("batch_id"))
    return quality.running_load_stats(conformed, "batch_id", named.unionByName(empty))


@query("failure_phase", FAULTS + """
, drifted AS (SELECT batch_id, 'SchemaMismatch' AS code FROM src, (VALUES ('user_id'), ('value')) f(name) WHERE batch_id % 7 = 0),
  everything AS (SELECT batch_id, code FROM bad WHERE batch_id % 7 <> 0 UNION ALL SELECT batch_id, code FROM drifted)
SELECT batch_id, count(*) AS violations,
       CASE WHEN bool_and(code = 'SchemaMismatch') THEN 'batch_schema_validation' ELSE 'value_conversion' END AS phase
FROM everything GROUP BY batch_id""")
def failure_phase(spark, sf_dir):
    """Two frames of one load: in that of every seventh batch a column has another type and one is missing."""
    rows = events_with_faults(spark, sf_dir)
    drifted = rows.where("batch_id % 7 = 0").withColumn("user_id", F.col("user_id") + 0.9).drop("value")
    frames = [conform.conform_table(df, EVENTS_PLAN, KEYS) for df in (rows.where("batch_id % 7 <> 0"), drifted)]
    found = [quality.diagnostics(df, KEYS) for df in frames]
    return quality.failure_phases(found[0].unionByName(found[1]), "batch_id")


def catalogs(spark, sf_dir):
    """A planned and an actual catalog: every conversation stands for a table,
    every turn for one of its columns."""
    base = table(spark, sf_dir, "conversations")
    conv, turn = F.col("conv_id"), F.col("turn")
    kinds = F.array(F.lit("utf8"), F.lit("int64"), F.lit("binary"), F.lit("decimal"))
    kind = F.element_at(kinds, (turn % 4).cast("int") + 1)
    name = F.concat("role", F.lit("_"), turn.cast("string"))
    nullable = F.char_length("text") % 2 == 0
    decimal = F.when(kind == "decimal", F.lit(1))
    planned = base.select(
        conv.alias("table_id"), turn.alias("ordinal"), name.alias("name"), kind.alias("type"), nullable.alias("nullable"),
        (decimal * 18).alias("precision"), (decimal * 4).alias("scale"))
    seen_kind = (
        F.when((conv % 3 == 0) & (kind == "utf8"), F.lit("large_utf8"))
        .when((conv % 11 == 0) & (kind == "int64"), F.lit("int32")).otherwise(kind)
    )
    actual = base.select(
        conv.alias("table_id"), F.when(conv % 5 == 0, turn + 1).otherwise(turn).alias("ordinal"),
        F.when((conv % 7 == 0) & (turn == 1), F.upper(name)).otherwise(name).alias("name"), seen_kind.alias("type"),
        F.when(conv % 13 == 0, ~nullable).otherwise(nullable).alias("nullable"),
        F.when(conv % 17 == 0, F.lit(None).cast("int")).otherwise(decimal * 18).alias("precision"),
        F.when(conv % 19 == 0, decimal * 2).otherwise(decimal * 4).alias("scale"), turn.alias("claimed_ordinal"))
    return planned, actual


CATALOGS = """
WITH base AS (SELECT conv_id, turn, role || '_' || turn::VARCHAR AS name,
                     ['utf8', 'int64', 'binary', 'decimal'][(turn % 4)::INTEGER + 1] AS type,
                     length(text) % 2 = 0 AS nullable FROM conversations),
     p AS (SELECT conv_id AS table_id, turn AS ordinal, name, type, nullable,
                  CASE WHEN type = 'decimal' THEN 18 END AS prec, CASE WHEN type = 'decimal' THEN 4 END AS scale FROM base),
     a AS (SELECT conv_id AS table_id, CASE WHEN conv_id % 5 = 0 THEN turn + 1 ELSE turn END AS ordinal,
                  CASE WHEN conv_id % 7 = 0 AND turn = 1 THEN upper(name) ELSE name END AS name,
                  CASE WHEN conv_id % 3 = 0 AND type = 'utf8' THEN 'large_utf8'
                       WHEN conv_id % 11 = 0 AND type = 'int64' THEN 'int32' ELSE type END AS type,
                  CASE WHEN conv_id % 13 = 0 THEN NOT nullable ELSE nullable END AS nullable,
                  CASE WHEN type = 'decimal' AND conv_id % 17 <> 0 THEN 18 END AS prec,
                  CASE WHEN type = 'decimal' THEN CASE WHEN conv_id % 19 = 0 THEN 2 ELSE 4 END END AS scale,
                  turn AS claimed FROM base),
     j AS (SELECT coalesce(p.table_id, a.table_id) AS table_id, coalesce(p.ordinal, a.ordinal) AS ordinal,
                  p.name AS pn, a.name AS an, p.type AS pt, a.type AS aty, p.nullable AS pl, a.nullable AS al,
                  p.prec AS pp, a.prec AS ap, p.scale AS ps, a.scale AS aps, a.claimed,
                  p.table_id IS NOT NULL AS hp, a.table_id IS NOT NULL AS ha
           FROM p FULL JOIN a ON p.table_id = a.table_id AND p.ordinal = a.ordinal)
"""


@query("schema_drift", CATALOGS + """
SELECT table_id, ordinal, pn AS planned_name, an AS actual_name,
       CASE WHEN NOT ha THEN 'missing_column' WHEN NOT hp THEN 'extra_column' WHEN pn <> an THEN 'name'
            WHEN pt <> aty AND NOT (pt = 'utf8' AND aty = 'large_utf8') THEN 'type' WHEN pl <> al THEN 'nullability' END AS reason
FROM j WHERE reason IS NOT NULL""")
def schema_drift(spark, sf_dir):
    planned, actual = catalogs(spark, sf_dir)
    return drift.schema_drift(planned, actual)


@query("schema_drift_on_write", CATALOGS + """
SELECT table_id, ordinal, pn AS planned_name, an AS actual_name,
       CASE WHEN NOT ha THEN 'missing_column' WHEN NOT hp THEN 'extra_column' WHEN pn <> an THEN 'name'
            WHEN pt <> aty AND NOT (pt = 'utf8' AND aty = 'large_utf8') THEN 'type' END AS reason
FROM j WHERE reason IS NOT NULL""")
def schema_drift_on_write(spark, sf_dir):
    """The check made while writing: it leaves nullability to the values."""
    planned, actual = catalogs(spark, sf_dir)
    return drift.schema_drift(planned, actual, check_nullability=False)


@query("target_drift", CATALOGS + """
SELECT table_id, ordinal, 'column_count' AS difference FROM j WHERE NOT (hp AND ha)
UNION ALL SELECT table_id, ordinal, 'ordinal' FROM j WHERE hp AND ha AND claimed <> ordinal
UNION ALL SELECT table_id, ordinal, 'name' FROM j WHERE hp AND ha AND pn <> an
UNION ALL SELECT table_id, ordinal, 'nullability' FROM j WHERE hp AND ha AND pl <> al""")
def target_drift(spark, sf_dir):
    planned, actual = catalogs(spark, sf_dir)
    return drift.target_drift(planned, actual)


@query("target_type_drift", CATALOGS + """
SELECT table_id, ordinal, pt AS planned_type, aty AS actual_type, 'type' AS difference FROM j WHERE hp AND ha AND pt <> aty
UNION ALL SELECT table_id, ordinal, pt, aty, 'decimal_shape_unknown' FROM j
          WHERE hp AND ha AND pt = 'decimal' AND (ap IS NULL OR aps IS NULL)
UNION ALL SELECT table_id, ordinal, pt, aty, 'decimal_shape' FROM j
          WHERE hp AND ha AND pt = 'decimal' AND ap IS NOT NULL AND aps IS NOT NULL AND (pp <> ap OR ps <> aps)""")
def target_type_drift(spark, sf_dir):
    planned, actual = catalogs(spark, sf_dir)
    return drift.target_type_drift(planned, actual)


@query("name_audit", r"""
WITH n AS (SELECT 'documents' AS origin, doc_id AS id, text AS name FROM documents
           UNION ALL SELECT 'pages', page_id, replace(url, '?', ']') FROM pages
           UNION ALL SELECT 'part', p_partkey, CASE WHEN p_partkey % 40 = 0 THEN '' ELSE p_name END FROM part
           UNION ALL SELECT 'benchmark', item_id, text FROM benchmark),
     c AS (SELECT *, CASE WHEN name = '' THEN 'empty' WHEN regexp_matches(name, '\p{Cc}') THEN 'control_character'
                          WHEN length(name) > 128 THEN 'too_long' END AS problem FROM n)
SELECT origin, id, problem, CASE WHEN problem IS NULL THEN '[' || replace(name, ']', ']]') || ']' END AS quoted FROM c""")
def name_audit(spark, sf_dir):
    def names(name, key, column):
        return table(spark, sf_dir, name).select(
            F.lit(name).alias("origin"), F.col(key).alias("id"), column.alias("name"))

    everything = (
        names("documents", "doc_id", F.col("text"))
        .unionByName(names("pages", "page_id", F.replace(F.col("url"), F.lit("?"), F.lit("]"))))
        .unionByName(names("part", "p_partkey", F.when(F.col("p_partkey") % 40 == 0, F.lit("")).otherwise(F.col("p_name"))))
        .unionByName(names("benchmark", "item_id", F.col("text")))
    )
    return quality.name_audit(everything, "name").drop("name")
