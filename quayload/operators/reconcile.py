"""What arrived against what was sent."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T


def count_reconcile(sent_rows: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Rows written against rows found, per load; either side may be missing.

    Both sides are counted in one aggregate, so rows without a load are a load like any other.
    """
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    sent = sent_rows.select(key, one.alias("rows_written"), none.alias("rows_found"))
    seen = found.select(key, none.alias("rows_written"), one.alias("rows_found"))
    counts = sent.unionByName(seen).groupBy(key).agg(F.sum("rows_written").alias("rows_written"), F.sum("rows_found").alias("rows_found"))
    return counts.withColumn("matches", F.col("rows_written") == F.col("rows_found"))


def require_reconciled(written: int, found: int, target: str) -> None:
    """A count that differs is an error, not a warning."""
    if written != found:
        raise RuntimeError(f"{target}: wrote {written} rows, found {found}")


def sentinel_count(df: DataFrame, column: str, first: int, second: int) -> DataFrame:
    """Rows whose first two characters are the given code points, against all rows."""
    text = F.col(column)
    hit = (F.ascii(F.substring(text, 1, 1)) == first) & (F.ascii(F.substring(text, 2, 1)) == second)
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(hit).alias("sentinel_rows"),
    ).withColumn("all_rows_match", F.col("row_count") == F.col("sentinel_rows"))


# ---- multiset checksums -------------------------------------------------------------------------

#: Leaves of a checksum tree, and children of its nodes: levels of 1, 64 and 4096 nodes.
LEAVES, CHILDREN = 4096, 64
_SUMS = ("rows", "low_1", "high_1", "low_2", "high_2")
_SEED = 0x5EED


def _hashable(field: T.StructField) -> list[Column]:
    """What tells values apart as a grouping does; NULL is a value of its own."""
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        value = F.when(column == 0, F.lit(0.0).cast(field.dataType)).otherwise(column)
    elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        # The hash leaves out NULLs inside nested values.
        value = F.to_json(F.struct(column), {"ignoreNullFields": "false"})
    else:
        value = column
    return [value, column.isNull()]


def _hashes(df: DataFrame, columns: list[str]) -> tuple[Column, Column]:
    """Two independent 64-bit hashes of a row."""
    values = [part for name in columns for part in _hashable(df.schema[name])]
    return F.xxhash64(*values), F.xxhash64(F.lit(_SEED), *values, F.lit(_SEED))


def _leaf(row_hash: Column, leaves: int) -> Column:
    return F.pmod(row_hash, F.lit(leaves)).cast("int")


def checksum_leaves(df: DataFrame, columns: list[str] | None = None, leaves: int = LEAVES) -> DataFrame:
    """Per leaf the rows and the sums of two row hashes, each in halves that cannot overflow below 2^31 rows.

    A task sends at most one narrow row for each leaf, whatever the width of the table.
    """
    first, second = _hashes(df, columns or df.columns)
    hashed = df.select(first.alias("h1"), second.alias("h2")).withColumn("node", _leaf(F.col("h1"), leaves))
    low = F.lit((1 << 32) - 1)
    halves = {
        "low_1": F.col("h1").bitwiseAND(low), "high_1": F.shiftright("h1", 32),
        "low_2": F.col("h2").bitwiseAND(low), "high_2": F.shiftright("h2", 32),
    }
    return hashed.groupBy("node").agg(F.count(F.lit(1)).alias("rows"), *(F.sum(v).alias(n) for n, v in halves.items()))


def checksum_tree(leaf_sums: DataFrame, leaves: int = LEAVES, children: int = CHILDREN) -> DataFrame:
    """(level, node, rows, sums) from the root, level 0, to the leaves; small enough to be stored beside a load."""
    levels, size = [leaf_sums], leaves
    while size > 1:
        size = -(-size // children)
        up = levels[0].withColumn("node", F.expr(f"node div {children}").cast("int"))
        levels.insert(0, up.groupBy("node").agg(*(F.sum(c).alias(c) for c in _SUMS)))
    out = None
    for level, nodes in enumerate(levels):
        rows = nodes.select(F.lit(level).alias("level"), "node", *_SUMS)
        out = rows if out is None else out.unionByName(rows)
    return out


def tree_differences(left: DataFrame, right: DataFrame, leaves: int = LEAVES, children: int = CHILDREN) -> DataFrame:
    """Leaves (column ``node``) that differ between two trees, found from the root down."""
    depth, size = 0, leaves
    while size > 1:
        depth, size = depth + 1, -(-size // children)
    pairs = left.select("level", "node", F.struct(*_SUMS).alias("l")).join(
        right.select("level", "node", F.struct(*_SUMS).alias("r")), ["level", "node"], "full_outer")
    differ = pairs.where(~F.col("l").eqNullSafe(F.col("r"))).select("level", "node")
    found = differ.where("level = 0").select("node")
    for level in range(1, depth + 1):
        above = found.select(F.col("node").alias("__above"))
        here = differ.where(F.col("level") == level)
        found = here.join(above, F.expr(f"node div {children}") == F.col("__above"), "left_semi").select("node")
    return found


def _leaves_that_differ(left: DataFrame, right: DataFrame, leaves: int) -> list[int]:
    """Leaves whose sums differ, at most one number for each: one aggregate over both tables, one narrow shuffle."""
    signed = None
    for df, sign in ((left, 1), (right, -1)):
        part = checksum_leaves(df, df.columns, leaves).select("node", *((F.col(c) * sign).alias(c) for c in _SUMS))
        signed = part if signed is None else signed.unionByName(part)
    balance = signed.groupBy("node").agg(*(F.sum(c).alias(c) for c in _SUMS))
    return [row["node"] for row in balance.where(" or ".join(f"{c} <> 0" for c in _SUMS)).select("node").collect()]


def roundtrip_diff(source: DataFrame, target: DataFrame, exact: bool = False, leaves: int = LEAVES) -> DataFrame:
    """Rows with different multiplicity, with ``missing`` and ``unexpected`` copies.

    Both tables are summed up in multiset checksums first; where these agree, nothing but
    narrow sums is shuffled. Rows of the leaves that differ, and only those, are counted in
    one aggregate over all columns, which combines on the map side: many copies of one row
    cost one row per task. ``exact`` compares all rows and trusts no checksum.
    """
    columns = source.columns
    sides = [(source.select(*columns), 1), (target.select(*columns), -1)]
    if not exact:
        wrong = _leaves_that_differ(sides[0][0], sides[1][0], leaves)
        if len(wrong) < leaves:
            # Parsed as one text: thousands of literals made one by one take seconds.
            among = f"__leaf IN ({', '.join(map(str, wrong)) or 'NULL'})"
            sides = [(df.withColumn("__leaf", _leaf(_hashes(df, columns)[0], leaves)).where(among).drop("__leaf"), sign) for df, sign in sides]
    left, right = (df.withColumn("__sign", F.lit(sign)) for df, sign in sides)
    balance = left.unionByName(right).groupBy(*columns).agg(F.sum("__sign").alias("__balance"))
    return balance.where("__balance <> 0").select(
        *columns,
        F.greatest(F.col("__balance"), F.lit(0)).alias("missing"),
        F.greatest(-F.col("__balance"), F.lit(0)).alias("unexpected"),
    )


def writer_parity(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Per key and column where two loads disagree; NULL equals NULL, also in the keys."""
    columns = [c for c in left.columns if c not in keys]
    a = left.select(*[F.col(k).alias(f"__l_{k}") for k in keys], F.struct(*columns).alias("l"))
    b = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys], F.struct(*columns).alias("r"))
    differing = F.array_compact(F.array(*[
        F.when(~F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")), F.lit(c)) for c in columns
    ]))
    state = (
        F.when(F.col("l").isNull(), F.lit("only_right"))
        .when(F.col("r").isNull(), F.lit("only_left"))
        .otherwise(F.lit("differs"))
    )
    fields = F.when(F.col("l").isNotNull() & F.col("r").isNotNull(), differing).otherwise(F.array(F.lit("*")))
    joined = a.join(b, reduce(Column.__and__, [F.col(f"__l_{k}").eqNullSafe(F.col(f"__r_{k}")) for k in keys]), "full_outer")
    found = [F.when(F.col("l").isNull(), F.col(f"__r_{k}")).otherwise(F.col(f"__l_{k}")).alias(k) for k in keys]
    return joined.select(*found, state.alias("state"), F.explode(fields).alias("field_name"))


def expected_vs_actual(actual: DataFrame, expected: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Rows whose conformed values differ from an independent expectation."""
    joined = actual.select(key, *[F.col(c).alias(f"actual_{c}") for c in columns]).join(
        expected.select(key, *[F.col(c).alias(f"expected_{c}") for c in columns]), key
    )
    same = reduce(Column.__and__, [F.col(f"actual_{c}").eqNullSafe(F.col(f"expected_{c}")) for c in columns])
    return joined.where(~same)
