"""Deterministic tables of 19 named shapes, computed from a row number.

Every column is an expression of the row number, so a shape can be laid over
``spark.range`` or over the key of any table, and rows are made where they are
needed: no driver data and no shuffle.

Text and bytes step through an alphabet by a fixed stride. The stride is coprime
to the alphabet's size, so the sequence repeats after one round: every value is a
stretch of one literal that repeats the round, cut at the right start.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quayload.functions.exact import quotient
from quayload.policy import SOURCE_TYPE_KEY

# Alphabets, word lists, multipliers and epochs of the shapes.
ASCII_ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789 "
UNICODE_ALPHABET = "数据写入测试éñλΩ0123 "
CATEGORIES = ["alpha", "beta", "gamma", "delta", "epsilon"]
STATUSES = ["queued", "active", "settled", "failed", "cancelled"]
REGIONS = ["us-west", "us-east", "eu-central", "ap-south"]
WORDS = ["batch", "transfer", "ledger", "route", "validated", "checkpoint"]
DOCUMENT_TYPES = ["invoice", "event", "profile", "message", "audit"]
UNICODE_DOCUMENT_TYPES = [
    "发票", "事件", "档案", "消息", "审计",
]
UNICODE_TENANT, UNICODE_TITLE, UNICODE_SOURCE = "租户", "文档", "来源"
RETURN_FLAGS = ["A", "N", "R"]
LINE_STATUSES = ["F", "O"]
SHIP_INSTRUCTIONS = ["DELIVER IN PERSON", "COLLECT COD", "NONE", "TAKE BACK RETURN"]
SHIP_MODES = ["AIR", "FOB", "MAIL", "RAIL", "REG AIR", "SHIP", "TRUCK"]
MIX_FACTOR, MIX_OFFSET, MIX_RANGE = 1_103_515_245, 12_345, 1_000_000
SECOND_FACTOR = 2_654_435_761
FIRST_TRADE_DAY = 19_723
FIRST_MILLISECOND = 1_735_689_600_000
UINT64_MAX = 18_446_744_073_709_551_615
INT64_MAX = 9_223_372_036_854_775_807


def generate(spark: SparkSession, shape: str, rows: int) -> DataFrame:
    """``rows`` rows of a shape."""
    return shaped(spark.range(rows), "id", shape)


def shaped(df: DataFrame, row: str, shape: str, keep: list[str] | None = None) -> DataFrame:
    """A shape over the row numbers (0 and up) of a column of ``df``."""
    columns = SHAPES[shape](F.col(row).cast("bigint"))
    return df.select(*(keep or []), *columns)


def mixed_int(row: Column) -> Column:
    """(row x factor + offset) in 64 unsigned bits, modulo one million."""
    plain = (row * MIX_FACTOR + MIX_OFFSET) % MIX_RANGE
    # Beyond this row number the product no longer fits a long: wrap exactly.
    wide = (
        row.cast("decimal(20,0)") * F.lit(MIX_FACTOR).cast("decimal(10,0)") + F.lit(MIX_OFFSET)
    ) % F.lit(str(UINT64_MAX + 1)).cast("decimal(20,0)")
    wrapped = (wide % F.lit(MIX_RANGE)).cast("bigint")
    return F.when(row < 8_000_000_000, plain).otherwise(wrapped).cast("int")


def score(row: Column) -> Column:
    return ((row * 37 + 17) % 100_000).cast("double") / 100.0


def low_32_bits(row: Column, factor: int) -> Column:
    """row x factor modulo 2^32, by halves of the factor so that nothing overflows."""
    modulus = 1 << 32
    base = row % modulus
    high, low = factor >> 16, factor & 0xFFFF
    upper = ((base * high) % (1 << 16)) * (1 << 16)
    return (upper + base * low) % modulus


def stepped_text(row: Column, length: Column, longest: int, alphabet: str = ASCII_ALPHABET) -> Column:
    """Character i is ``alphabet[(31 row + 7 i) mod size]``, for lengths up to ``longest``."""
    size = len(alphabet)
    start = (row * 31 % size) * pow(7, -1, size) % size + 1
    text = "".join(alphabet[(7 * i) % size] for i in range(size + longest))
    if text.isascii():
        # One byte per character: a stretch of bytes, no search for characters.
        return F.substring(F.lit(text.encode()), start.cast("int"), length.cast("int")).cast("string")
    return F.substring(F.lit(text), start.cast("int"), length.cast("int"))


def stepped_bytes(row: Column, length: Column, longest: int, row_step: int, index_step: int) -> Column:
    """Byte i is ``(row_step row + index_step i) mod 251``, for lengths up to ``longest``."""
    size = 251
    start = (row * row_step % size) * pow(index_step, -1, size) % size + 1
    content = bytes((index_step * i) % size for i in range(size + longest))
    return F.substring(F.lit(content), start.cast("int"), length.cast("int"))


def pick(row: Column, values: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (row % len(values)).cast("int") + 1)


def unless_multiple(row: Column, divisor: int, value: Column) -> Column:
    """``value``, but NULL on every multiple of ``divisor``."""
    return F.when(row % divisor != 0, value)


def date_of(day: Column) -> Column:
    return F.date_from_unix_date(day.cast("int"))


def instant_of_millis(millis: Column) -> Column:
    """Timestamp without zone, whatever the session's zone is."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    zero = F.lit(0)
    return epoch + F.make_dt_interval(zero, zero, zero, (millis.cast("decimal(20,0)") / 1000).cast("decimal(18,6)"))


def scaled(unscaled: Column, precision: int, scale: int) -> Column:
    unit = F.lit("0." + "0" * (scale - 1) + "1").cast(f"decimal({scale},{scale})")
    return (unscaled.cast("decimal(12,0)") * unit).cast(f"decimal({precision},{scale})")


def source(column: Column, name: str, kind: str) -> Column:
    """Column whose source type Spark has no type for; metadata carries it."""
    return column.alias(name, metadata={SOURCE_TYPE_KEY: kind})


def padded(number: Column, width: int) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def narrow_numeric(r: Column) -> list[Column]:
    return [
        mixed_int(r).alias("id32"),
        (mixed_int(r).cast("bigint") * 1_000).alias("id64"),
        score(r).alias("score"),
    ]


def extended_primitive(r: Column) -> list[Column]:
    u8 = (r % 256).cast("smallint")
    i8 = (r % 256 - 128).cast("tinyint")
    i16 = (r % 65_536 - 32_768).cast("smallint")
    u16 = (r % 65_536).cast("int")
    f32 = (r % 10_000 - 5_000).cast("float")
    return [
        source(u8, "u8_value", "uint8"),
        source(unless_multiple(r, 7, u8), "maybe_u8", "uint8"),
        i8.alias("i8_value"),
        unless_multiple(r, 11, i8).alias("maybe_i8"),
        i16.alias("i16_value"),
        unless_multiple(r, 13, i16).alias("maybe_i16"),
        source(u16, "u16_value", "uint16"),
        source(unless_multiple(r, 17, u16), "maybe_u16", "uint16"),
        source(low_32_bits(r, MIX_FACTOR), "u32_value", "uint32"),
        source(unless_multiple(r, 19, low_32_bits(r, SECOND_FACTOR)), "maybe_u32", "uint32"),
        (f32 / 8).cast("float").alias("f32_value"),
        unless_multiple(r, 23, (f32 / 16).cast("float")).alias("maybe_f32"),
    ]


def uint64_policy(r: Column) -> list[Column]:
    step = (r % 1_000_000).cast("decimal(20,0)")
    full = (F.lit(str(UINT64_MAX)).cast("decimal(20,0)") - step).cast("decimal(20,0)")
    mid = (F.lit(INT64_MAX).cast("decimal(20,0)") - step).cast("decimal(20,0)")
    return [
        mixed_int(r).alias("row_id"),
        source((r % 1_000_000_000).cast("decimal(20,0)"), "u64_small", "uint64"),
        source(mid, "u64_mid", "uint64"),
        source(full, "u64_full", "uint64"),
        source(unless_multiple(r, 13, full), "maybe_u64_full", "uint64"),
    ]


def date_fast_path(r: Column) -> list[Column]:
    columns = [mixed_int(r).alias("row_id")]
    for g in range(8):
        columns += [
            date_of(FIRST_TRADE_DAY + (r + g * 17) % 365).alias(f"trade_date_{g}"),
            unless_multiple(r, 11 + g, date_of(FIRST_TRADE_DAY + (r + g * 19) % 365)).alias(f"maybe_trade_date_{g}"),
            source(FIRST_MILLISECOND + (r + g) * 3_701, f"posted_at_{g}", "date64"),
            source(unless_multiple(r, 13 + g, FIRST_MILLISECOND + (r + g * 3) * 9_001), f"maybe_posted_at_{g}", "date64"),
        ]
    return columns


def mixed_nullable(r: Column) -> list[Column]:
    return [
        mixed_int(r).alias("id32"),
        unless_multiple(r, 7, mixed_int(r).cast("bigint") * 10).alias("maybe_id64"),
        unless_multiple(r, 11, score(r)).alias("maybe_score"),
        unless_multiple(r, 5, pick(r, CATEGORIES)).alias("category"),
    ]


def wide_mixed(r: Column) -> list[Column]:
    words = F.transform(
        F.sequence(F.lit(0).cast("bigint"), r % 7),
        lambda i: F.element_at(F.array(*[F.lit(w) for w in WORDS]), ((r + i) % len(WORDS)).cast("int") + 1),
    )
    description = F.concat(F.lit("event-"), padded(r, 12), F.lit("-"), F.array_join(words, "-"))
    return [
        (10_000_000 + r).alias("id"),
        (1_000 + r % 50_000).cast("int").alias("account_id"),
        instant_of_millis(FIRST_MILLISECOND + r * 1_000).alias("event_time_ms"),
        unless_multiple(r, 17, ((r % 1_000_000).cast("double") + 25.0) / 100.0).alias("amount"),
        unless_multiple(r, 19, pick(r, STATUSES)).alias("status"),
        unless_multiple(r, 23, pick(quotient(r, 3), REGIONS)).alias("region"),
        unless_multiple(r, 29, description).alias("description"),
        unless_multiple(r, 31, stepped_bytes(r, 8 + r % 57, 64, 31, 17)).alias("payload"),
    ]


def fixed_size_binary(r: Column) -> list[Column]:
    def payload(length: int) -> Column:
        return stepped_bytes(r, F.lit(length), length, 37, 19)

    return [
        r.alias("row_id"),
        source(payload(16), "hash16", "fixed_binary(16)"),
        source(unless_multiple(r, 7, payload(4)), "nullable_code4", "fixed_binary(4)"),
        source(payload(64), "payload64", "fixed_binary(64)"),
    ]


def decimal_temporal(r: Column) -> list[Column]:
    sign = F.when(r % 13 == 0, F.lit(-1)).otherwise(F.lit(1))
    return [
        (500_000_000 + r).alias("transaction_id"),
        (10_000 + r % 200_000).cast("int").alias("account_id"),
        scaled(sign * (1_000_000 + r % 50_000_000), 18, 4).alias("amount"),
        unless_multiple(r, 11, scaled(25 + r % 10_000, 12, 4)).alias("fee"),
        date_of(FIRST_TRADE_DAY + r % 365).alias("trade_date"),
        instant_of_millis(FIRST_MILLISECOND + r * 17_000).alias("posted_at_ms"),
        unless_multiple(r, 17, r % 3 != 0).alias("approved"),
    ]


def fixed_width_128(r: Column) -> list[Column]:
    columns = []
    for g in range(16):
        columns += [
            mixed_int(r + g * 101).alias(f"i32_value_{g:02}"),
            unless_multiple(r, 11 + g, mixed_int(r + g * 103)).alias(f"maybe_i32_{g:02}"),
            (mixed_int(r + g * 107).cast("bigint") * 10_000).alias(f"i64_value_{g:02}"),
            unless_multiple(r, 13 + g, mixed_int(r + g * 109).cast("bigint") * 100_000).alias(f"maybe_i64_{g:02}"),
            score(r + g * 113).alias(f"f64_value_{g:02}"),
            unless_multiple(r, 17 + g, score(r + g * 127)).alias(f"maybe_f64_{g:02}"),
            ((r + g) % 2 == 0).alias(f"flag_{g:02}"),
            unless_multiple(r, 19 + g, (r + g) % 3 == 0).alias(f"maybe_flag_{g:02}"),
        ]
    return columns


def decimal_temporal_128(r: Column) -> list[Column]:
    columns = []
    for g in range(16):
        sign = F.when((r + g) % 13 == 0, F.lit(-1)).otherwise(F.lit(1))
        columns += [
            scaled(sign * (1_000_000 + (r + g * 997) % 50_000_000), 18, 4).alias(f"amount_{g:02}"),
            unless_multiple(r, 11 + g, scaled(25 + (r + g * 53) % 10_000, 12, 4)).alias(f"maybe_fee_{g:02}"),
            date_of(FIRST_TRADE_DAY + (r + g * 17) % 365).alias(f"trade_date_{g:02}"),
            unless_multiple(r, 13 + g, date_of(FIRST_TRADE_DAY + (r + g * 19) % 365)).alias(f"maybe_trade_date_{g:02}"),
            instant_of_millis(FIRST_MILLISECOND + (r + g * 31) * 17_000).alias(f"posted_at_ms_{g:02}"),
            source(((r * 37 + g * 1_003) % 86_400_000).cast("int"), f"settlement_time_ms_{g:02}", "time(ms)"),
            source((r * 41 + g * 1_009) % 86_400_000_000, f"capture_time_us_{g:02}", "time(us)"),
            unless_multiple(r, 17 + g, (r + g) % 3 == 0).alias(f"maybe_approved_{g:02}"),
        ]
    return columns


def string_heavy(body: tuple[int, int], payload: tuple[int, int],
                 unicode: bool = False) -> Callable[[Column], list[Column]]:
    """The text and binary shapes differ only in alphabet and lengths.

    A length (shortest, spread) is ``shortest + row mod spread``.
    """
    longest_body, longest_payload = sum(body) - 1, sum(payload) - 1

    def columns(r: Column) -> list[Column]:
        number = padded(r % 512, 4)
        if unicode:
            tenant = F.concat(F.lit(UNICODE_TENANT + "-"), number)
            kind, alphabet = UNICODE_DOCUMENT_TYPES, UNICODE_ALPHABET
            title = F.concat(F.lit(UNICODE_TITLE + " title "), padded(r, 12))
            metadata = F.format_string(
                '{"tenant":"%s","source":"' + UNICODE_SOURCE + '-%d","sequence":%d}', tenant, r % 17, r
            )
        else:
            tenant = F.concat(F.lit("tenant-"), number)
            kind, alphabet = DOCUMENT_TYPES, ASCII_ALPHABET
            title = F.concat(F.lit("document title "), padded(r, 12))
            metadata = F.format_string('{"tenant":%d,"source":%d,"sequence":%d}', r % 512, r % 17, r)
        return [
            (900_000_000 + r).alias("id"),
            tenant.alias("tenant"),
            unless_multiple(r, 37, pick(r, kind)).alias("document_type"),
            unless_multiple(r, 41, title).alias("title"),
            unless_multiple(r, 43, stepped_text(r, body[0] + r % body[1], longest_body, alphabet)).alias("body"),
            unless_multiple(r, 47, metadata).alias("metadata"),
            unless_multiple(r, 53, stepped_bytes(r, payload[0] + r % payload[1], longest_payload, 131, 29)).alias("payload"),
        ]

    return columns


def wide_sparse(r: Column) -> list[Column]:
    integers = [(r * (c + 3) % 1_000_000).cast("int") for c in range(8)]
    return [
        *[(v if c == 0 else unless_multiple(r, c + 11, v)).alias(f"metric_i32_{c:02}") for c, v in enumerate(integers)],
        *[unless_multiple(r, c + 13, (r * (c + 19) % 10_000).cast("double") / 10.0).alias(f"metric_f64_{c:02}") for c in range(8)],
        *[unless_multiple(r, c + 17, F.concat(F.lit(f"tag-{c:02}-"), (r % 128).cast("string"))).alias(f"tag_{c:02}") for c in range(8)],
        *[unless_multiple(r, c + 23, (r + c) % 2 == 0).alias(f"flag_{c:02}") for c in range(8)],
    ]


def tpch_lineitem_like(r: Column) -> list[Column]:
    return [
        (1 + quotient(r, 4)).alias("l_orderkey"),
        (1 + r % 200_000).alias("l_partkey"),
        (1 + r % 10_000).alias("l_suppkey"),
        (1 + r % 7).cast("int").alias("l_linenumber"),
        scaled(100 + r % 5_000, 15, 2).alias("l_quantity"),
        scaled(10_000 + r % 900_000, 18, 2).alias("l_extendedprice"),
        scaled(r % 1_000, 10, 4).alias("l_discount"),
        scaled(r % 800, 10, 4).alias("l_tax"),
        pick(r, RETURN_FLAGS).alias("l_returnflag"),
        pick(quotient(r, 5), LINE_STATUSES).alias("l_linestatus"),
        date_of(8_400 + r % 2_500).alias("l_shipdate"),
        date_of(8_430 + r % 2_500).alias("l_commitdate"),
        date_of(8_460 + r % 2_500).alias("l_receiptdate"),
        pick(r, SHIP_INSTRUCTIONS).alias("l_shipinstruct"),
        pick(r, SHIP_MODES).alias("l_shipmode"),
        unless_multiple(r, 101, stepped_text(r, 24 + r % 96, 119)).alias("l_comment"),
    ]


SHAPES: dict[str, Callable[[Column], list[Column]]] = {
    "narrow_numeric": narrow_numeric,
    "extended_primitive": extended_primitive,
    "uint64_policy": uint64_policy,
    "date_fast_path": date_fast_path,
    "mixed_nullable": mixed_nullable,
    "fixed_size_binary": fixed_size_binary,
    "wide_mixed": wide_mixed,
    "decimal_temporal": decimal_temporal,
    "fixed_width_128": fixed_width_128,
    "decimal_temporal_128": decimal_temporal_128,
    "string_heavy": string_heavy((512, 2_048), (1_024, 4_096)),
    "string_heavy_text_only": string_heavy((512, 2_048), (8, 32)),
    "string_heavy_binary_only": string_heavy((24, 96), (1_024, 4_096)),
    "string_heavy_inline_4k": string_heavy((1_024, 1), (2_048, 1)),
    "string_heavy_edge_7k": string_heavy((1_536, 1), (4_096, 1)),
    "string_heavy_lob_9k": string_heavy((2_048, 1), (5_120, 1)),
    "string_heavy_unicode": string_heavy((512, 2_048), (1_024, 4_096), unicode=True),
    "wide_sparse": wide_sparse,
    "tpch_lineitem_like": tpch_lineitem_like,
}
