"""The 19 generated shapes, laid over the row numbers of ``events``.

The SQL builds text and bytes one element at a time, which states the rule
directly; the Spark side cuts them from a repeated round.
"""

from __future__ import annotations

from quayload.plans.registry import query, table
from quayload.sources import shapes

R = "event_id"


def _mixed(r: str) -> str:
    return f"((({r})::HUGEINT * 1103515245 + 12345) % 1000000)::INTEGER"


def _score(r: str) -> str:
    return f"((({r}) * 37 + 17) % 100000)::DOUBLE / 100.0::DOUBLE"


def _unless(n: int, value: str) -> str:
    return f"CASE WHEN {R} % {n} <> 0 THEN {value} END"


def _pick(r: str, values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + f"][(({r}) % {len(values)})::INTEGER + 1]"


def _day(days: str) -> str:
    return f"DATE '1970-01-01' + ({days})::INTEGER"


def _moment(millis: str) -> str:
    return f"make_timestamp(({millis}) * 1000)"


def _decimal(unscaled: str, p: int, s: int) -> str:
    return f"CAST(CAST({unscaled} AS DECIMAL(18,0)) * 0.{'0' * (s - 1)}1 AS DECIMAL({p},{s}))"


def _text(r: str, n: str, alphabet: str) -> str:
    return (f"list_aggregate(list_transform(range({n}), lambda i: '{alphabet}'[(({r} * 31 + i * 7) % {len(alphabet)})::INTEGER + 1]), "
            f"'string_agg', '')")


def _bytes(r: str, n: str, a: int, b: int) -> str:
    return (f"unhex(coalesce(list_aggregate(list_transform(range({n}), lambda i: printf('%02X', ({r} * {a} + i * {b}) % 251)), "
            f"'string_agg', ''), ''))")


def _select(columns: list[tuple[str, str]]) -> str:
    return "SELECT event_id, " + ", ".join(f"{sql} AS {name}" for name, sql in columns) + " FROM events"


def _text_shape(body: str, payload: str, unicode: bool = False) -> str:
    number = f"lpad(({R} % 512)::VARCHAR, 4, '0')"
    padded = f"lpad({R}::VARCHAR, 12, '0')"
    if unicode:
        tenant, alphabet, kinds = f"'{shapes.UNICODE_TENANT}-' || {number}", shapes.UNICODE_ALPHABET, shapes.UNICODE_DOCUMENT_TYPES
        title = f"'{shapes.UNICODE_TITLE} title ' || {padded}"
        metadata = ("'{\"tenant\":\"' || " + tenant + " || '\",\"source\":\"" + shapes.UNICODE_SOURCE + "-' || "
                    f"({R} % 17)::VARCHAR || '\",\"sequence\":' || {R}::VARCHAR || '}}'")
    else:
        tenant, alphabet, kinds = f"'tenant-' || {number}", shapes.ASCII_ALPHABET, shapes.DOCUMENT_TYPES
        title = f"'document title ' || {padded}"
        metadata = ("'{\"tenant\":' || " + f"({R} % 512)::VARCHAR || ',\"source\":' || ({R} % 17)::VARCHAR || "
                    f"',\"sequence\":' || {R}::VARCHAR || '}}'")
    return _select([
        ("id", f"900000000 + {R}"), ("tenant", tenant), ("document_type", _unless(37, _pick(R, kinds))),
        ("title", _unless(41, title)), ("body", _unless(43, _text(R, body, alphabet))),
        ("metadata", _unless(47, metadata)), ("payload", _unless(53, _bytes(R, payload, 131, 29))),
    ])


_U64 = "18446744073709551615::HUGEINT"
_SIGN = "CASE WHEN ({r}) % 13 = 0 THEN -1 ELSE 1 END"
_I8 = f"({R} % 256 - 128)::TINYINT"
_I16 = f"({R} % 65536 - 32768)::SMALLINT"
_F32 = f"({R} % 10000 - 5000)::FLOAT"
_WORDS = "[" + ", ".join(f"'{w}'" for w in shapes.WORDS) + "]"
_DESCRIPTION = (f"'event-' || lpad({R}::VARCHAR, 12, '0') || '-' || list_aggregate(list_transform(range(1 + {R} % 7), "
                f"lambda i: {_WORDS}[(({R} + i) % 6)::INTEGER + 1]), 'string_agg', '-')")

ORACLES = {
    "narrow_numeric": _select([("id32", _mixed(R)), ("id64", f"{_mixed(R)}::BIGINT * 1000"), ("score", _score(R))]),
    "extended_primitive": _select([
        ("u8_value", f"({R} % 256)::SMALLINT"), ("maybe_u8", _unless(7, f"({R} % 256)::SMALLINT")),
        ("i8_value", _I8), ("maybe_i8", _unless(11, _I8)), ("i16_value", _I16), ("maybe_i16", _unless(13, _I16)),
        ("u16_value", f"({R} % 65536)::INTEGER"), ("maybe_u16", _unless(17, f"({R} % 65536)::INTEGER")),
        ("u32_value", f"({R}::HUGEINT * 1103515245 % 4294967296)::BIGINT"),
        ("maybe_u32", _unless(19, f"({R}::HUGEINT * 2654435761 % 4294967296)::BIGINT")),
        ("f32_value", f"({_F32} / 8)::FLOAT"), ("maybe_f32", _unless(23, f"({_F32} / 16)::FLOAT")),
    ]),
    "uint64_policy": _select([
        ("row_id", _mixed(R)), ("u64_small", f"CAST({R} % 1000000000 AS DECIMAL(20,0))"),
        ("u64_mid", f"CAST(9223372036854775807::HUGEINT - {R} % 1000000 AS DECIMAL(20,0))"),
        ("u64_full", f"CAST({_U64} - {R} % 1000000 AS DECIMAL(20,0))"),
        ("maybe_u64_full", _unless(13, f"CAST({_U64} - {R} % 1000000 AS DECIMAL(20,0))")),
    ]),
    "date_fast_path": _select([("row_id", _mixed(R))] + [
        column for g in range(8) for column in (
            (f"trade_date_{g}", _day(f"19723 + ({R} + {g * 17}) % 365")),
            (f"maybe_trade_date_{g}", _unless(11 + g, _day(f"19723 + ({R} + {g * 19}) % 365"))),
            (f"posted_at_{g}", f"1735689600000 + ({R} + {g}) * 3701"),
            (f"maybe_posted_at_{g}", _unless(13 + g, f"1735689600000 + ({R} + {g * 3}) * 9001")))]),
    "mixed_nullable": _select([
        ("id32", _mixed(R)), ("maybe_id64", _unless(7, f"{_mixed(R)}::BIGINT * 10")), ("maybe_score", _unless(11, _score(R))),
        ("category", _unless(5, _pick(R, shapes.CATEGORIES)))]),
    "fixed_size_binary": _select([
        ("row_id", R), ("hash16", _bytes(R, "16", 37, 19)), ("nullable_code4", _unless(7, _bytes(R, "4", 37, 19))),
        ("payload64", _bytes(R, "64", 37, 19))]),
    "wide_mixed": _select([
        ("id", f"10000000 + {R}"), ("account_id", f"(1000 + {R} % 50000)::INTEGER"),
        ("event_time_ms", _moment(f"1735689600000 + {R} * 1000")),
        ("amount", _unless(17, f"(({R} % 1000000)::DOUBLE + 25.0::DOUBLE) / 100.0::DOUBLE")),
        ("status", _unless(19, _pick(R, shapes.STATUSES))), ("region", _unless(23, _pick(f"{R} // 3", shapes.REGIONS))),
        ("description", _unless(29, _DESCRIPTION)), ("payload", _unless(31, _bytes(R, f"8 + {R} % 57", 31, 17)))]),
    "decimal_temporal": _select([
        ("transaction_id", f"500000000 + {R}"), ("account_id", f"(10000 + {R} % 200000)::INTEGER"),
        ("amount", _decimal(f"({_SIGN.format(r=R)}) * (1000000 + {R} % 50000000)", 18, 4)),
        ("fee", _unless(11, _decimal(f"(25 + {R} % 10000)", 12, 4))), ("trade_date", _day(f"19723 + {R} % 365")),
        ("posted_at_ms", _moment(f"1735689600000 + {R} * 17000")), ("approved", _unless(17, f"{R} % 3 <> 0"))]),
    "fixed_width_128": _select([
        column for g in range(16) for column in (
            (f"i32_value_{g:02}", _mixed(f"{R} + {g * 101}")), (f"maybe_i32_{g:02}", _unless(11 + g, _mixed(f"{R} + {g * 103}"))),
            (f"i64_value_{g:02}", f"{_mixed(f'{R} + {g * 107}')}::BIGINT * 10000"),
            (f"maybe_i64_{g:02}", _unless(13 + g, f"{_mixed(f'{R} + {g * 109}')}::BIGINT * 100000")),
            (f"f64_value_{g:02}", _score(f"{R} + {g * 113}")), (f"maybe_f64_{g:02}", _unless(17 + g, _score(f"{R} + {g * 127}"))),
            (f"flag_{g:02}", f"({R} + {g}) % 2 = 0"), (f"maybe_flag_{g:02}", _unless(19 + g, f"({R} + {g}) % 3 = 0")))]),
    "decimal_temporal_128": _select([
        column for g in range(16) for column in (
            (f"amount_{g:02}", _decimal(f"({_SIGN.format(r=f'{R} + {g}')}) * (1000000 + ({R} + {g * 997}) % 50000000)", 18, 4)),
            (f"maybe_fee_{g:02}", _unless(11 + g, _decimal(f"(25 + ({R} + {g * 53}) % 10000)", 12, 4))),
            (f"trade_date_{g:02}", _day(f"19723 + ({R} + {g * 17}) % 365")),
            (f"maybe_trade_date_{g:02}", _unless(13 + g, _day(f"19723 + ({R} + {g * 19}) % 365"))),
            (f"posted_at_ms_{g:02}", _moment(f"1735689600000 + ({R} + {g * 31}) * 17000")),
            (f"settlement_time_ms_{g:02}", f"(({R} * 37 + {g * 1003}) % 86400000)::INTEGER"),
            (f"capture_time_us_{g:02}", f"({R} * 41 + {g * 1009}) % 86400000000"),
            (f"maybe_approved_{g:02}", _unless(17 + g, f"({R} + {g}) % 3 = 0")))]),
    "string_heavy": _text_shape(f"512 + {R} % 2048", f"1024 + {R} % 4096"),
    "string_heavy_text_only": _text_shape(f"512 + {R} % 2048", f"8 + {R} % 32"),
    "string_heavy_binary_only": _text_shape(f"24 + {R} % 96", f"1024 + {R} % 4096"),
    "string_heavy_inline_4k": _text_shape("1024", "2048"),
    "string_heavy_edge_7k": _text_shape("1536", "4096"),
    "string_heavy_lob_9k": _text_shape("2048", "5120"),
    "string_heavy_unicode": _text_shape(f"512 + {R} % 2048", f"1024 + {R} % 4096", unicode=True),
    "wide_sparse": _select(
        [(f"metric_i32_{c:02}", (f"({R} * {c + 3} % 1000000)::INTEGER" if c == 0
                                 else _unless(c + 11, f"({R} * {c + 3} % 1000000)::INTEGER"))) for c in range(8)]
        + [(f"metric_f64_{c:02}", _unless(c + 13, f"({R} * {c + 19} % 10000)::DOUBLE / 10.0::DOUBLE")) for c in range(8)]
        + [(f"tag_{c:02}", _unless(c + 17, f"'tag-{c:02}-' || ({R} % 128)::VARCHAR")) for c in range(8)]
        + [(f"flag_{c:02}", _unless(c + 23, f"({R} + {c}) % 2 = 0")) for c in range(8)]),
    "tpch_lineitem_like": _select([
        ("l_orderkey", f"1 + {R} // 4"), ("l_partkey", f"1 + {R} % 200000"), ("l_suppkey", f"1 + {R} % 10000"),
        ("l_linenumber", f"(1 + {R} % 7)::INTEGER"), ("l_quantity", _decimal(f"(100 + {R} % 5000)", 15, 2)),
        ("l_extendedprice", _decimal(f"(10000 + {R} % 900000)", 18, 2)), ("l_discount", _decimal(f"({R} % 1000)", 10, 4)),
        ("l_tax", _decimal(f"({R} % 800)", 10, 4)), ("l_returnflag", _pick(R, shapes.RETURN_FLAGS)),
        ("l_linestatus", _pick(f"{R} // 5", shapes.LINE_STATUSES)), ("l_shipdate", _day(f"8400 + {R} % 2500")),
        ("l_commitdate", _day(f"8430 + {R} % 2500")), ("l_receiptdate", _day(f"8460 + {R} % 2500")),
        ("l_shipinstruct", _pick(R, shapes.SHIP_INSTRUCTIONS)), ("l_shipmode", _pick(R, shapes.SHIP_MODES)),
        ("l_comment", _unless(101, _text(R, f"24 + {R} % 96", shapes.ASCII_ALPHABET)))]),
}


def _register(shape: str) -> None:
    @query(f"shape_{shape}", ORACLES[shape])
    def run(spark, sf_dir):
        return shapes.shaped(table(spark, sf_dir, "events"), "event_id", shape, ["event_id"])


for _shape in shapes.SHAPES:
    _register(_shape)
