from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from colonnade.errors import EngineError
from colonnade.functions import sqlcompat
from colonnade.functions import values as V
from colonnade.functions.cityhash import cityhash128_col, digest


def one(spark, *columns):
    return list(spark.range(1).select(*(c.alias(f"c{i}") for i, c in enumerate(columns))).first())


def test_decimals(spark):
    cases = [("-123.456", 2, -12345), ("3.149", 2, 314), ("-0.019", 2, -1), ("1.000000000", 9, 10**9), ("0.01", 2, 1)]
    assert one(spark, *(V.decimal_mantissa(F.lit(x).cast("decimal(20,9)"), s) for x, s, _ in cases)) == [m for *_, m in cases]
    assert one(spark, V.decimal_of(F.lit(-12345), 9, 2), V.decimal_of(F.lit(7), 38, 9), V.decimal_of(F.lit(5), 9, 0)) == [Decimal("-123.45"), Decimal("7E-9"), Decimal(5)]
    assert one(spark, V.to_decimal(F.lit("-1.239").cast("decimal(9,4)"), 9, 2)) == [Decimal("-1.23")]


def test_times(spark):
    before = F.lit("1969-12-31 23:59:58.123456").cast("timestamp")
    assert one(spark, V.datetime64_ticks(before, 3), V.datetime64_ticks(before, 6), V.datetime64_ticks(before, 9), V.datetime64_ticks(before, 0)) == [-1876, -1876544, -1876544000, -1]
    assert one(spark, V.datetime64_ticks(V.datetime64_of(F.lit(-1876), 3), 3), V.datetime64_ticks(V.datetime64_of(F.lit(-1876544999), 9), 6)) == [-1876, -1876544]
    assert one(spark, V.date_days(F.lit("1900-01-01")), V.date_of(F.lit(120529)), V.datetime_seconds(F.lit("2024-05-13 12:34:56.9"))) == [-25567, dt.date(2299, 12, 31), 1715603696]
    with pytest.raises(EngineError):
        V.datetime64_ticks(before, 10)


def test_enums(spark):
    kind = "Enum8('off' = 0, 'on' = 1)"
    assert one(spark, V.enum_value(F.lit("on"), kind), V.enum_name(F.lit(0), kind), V.enum_value(F.lit("x"), kind, strict=False), V.enum_value(F.lit(None).cast("string"), kind)) == [1, "off", None, None]
    with pytest.raises(PySparkException):
        one(spark, V.enum_value(F.lit("x"), kind))


def test_addresses_and_bytes(spark):
    assert one(spark, V.ipv4_number(F.lit("192.168.1.42")), V.ipv4_text(F.lit(704751808)), V.ipv6_text(V.ipv6_bytes(F.lit("::1"))), F.hex(V.ipv6_bytes(F.lit("2001:db8::")))) == [704751808, "192.168.1.42", "::1", "20010DB8" + "0" * 24]
    name = "00010203-0405-0607-0809-0a0b0c0d0e0f"
    assert one(spark, F.hex(V.uuid_wire(F.lit(name))), V.uuid_text(V.uuid_wire(F.lit(name)))) == ["07060504030201000F0E0D0C0B0A0908", name]
    assert one(spark, F.hex(V.fixed_string(F.lit("ab"), 4)), V.fixed_string(F.lit(None).cast("string"), 4)) == ["61620000", None]
    with pytest.raises(PySparkException):
        one(spark, V.fixed_string(F.lit("abcde"), 4))
    assert one(spark, cityhash128_col(F.lit("abc").cast("binary"))) == [bytearray(digest(b"abc"))]


def test_numbers_and_containers(spark):
    assert one(spark, V.to_bfloat16(F.lit(3.14)), V.bf16_bits(F.lit(1.5).cast("float")), V.to_bfloat16(F.lit(None).cast("double"))) == [3.140625, 0x3FC0, None]
    assert one(spark, V.zero_to(F.lit(3)), V.zero_to(F.lit(0)), V.zero_to(F.lit(-1)), V.zero_to(F.lit(None).cast("int"))) == [[0, 1, 2], [], [], None]
    nested = F.array(F.array(F.lit(1), F.lit(2)), F.array().cast("array<int>"), F.array(F.lit(3)))
    assert one(spark, V.array_offsets(nested)) == [[2, 2, 3]]
    pairs = F.array(*(F.struct(F.lit(k).alias("key"), F.lit(v).alias("value")) for k, v in (("a", 1), ("b", 2), ("a", 3))))
    assert one(spark, V.pairs_map(pairs)) == [{"b": 2, "a": 3}]
    assert one(spark, *(V.key_width(F.lit(n)) for n in (1, 256, 257, 65537, 1 << 33))) == [1, 1, 2, 4, 8]
    assert one(spark, F.lit("2020-01-01").cast("timestamp") + V.interval(F.lit(2), "IntervalWeek") == F.lit("2020-01-15").cast("timestamp"), F.lit("2020-01-01").cast("date") + V.interval(F.lit(-1), "IntervalQuarter") == F.lit("2019-10-01").cast("date"), F.lit("2020-01-01").cast("timestamp") + V.interval(F.lit(90), "IntervalMinute") == F.lit("2020-01-01 01:30:00").cast("timestamp")) == [True] * 3
    with pytest.raises(EngineError):
        V.interval(F.lit(1), "IntervalAge")


SURFACE = {
    "SELECT count(), sum(number) FROM numbers(10) WHERE intDiv(number, 3) * 3 > 2": [7, 42],
    "SELECT [1,2,3][1], ifNull(NULL, 2), 'a::b [1] intDiv(1, 2)', toUInt8(7), toString(1.5)": [1, 2, "a::b [1] intDiv(1, 2)", 7, "1.5"],
    "SELECT arrayMap(x -> x * 2, range(3)), range(0), ((1.5, 2)::Point).x": [[0, 2, 4], [], 1.5],
    "SELECT -1.239::Decimal(9, 2), toDecimal64(1.999, 1), CAST(1 AS Enum8('off' = 0, 'on' = 1)), CAST('5' AS BIGINT)": [Decimal("-1.23"), Decimal("1.9"), "on", 5],
    "SELECT toNullable(1), toLowCardinality('a'), CAST(toFixedString('ab', 3) AS LowCardinality(FixedString(3))), toBFloat16(3.14)": [1, "a", bytearray(b"ab\0"), 3.140625],
    "SELECT cast(DATE '2020-01-01' + INTERVAL 2 DAY AS STRING), cast(DATE '2020-01-01' + INTERVAL (1 + 1) WEEK AS STRING), cast(DATE '2020-01-31' + INTERVAL 1 MONTH AS STRING) -- toInt8(x)": None,
    "SELECT max(number) FROM (SELECT number FROM system.numbers LIMIT 5)": [4],
    "SELECT element_at(map('k', 1), 'k') /* intDiv */, tuple(1, 'x').col2, if(1 = 1, NULL, 3), assumeNotNull(4)": [1, "x", None, 4],
}


@pytest.mark.parametrize("text", SURFACE)
def test_surface_sql(spark, text):
    sqlcompat.register(spark)
    row = spark.sql(sqlcompat.translate(text)).first()
    assert SURFACE[text] is None or list(row) == SURFACE[text]


def test_plain_sql_stays(spark):
    for text in ("SELECT a.b, `x y`, \"q\" FROM t JOIN u USING (k) WHERE x IN (1, 2) AND y BETWEEN 1 AND 2", "SELECT sum(x) OVER (PARTITION BY y ORDER BY z) FROM range(5)", "SELECT INTERVAL '1' DAY, CAST(x AS DECIMAL(10, 2)) FROM t".replace("CAST(x AS DECIMAL(10, 2))", "y")):
        assert sqlcompat.translate(text) == text
    assert sqlcompat.settings_of("SELECT 1 SETTINGS a = 1, b='x'") == ("SELECT 1", {"a": "1", "b": "x"})
    with pytest.raises(EngineError):
        sqlcompat.translate("SELECT ::Int8")
