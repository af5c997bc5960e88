from __future__ import annotations

import pytest

from colonnade import types
from colonnade.errors import TypeStringError

SCALARS = "Int8 Int16 Int32 Int64 Int128 Int256 UInt8 UInt16 UInt32 UInt64 UInt128 UInt256 Float32 Float64 BFloat16 Bool String JSON UUID IPv4 IPv6 Date Date32 DateTime Point Nothing".split()
OTHERS = "Decimal32 Decimal64 Decimal128 Decimal256 IntervalSecond IntervalMinute IntervalHour IntervalDay IntervalWeek IntervalMonth IntervalQuarter IntervalYear Enum8 Enum16 DateTime64".split()


@pytest.mark.parametrize("name", [*SCALARS, *OTHERS])
def test_scalars_and_compositions(name):
    assert str(types.parse(name)) == name
    for wrapper in ("Array({})", "Nullable({})", "LowCardinality({})", "Map(String, {})", "Tuple({}, a {})", "Array(Array(Nullable({})))", "LowCardinality(Nullable({}))", "Array(Map(String, Tuple({})))"):
        text = wrapper.replace("{}", name)
        node = types.parse(text)
        assert str(node) == text and node.field("c").name == "c"


def test_parameters_survive():
    for text in ("Decimal(9, 2)", "FixedString(8)", "DateTime('Europe/Paris')", "DateTime64(3)", "DateTime64(9, 'UTC')", "Enum8('a,b' = 1, 'c' = 2)", "Enum8('a=b' = 1, 'normal' = 2)", "Enum16('neg' = -10, 'zero' = 0, 'pos' = 32000)", "Map(Enum8('(' = 1), String)", "Tuple(Enum8('(' = 1), Int32)", "Tuple(strings String, ints Int64)"):
        assert str(types.parse(text)) == text
    assert str(types.parse(" Decimal( 9,2 ) ")) == "Decimal(9, 2)" and str(types.parse("Decimal64(4)")) == "Decimal(18, 4)"
    assert types.parse("Enum8('b' = 2, 'a' = 1)").text == "Enum8('a' = 1, 'b' = 2)"
    assert dict(types.parse(r"Enum8('it\'s' = 1, 'two''s' = 2)").params) == {"it's": 1, "two's": 2}


@pytest.mark.parametrize("text", ["", "Int33", "Array()", "Array(Int8, Int8)", "Map(Int8)", "Decimal(77, 2)", "Decimal(5, 6)", "FixedString(0)", "FixedString(-1)", "DateTime64(10)", "Int8(3)", "Array(Int8", "Int8)", "Enum8('a' = 200)", "Enum8('a' = 1, 'a' = 2)", "Enum8('a' = 1, 'b' = 1)", "Enum8('a')", "Tuple(a b Int8)", "String;", "Nullable"])
def test_wrong_strings(text):
    with pytest.raises(TypeStringError):
        types.parse(text)


#: Digits that the four widths of decimals hold.
WIDTHS = {32: 9, 64: 18, 128: 38, 256: 76}
WRAPPERS = ("{}", "Array({})", "Nullable({})", "Map(UUID, {})", "Map({}, Bool)", "Tuple(Int8, {})", "Tuple(left {}, right Date)", "Array(Tuple({}))", "LowCardinality({})", "Array(Nullable({}))")


def width_of(precision):
    return next(width for width, digits in WIDTHS.items() if precision <= digits)


@pytest.mark.parametrize("wrapper", WRAPPERS)
def test_decimals_are_normalized_by_width(wrapper):
    for precision in range(1, 77):
        for scale in {0, precision // 2, precision}:
            for comma in (",", ", ", " , "):
                assert types.normalize(wrapper.replace("{}", f"Decimal({precision}{comma}{scale})")) == wrapper.replace("{}", f"Decimal{width_of(precision)}")


@pytest.mark.parametrize("wrapper", WRAPPERS)
def test_parameters_without_meaning_for_the_wire_are_left_out(wrapper):
    for text, bare in (("DateTime('Asia/Tokyo')", "DateTime"), ("DateTime64(6, 'Asia/Tokyo')", "DateTime64(6)"), ("Enum16('low' = -3, 'high' = 700)", "Enum16"), ("Enum8('x' = 5)", "Enum8")):
        assert types.normalize(wrapper.replace("{}", text)) == wrapper.replace("{}", bare)
    for name in SCALARS:
        assert types.normalize(wrapper.replace("{}", name)) == wrapper.replace("{}", name)
    assert types.normalize("not a type") == "not a type"


@pytest.mark.parametrize("wrapper", WRAPPERS)
def test_compatible_is_equal_after_normalizing(wrapper):
    put = lambda name: wrapper.replace("{}", name)
    for width in WIDTHS:
        for precision in (1, 9, 10, 18, 19, 38, 39, 76):
            assert types.is_compatible(put(f"Decimal{width}"), put(f"Decimal({precision}, 1)")) is (width == width_of(precision))
    for a in SCALARS:
        for b in SCALARS[::5]:
            assert types.is_compatible(put(a), put(b)) is (a == b)


def test_hints():
    for pair in (("Nullable(Float64)", "Float64"), ("Float64", "Nullable(Float64)"), ("LowCardinality(String)", "String"), ("String", "LowCardinality(String)")):
        assert types.mismatch_hint(*pair)
    assert types.mismatch_hint("Int32", "Float64") == types.mismatch_hint("Array(Int32)", "Array(Float64)") == ""


def test_split_top_level():
    assert types.split_top_level("a, 'b,c', f(x, y), 'it\\'s, too'") == ["a", "'b,c'", "f(x, y)", "'it\\'s, too'"]
    assert types.split_top_level("") == []


def test_spark_types_and_back(spark):
    columns = {"a": "Enum8('x' = 1)", "b": "Nullable(UInt64)", "c": "Array(Nullable(Int32))", "d": "Tuple(s String, n Int64)", "e": "FixedString(4)", "f": "DateTime64(9)", "g": "Map(String, Float64)"}
    schema = types.schema(columns)
    assert schema.simpleString() == "struct<a:string,b:decimal(20,0),c:array<int>,d:struct<s:string,n:bigint>,e:binary,f:bigint,g:map<string,double>>"
    frame = spark.createDataFrame([], schema)
    assert {f.name: str(types.of_spark(f.dataType, f.nullable, f.metadata)) for f in frame.schema.fields} == columns
    plain = spark.sql("SELECT 1 AS i, 'a' AS s, 1.5D AS f, array(1) AS a, struct(1 AS x) AS t, map('k', 2L) AS m, CAST(1 AS DECIMAL(5, 2)) AS d, NULL AS n, current_date() AS y, current_timestamp() AS z, x'00' AS b")
    assert [str(types.of_spark(f.dataType, f.nullable)) for f in plain.schema.fields] == ["Int32", "String", "Float64", "Array(Int32)", "Tuple(x Int32)", "Map(String, Int64)", "Nullable(Decimal(5, 2))", "Nothing", "Date32", "DateTime64(6)", "String"]
