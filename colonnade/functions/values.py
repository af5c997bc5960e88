"""Value semantics of the column types as Column expressions, JVM-side wherever Spark can express them."""

from __future__ import annotations

import ipaddress

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import types
from ..errors import EngineError
from ..sources.columns import from_bf16, to_bf16


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


# -- decimals ---------------------------------------------------------------------------------------------------------


def decimal_mantissa(value: Column | str, scale: int) -> Column:
    """trunc(value * 10^scale) toward zero, as a long. A cast to a decimal would round half up instead."""
    return (_col(value) * F.lit(10**scale)).cast("bigint")


def decimal_of(mantissa: Column | str, precision: int, scale: int) -> Column:
    """mantissa / 10^scale, exactly: the point is put into the digits, since a division would lose some."""
    mantissa = _col(mantissa)
    digits = F.lpad(F.abs(mantissa.cast("decimal(38,0)")).cast("string"), 38, "0")
    text = F.concat(F.when(mantissa < 0, "-").otherwise(""), F.substring(digits, 1, 38 - scale), F.lit("."), F.substring(digits, 39 - scale, scale))
    return text.cast(T.DecimalType(precision, scale))


def to_decimal(value: Column | str, precision: int, scale: int) -> Column:
    """A decimal or integer as a decimal of fewer digits, those beyond the scale cut off toward zero."""
    value = _col(value)
    cut = F.when(value < 0, F.ceil(value, F.lit(scale))).otherwise(F.floor(value, F.lit(scale)))
    return cut.cast(T.DecimalType(precision, scale))


# -- dates and times ---------------------------------------------------------------------------------------------------


def date_days(date: Column | str) -> Column:
    """Days since the epoch."""
    return F.unix_date(_col(date).cast("date"))


def date_of(days: Column | str) -> Column:
    return F.date_from_unix_date(_col(days).cast("int"))


def datetime_seconds(time: Column | str) -> Column:
    """Whole seconds since the epoch, UTC."""
    return F.unix_seconds(_col(time).cast("timestamp"))


def datetime_of(seconds: Column | str) -> Column:
    return F.timestamp_seconds(_col(seconds))


def datetime64_ticks(time: Column | str, scale: int) -> Column:
    """Units of 10^-scale seconds, truncated toward zero; scale is 0 to 9."""
    _check_scale(scale)
    micros = F.unix_micros(_col(time).cast("timestamp"))
    return micros * F.lit(10 ** (scale - 6)) if scale >= 6 else _whole(micros, F.lit(10 ** (6 - scale)))


def datetime64_of(ticks: Column | str, scale: int) -> Column:
    """The timestamp of ticks; digits below microseconds are cut off toward zero."""
    _check_scale(scale)
    ticks = _col(ticks)
    if scale <= 6:
        return F.timestamp_micros(ticks * F.lit(10 ** (6 - scale)))
    unit = F.lit(10 ** (scale - 6))
    return F.timestamp_micros(_whole(ticks, unit))


def _whole(a: Column, b: Column) -> Column:
    """Integer division toward zero."""
    return F.call_function("div", a, b)


def _check_scale(scale: int) -> None:
    if not 0 <= scale <= 9:
        raise EngineError(f"a scale of 0 to 9 is needed, not {scale}")


# -- enums, intervals, points ------------------------------------------------------------------------------------------


def _enum_map(kind: str, by_name: bool) -> Column:
    node = types.parse(kind)
    if node.name not in types.ENUM_RANGE or not node.params:
        raise EngineError(f"{kind} is no enum with names")
    pairs = [x for name, value in node.params for x in ((F.lit(name), F.lit(value)) if by_name else (F.lit(value), F.lit(name)))]
    return F.create_map(*pairs)


def enum_value(name: Column | str, kind: str, strict: bool = True) -> Column:
    """The number of an enum's name. An unknown one is an error, or null if not strict."""
    return _looked_up(_enum_map(kind, True), _col(name), kind, strict)


def enum_name(value: Column | str, kind: str, strict: bool = True) -> Column:
    return _looked_up(_enum_map(kind, False), _col(value).cast("int"), kind, strict)


def _looked_up(table: Column, key: Column, kind: str, strict: bool) -> Column:
    found = F.try_element_at(table, key)
    if not strict:
        return found
    return F.when(key.isNull() | found.isNotNull(), found).otherwise(F.raise_error(F.concat(key.cast("string"), F.lit(f" is not in {kind}"))))


def typed(value: Column, name: str, kind: str) -> Column:
    """A column under a name, its type string in the metadata. Computed columns lose metadata, so this comes last."""
    return value.alias(name, metadata=types.parse(kind).field(name).metadata)


def interval(count: Column | str, scale: str) -> Column:
    """``count`` units, as Spark's interval of the scale's kind; scale is a type name such as IntervalWeek."""
    if scale not in types.INTERVALS:
        raise EngineError(f"{scale} is no interval")
    kind, unit = types.INTERVALS[scale]
    count = _col(count)
    if kind == "month":
        return F.make_ym_interval(F.lit(0), (count * unit).cast("int"))
    return F.make_dt_interval((count * (unit // 86_400_000_000)).cast("int")) if unit % 86_400_000_000 == 0 else F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (count * (unit // 1_000_000)).cast("decimal(18,6)"))


def point(x: Column | str, y: Column | str) -> Column:
    return F.struct(_col(x).cast("double").alias("x"), _col(y).cast("double").alias("y"))


# -- addresses and identifiers -----------------------------------------------------------------------------------------


def ipv4_number(address: Column | str) -> Column:
    """The 32 bits of a dotted quad, first octet lowest."""
    parts = F.split(_col(address), r"\.")
    return sum((F.element_at(parts, i + 1).cast("bigint") * F.lit(1 << 8 * i) for i in range(1, 4)), F.element_at(parts, 1).cast("bigint"))


def ipv4_text(number: Column | str) -> Column:
    number = _col(number).cast("bigint")
    return F.concat_ws(".", *(F.shiftright(number, 8 * i).bitwiseAND(F.lit(255)).cast("string") for i in range(4)))


@F.pandas_udf(T.BinaryType())
def ipv6_bytes(column: pd.Series) -> pd.Series:
    """The 16 bytes of an IPv6 address, in network order; null stays null."""
    return column.map(lambda x: None if x is None else ipaddress.IPv6Address(x).packed)


@F.pandas_udf(T.StringType())
def ipv6_text(column: pd.Series) -> pd.Series:
    return column.map(lambda x: None if x is None else str(ipaddress.IPv6Address(bytes(x))))


def uuid_wire(identifier: Column | str) -> Column:
    """The 16 bytes of an identifier as blocks hold them: either half reversed."""
    plain = F.replace(_col(identifier), F.lit("-"), F.lit(""))
    return F.unhex(F.concat(*(F.substring(plain, at + 1, 2) for half in (0, 16) for at in range(half + 14, half - 2, -2))))


def uuid_text(wire: Column | str) -> Column:
    text = F.lower(F.hex(_col(wire)))
    pairs = [F.substring(text, at + 1, 2) for half in (0, 16) for at in range(half + 14, half - 2, -2)]
    cuts = {4, 6, 8, 10}
    return F.concat(*(x for i, p in enumerate(pairs) for x in ((F.lit("-"), p) if i in cuts else (p,))))


# -- strings, numbers, nulls -------------------------------------------------------------------------------------------


def fixed_string(value: Column | str, size: int) -> Column:
    """Bytes padded with zeros to a size; longer ones are an error."""
    data = _col(value).cast("binary")
    return F.when(F.octet_length(data) <= size, F.rpad(data, F.lit(size), F.lit(b"\0"))).when(data.isNotNull(), F.raise_error(F.lit(f"a value is longer than {size} bytes")).cast("binary"))


@F.pandas_udf(T.IntegerType())
def bf16_bits(column: pd.Series) -> pd.Series:
    """The 16 bits of a number in bfloat16, to nearest, ties to even."""
    return pd.Series(to_bf16(column.to_numpy(np.float32)).astype(np.int32))


@F.pandas_udf(T.FloatType())
def bf16_value(column: pd.Series) -> pd.Series:
    return pd.Series(from_bf16(column.to_numpy(np.uint32)))


def to_bfloat16(value: Column | str) -> Column:
    """A number rounded to bfloat16, as a float; null stays null."""
    value = _col(value).cast("float")
    return F.when(value.isNotNull(), bf16_value(bf16_bits(F.coalesce(value, F.lit(0.0).cast("float")))))


def or_nan(value: Column | str) -> Column:
    """Null as NaN, for consumers of plain doubles."""
    return F.coalesce(_col(value).cast("double"), F.lit(float("nan")))


def wide_sum(value: Column | str) -> Column:
    """The sum of unsigned 64-bit numbers, without overflow."""
    return F.sum(_col(value).cast("decimal(20,0)"))


# -- arrays and maps ---------------------------------------------------------------------------------------------------


def zero_to(n: Column | str) -> Column:
    """The array 0..n-1; empty where n is 0 or less."""
    n = _col(n).cast("bigint")
    return F.when(n > 0, F.sequence(F.lit(0).cast("bigint"), n - 1)).when(n.isNotNull(), F.array().cast("array<bigint>"))


def array_offsets(arrays: Column | str) -> Column:
    """Of an array of arrays, where each one ends in their concatenation."""
    lengths = F.transform(_col(arrays), lambda x: F.size(x).cast("bigint"))
    return F.transform(lengths, lambda _, i: F.aggregate(F.slice(lengths, F.lit(1), i + 1), F.lit(0).cast("bigint"), lambda a, x: a + x))


def pairs_map(pairs: Column | str, key: str = "key", value: str = "value") -> Column:
    """A map of key-value pairs in which the last of equal keys wins, whatever the session's policy; ``key`` and ``value`` name their fields. Pairs are sorted by key and place, so
    the work grows hardly faster than their number."""
    placed = F.array_sort(F.transform(_col(pairs), lambda p, i: F.struct(p[key].alias("k"), i.alias("i"), p[value].alias("v"))))
    # A transform over an array of one binds the sorted pairs, which an inner function would work out again for each.
    last = F.transform(F.array(placed), lambda s: F.filter(s, lambda p, i: (i + 1 == F.size(s)) | (F.get(s, i + 1)["k"] != p["k"])))
    return F.map_from_entries(F.transform(F.element_at(last, 1), lambda p: F.struct(p["k"].alias("key"), p["v"].alias("value"))))


def key_width(distinct: Column | str) -> Column:
    """Bytes of a dictionary key for so many values."""
    n = _col(distinct)
    return F.when(n <= 1 << 8, 1).when(n <= 1 << 16, 2).when(n <= 1 << 32, 4).otherwise(8)
