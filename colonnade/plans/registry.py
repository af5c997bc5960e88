"""The queries over the driver's tables, by name, and the DuckDB SQL they are compared with."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import types
from ..functions import values as V
from ..functions.cityhash import cityhash128_col
from ..operators import drain, retry
from ..operators.engine import Engine, EngineOptions, InputColumn, InsertQuery, ResultColumn, SelectQuery, Setting, check_schema
from ..sources.block import decode_block, encode_block
from ..sources.wire import Reader
from ..streaming import stream

FLAGSHIP = "mixed_types"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings")


def query(sql: str | None):
    """Registers a query under its function's name, with its SQL for comparison."""

    def register(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return register


def plain(name: str, text: str, oracle: str | None = None) -> None:
    """Registers a query that is SQL; tables stand in braces. Without other text the SQL is the same on both sides."""
    used = [t for t in TABLES if f"{{{t}}}" in text]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return spark.sql(text, **{t: read(spark, sf_dir, t) for t in used})

    QUERIES[name] = run
    ORACLE[name] = oracle or text.format(**{t: t for t in used})


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def engine_of(spark: SparkSession) -> Engine:
    return Engine(spark, EngineOptions(dialect="spark"))


def one_row(spark: SparkSession, columns: dict[str, tuple[str, object]]) -> DataFrame:
    return spark.createDataFrame([tuple(v for _, v in columns.values())], ", ".join(f"{k} {t}" for k, (t, _) in columns.items()))


# -- the engine: checked selects, typed results, inserts ---------------------------------------------------------------


@query("SELECT count(*) AS n, CAST(sum(range) AS BIGINT) AS s FROM range(100000)")
def numbers_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return engine_of(spark).frame(SelectQuery("SELECT count(*) AS n, sum(id) AS s FROM range(100000)", [ResultColumn("Int64", "n"), ResultColumn("Int64", "s")]))


#: What an event is, column by column, in the richest types that hold it.
EVENT_TYPES = {"click": 1, "error": 2, "purchase": 3, "signup": 4, "view": 5}
TYPED = {
    "actor": "Int32", "caption": "String", "kind": "LowCardinality(String)", "large": "Nullable(Int32)", "clock": "Array(Int32)", "about": "Map(String, String)", "by": "Tuple(String, Int32)",
    "amount": "Decimal(9, 2)", "code": types.enum_string("Enum8", EVENT_TYPES), "spot": "Point", "since": "IntervalDay", "detail": "JSON", "rough": "BFloat16", "tag": "LowCardinality(FixedString(8))",
}


def typed_events(events: DataFrame) -> list:
    """The typed columns of events (ts, user_id, event_type, value, props)."""
    actor, day = F.col("user_id").cast("int"), F.date_format("ts", "yyyy-MM-dd")
    made = {
        "actor": actor,
        "caption": F.concat(F.col("event_type"), F.lit(" by "), F.col("user_id").cast("string")),
        "kind": F.col("event_type"),
        "large": F.when(F.col("value") >= 100, F.floor("value").cast("int")),
        "clock": F.array(F.month("ts"), F.dayofmonth("ts"), F.hour("ts")),
        "about": F.create_map(F.lit("day"), day, F.lit("actor"), actor.cast("string")),
        "by": F.struct(F.col("event_type").alias("_1"), actor.alias("_2")),
        "amount": V.to_decimal(F.col("value").cast("decimal(18,4)"), 9, 2),
        "code": V.enum_name(V.enum_value("event_type", TYPED["code"]), TYPED["code"]),
        "spot": V.point(F.hour("ts"), "value"),
        "since": V.interval(F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date")), "IntervalDay"),
        "detail": F.col("props"),
        "rough": V.to_bfloat16("value"),
        "tag": V.fixed_string(F.col("event_type"), 8),
    }
    return [V.typed(c, name, TYPED[name]) for name, c in made.items()]


#: A number of 8 significant bits, to nearest with ties to even, and its 16 bits, in DuckDB; q may reach 256, which carries into the exponent.
_ROUGH = "SELECT *, CASE WHEN value = 0 THEN 0 ELSE round_even(abs(value::FLOAT::DOUBLE) / pow(2, floor(log2(abs(value::FLOAT::DOUBLE))) - 7), 0) END AS q, CASE WHEN value = 0 THEN 0 ELSE floor(log2(abs(value::FLOAT::DOUBLE))) END AS e FROM events"


@query(f"""SELECT CAST(user_id AS INTEGER) AS actor, event_type || ' by ' || user_id AS caption, event_type AS kind, CASE WHEN value >= 100 THEN CAST(floor(value) AS INTEGER) ELSE -1 END AS large, 3 AS clock_size,
 CAST(month(ts) + day(ts) + hour(ts) AS BIGINT) AS clock_sum, strftime(ts, '%Y-%m-%d') AS about_day, event_type AS by_1, CAST(user_id AS INTEGER) AS by_2, CAST(trunc(CAST(value AS DECIMAL(18, 4)) * 100) / 100 AS DOUBLE) AS amount,
 event_type AS code, CAST(hour(ts) AS DOUBLE) AS spot_x, value AS spot_y, CAST(date_diff('day', DATE '2024-01-01', ts::DATE) AS BIGINT) AS since_days, props->>'$.k' AS detail_k, CAST(sign(value) * q * pow(2, e - 7) AS DOUBLE) AS rough,
 upper(hex(encode(event_type))) || repeat('00', 8 - strlen(event_type)) AS tag FROM ({_ROUGH})""")
def mixed_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fourteen column types of one table, checked as an engine result, then taken apart into plain columns."""
    events = read(spark, sf_dir, "events")
    made = events.select(*typed_events(events))
    check_schema(made.schema, [ResultColumn(t, n) for n, t in TYPED.items()])
    return made.select(
        "actor", "caption", "kind", F.coalesce("large", F.lit(-1)).alias("large"), F.size("clock").alias("clock_size"), F.aggregate("clock", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("clock_sum"),
        F.element_at("about", "day").alias("about_day"), F.col("by._1").alias("by_1"), F.col("by._2").alias("by_2"), F.col("amount").cast("double").alias("amount"), "code", F.col("spot.x").alias("spot_x"),
        F.col("spot.y").alias("spot_y"), F.extract(F.lit("DAY"), F.col("since")).cast("bigint").alias("since_days"), F.get_json_object("detail", "$.k").alias("detail_k"), F.col("rough").cast("double").alias("rough"), F.hex("tag").alias("tag"),
    )


@query("SELECT n_nationkey AS id, 'nation ' || n_name AS name, CAST(n_regionkey * 2 + 0.5 AS DOUBLE) AS score FROM nation")
def insert_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nations inserted block by block into a managed table; the rows that it then has."""
    engine, table = engine_of(spark), f"inserted_{uuid.uuid4().hex}"
    nations = [tuple(r) for r in read(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey").collect()]
    engine.execute(f"CREATE TABLE {table} (id BIGINT, name STRING, score DOUBLE) USING parquet")
    try:
        columns = [InputColumn("id", "Int64"), InputColumn("name", "String"), InputColumn("score", "Float64")]
        blocks = iter([nations[at : at + 10] for at in range(0, len(nations), 10)])

        def fill() -> bool:
            block = next(blocks, [])
            columns[0].values = [k for k, _, _ in block]
            columns[1].values = [f"nation {n}" for _, n, _ in block]
            columns[2].values = [r * 2 + 0.5 for _, _, r in block]
            return bool(block)

        if fill():
            engine.insert(InsertQuery(f"INSERT INTO {table} VALUES", columns, fill))
        rows = [tuple(r) for r in spark.table(table).collect()]
    finally:
        engine.execute(f"DROP TABLE IF EXISTS {table}")
    return spark.createDataFrame(rows, "id long, name string, score double")


@query("""SELECT CAST(number AS INTEGER) AS a, CAST(number // 3 * 3 AS BIGINT) AS b, 'x' || number AS c, CASE WHEN number % 2 = 0 THEN -1 ELSE number END AS d, CAST(CAST(trunc(number * 1.239 * 100) / 100 AS DECIMAL(9, 2)) AS DOUBLE) AS e,
 CASE number % 2 WHEN 0 THEN 'off' ELSE 'on' END AS f, CAST(coalesce(list_sum(range(number % 5)), 0) AS BIGINT) AS g FROM (SELECT event_id AS number FROM events)""")
def surface_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The query surface's own spellings, translated."""
    read(spark, sf_dir, "events").select(F.col("event_id").alias("number")).createOrReplaceTempView("surface_events")
    text = """SELECT toInt32(number) AS a, intDiv(number, 3) * 3 AS b, concat('x', toString(number)) AS c, ifNull(if(number % 2 = 0, NULL, number), toInt64(-1)) AS d,
    toDecimal32(number * 1.239, 2) AS e, CAST(number % 2 AS Enum8('off' = 0, 'on' = 1)) AS f, aggregate(arrayMap(x -> toInt64(x), range(number % 5)), toInt64(0), (s, x) -> s + x) AS g FROM surface_events SETTINGS max_block_size = 65536"""
    made = Engine(spark).frame(SelectQuery(text, [ResultColumn("Int32", "a"), ResultColumn("Int64", "b"), ResultColumn("String"), ResultColumn("Int64"), ResultColumn("Decimal(9, 2)"), ResultColumn("String"), ResultColumn("Int64")]))
    return made.withColumn("e", F.col("e").cast("double"))


# -- streams, drains, retries ------------------------------------------------------------------------------------------

#: Each shape's columns from lineitem, and what its fold sums: all columns, with arrays by their elements and nulls left out.
_SHAPE_COLUMNS = {"Int64": "l_orderkey", "UInt64": "CAST(l_orderkey AS DECIMAL(20,0))", "Float64": "l_quantity", "Int32": "l_linenumber", "UInt8": "CAST(l_linenumber AS SMALLINT)", "Nullable(Float64)": "IF(l_quantity > 25, l_quantity, NULL)", "Array(Float64)": "array(l_quantity, CAST(l_linenumber AS DOUBLE))"}
_SHAPE_SUMS = {"Int64": "l_orderkey", "UInt64": "l_orderkey", "Float64": "l_quantity", "Int32": "l_linenumber", "UInt8": "l_linenumber", "Nullable(Float64)": "CASE WHEN l_quantity > 25 THEN l_quantity ELSE 0 END", "Array(Float64)": "l_quantity + l_linenumber"}


def _shape_sum(held: tuple[int, float], *arrays) -> tuple[int, float]:
    total = sum(float(np.nansum(a)) if isinstance(a, np.ndarray) else float(sum(x.sum() for x in a)) for a in arrays)
    return held[0] + len(arrays[0]), held[1] + total


@query(" UNION ALL ".join(f"SELECT '{name}' AS shape, count(*) AS n, CAST(round(sum({' + '.join(_SHAPE_SUMS[t] for t in kinds)}), 2) AS DOUBLE) AS total FROM lineitem" for name, kinds in stream.SHAPES.items()))
def stream_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every named shape folded on the executors: rows, and the sum of all values."""
    read(spark, sf_dir, "lineitem").createOrReplaceTempView("stream_lineitem")
    engine, out = engine_of(spark), []
    for name, kinds in stream.SHAPES.items():
        n, total = stream.fold(engine, _shape_text(kinds, "stream_lineitem"), kinds, (0, 0.0), _shape_sum, lambda a, b: (a[0] + b[0], a[1] + b[1]))
        out.append((name, n, round(total, 2)))
    return spark.createDataFrame(out, "shape string, n long, total double")


def _shape_text(kinds: tuple[str, ...], table: str) -> str:
    return "SELECT " + ", ".join(f"{_SHAPE_COLUMNS[t]} AS c{i}" for i, t in enumerate(kinds)) + f" FROM {table}"


def _stream_forms() -> list[tuple[str, str, Callable]]:
    """(form, shape, function) of the 28 named streams and their 28 retried forms."""
    forms = [("rows", name) for name in stream.ROW_SHAPES] + [("blocks", name) for name in stream.BLOCK_SHAPES]
    return [(f"{kind}{form}", name, getattr(module, f"{form}_{name}")) for kind, module in (("", stream), ("retried ", retry)) for form, name in forms]


@query(
    " UNION ALL ".join(
        f"SELECT '{form}' AS form, '{name}' AS shape, count(*) AS n, CAST(round(sum({' + '.join(_SHAPE_SUMS[t] for t in stream.SHAPES[name])}), 2) AS DOUBLE) AS total FROM lineitem WHERE l_quantity > 40"
        for form, name, _ in _stream_forms()
    )
)
def named_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every named stream and every retried one, the latter over a connection that fails at first: rows, and the sum of all values."""
    read(spark, sf_dir, "lineitem").where("l_quantity > 40").createOrReplaceTempView("named_lineitem")
    engine, out = engine_of(spark), []
    for form, name, call in _stream_forms():
        held = (0, 0.0)

        def blocks(*arrays) -> None:
            nonlocal held
            held = _shape_sum(held, *arrays)

        def rows(*values) -> None:
            nonlocal held
            held = held[0] + 1, held[1] + sum(float(x.sum()) if isinstance(x, np.ndarray) else 0.0 if x != x else float(x) for x in values)

        text, action = _shape_text(stream.SHAPES[name], "named_lineitem"), rows if "rows" in form else blocks
        if form.startswith("retried"):
            lost = [ConnectionError("lost")]

            def connect(_: EngineOptions, lost: list = lost) -> Engine:
                if lost:
                    raise lost.pop()
                return engine

            call(EngineOptions(), retry.RetryPolicy(base_backoff_ms=1), text, action, connect=connect)
        else:
            call(engine, text, action)
        out.append((form, name, held[0], round(held[1], 2)))
    return spark.createDataFrame(out, "form string, shape string, n long, total double")


@query("SELECT count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS keys, CAST(round(sum(l_quantity), 2) AS DOUBLE) AS quantity FROM lineitem WHERE l_quantity > 45")
def retried_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream that fails once before its first row and is run again."""
    read(spark, sf_dir, "lineitem").createOrReplaceTempView("retry_lineitem")
    failures, held = [ConnectionError("lost")], [0, 0, 0.0]

    def connect(_: EngineOptions) -> Engine:
        if failures:
            raise failures.pop()
        return engine_of(spark)

    def add(key: int, quantity: float) -> None:
        held[0], held[1], held[2] = held[0] + 1, held[1] + key, held[2] + quantity

    retry.rows_i64f64(EngineOptions(), retry.RetryPolicy(base_backoff_ms=1), "SELECT l_orderkey, l_quantity FROM retry_lineitem WHERE l_quantity > 45", add, connect=connect)
    return one_row(spark, {"n": ("long", held[0]), "keys": ("long", held[1]), "quantity": ("double", round(held[2], 2))})


@query("""SELECT count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys, CAST(sum(o_orderkey) AS BIGINT) AS total, min(o_orderkey) AS least, max(o_orderkey) AS largest, max(o_orderdate) AS latest, TRUE AS in_blocks, count(*) AS told
 FROM orders WHERE o_orderstatus <> 'P'""")
def column_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns streamed block by block under a setting, with totals, extremes, progress and profile of the same run."""
    read(spark, sf_dir, "orders").createOrReplaceTempView("stream_orders")
    sizes, held, told = [], [0, 0], {}

    def add(block) -> None:
        sizes.append(block.rows)
        held[0], held[1] = held[0] + block.rows, held[1] + int(np.sum(block.values[0]))

    text = "SELECT o_orderkey, o_orderdate FROM stream_orders WHERE o_orderstatus <> 'P'"
    engine, setting = engine_of(spark), [Setting("max_block_size", "1000", important=True)]
    stream.columns(engine, SelectQuery(text, settings=setting), add)
    engine.select(SelectQuery(text, settings=setting, totals=["o_orderkey"], extremes=True, on_totals=lambda b: told.update(total=b.values[0][0]), on_extremes=lambda b: told.update(ends=b.values), on_profile=lambda p: told.update(rows=p.rows)))
    keys, dates = told["ends"]
    return one_row(spark, {"n": ("long", held[0]), "keys": ("long", held[1]), "total": ("long", told["total"]), "least": ("long", keys[0]), "largest": ("long", keys[1]), "latest": ("timestamp_ntz", dates[1]), "in_blocks": ("boolean", max(sizes) <= 1000), "told": ("long", told["rows"])})


@query("SELECT count(*) AS n, CAST(sum(o_custkey) AS BIGINT) AS customers, CAST(round(max(o_totalprice), 2) AS DOUBLE) AS most FROM orders WHERE o_orderstatus = 'F'")
def counted_drain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two columns drained into arrays of exactly the counted size."""
    read(spark, sf_dir, "orders").createOrReplaceTempView("drain_orders")
    keys, prices = drain.count_then_drain(engine_of(spark), "SELECT o_custkey, o_totalprice FROM drain_orders WHERE o_orderstatus = 'F'", ["int64", "float64"])
    return one_row(spark, {"n": ("long", len(keys)), "customers": ("long", int(keys.sum())), "most": ("double", round(float(prices.max()), 2) if len(prices) else None)})


@query("SELECT event_id, user_id, event_type, CAST(round(value, 6) AS DOUBLE) AS value, CAST(epoch_us(ts) // 1000 AS BIGINT) AS ticks FROM events")
def block_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events encoded as blocks and decoded again, on the executors."""
    kinds = {"event_id": "Int64", "user_id": "UInt64", "event_type": "LowCardinality(String)", "value": "Nullable(Float64)", "ticks": "Int64"}
    nodes = [types.parse(k) for k in kinds.values()]

    def through(batches):
        import pyarrow as pa

        for batch in batches:
            data = encode_block(list(kinds), nodes, [c.to_pylist() for c in batch.columns])
            block = decode_block(Reader(data))
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(block.values, batch.schema, strict=True)], schema=batch.schema)

    events = read(spark, sf_dir, "events").select("event_id", "user_id", "event_type", F.round("value", 6).alias("value"), V.datetime64_ticks("ts", 3).alias("ticks"))
    return events.mapInArrow(through, events.schema)


# -- value semantics ---------------------------------------------------------------------------------------------------


@query("SELECT l_orderkey, l_linenumber, CAST(trunc(CAST(l_extendedprice AS DECIMAL(18, 4)) * 100) AS BIGINT) AS mantissa, CAST(trunc(CAST(l_extendedprice AS DECIMAL(18, 4)) * 10) / 10 AS DOUBLE) AS cut FROM lineitem")
def decimal_trunc(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("l_extendedprice").cast("decimal(18,4)")
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", V.decimal_mantissa(price, 2).alias("mantissa"), V.to_decimal(price, 15, 1).cast("double").alias("cut"))


@query("SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 WHEN 'P' THEN 2 END AS code, o_orderstatus AS name FROM orders")
def enum_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = types.enum_string("Enum8", {"F": 0, "O": 1, "P": 2})
    return read(spark, sf_dir, "orders").select("o_orderkey", V.enum_value("o_orderstatus", kind).alias("code"), V.enum_name(V.enum_value("o_orderstatus", kind), kind).alias("name"))


@query("SELECT o_orderkey, CAST(o_orderdate::DATE - DATE '1970-01-01' AS INTEGER) AS days, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders")
def date_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").select("o_orderkey", V.date_days("o_orderdate").alias("days"), V.date_of(V.date_days("o_orderdate")).cast("string").alias("day"))


@query("SELECT event_id, CAST(epoch_us(ts) // 1000000 AS BIGINT) AS seconds, CAST(epoch_us(ts) // 1000 AS BIGINT) AS millis, CAST(epoch_us(ts) * 1000 AS BIGINT) AS nanos FROM events")
def datetime_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").select("event_id", V.datetime_seconds("ts").alias("seconds"), V.datetime64_ticks("ts", 3).alias("millis"), V.datetime64_ticks("ts", 9).alias("nanos"))


@query("SELECT o_orderkey, o_orderdate + to_days(CAST(o_orderkey % 7 AS INTEGER)) AS later, o_orderdate + to_days(CAST(o_orderkey % 3 * 7 AS INTEGER)) AS weeks, o_orderdate + to_months(CAST(o_orderkey % 5 * 3 AS INTEGER)) AS quarters FROM orders")
def interval_scales(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, date = F.col("o_orderkey"), F.col("o_orderdate")
    return read(spark, sf_dir, "orders").select("o_orderkey", (date + V.interval(key % 7, "IntervalDay")).alias("later"), (date + V.interval(key % 3, "IntervalWeek")).alias("weeks"), (date + V.interval(key % 5, "IntervalQuarter")).alias("quarters"))


@query("SELECT event_id, CAST(epoch_us(ts) // 1000 AS BIGINT) AS millis, epoch_ms(epoch_us(ts) // 1000) AS from_millis, epoch_ms(epoch_us(ts) // 1000000 * 1000) AS from_seconds, make_timestamp(epoch_us(ts)) AS from_nanos FROM events")
def datetime_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks of several scales as timestamps again."""
    rows = read(spark, sf_dir, "events").select("event_id", V.datetime64_ticks("ts", 3).alias("millis"), V.datetime_seconds("ts").alias("seconds"), V.datetime64_ticks("ts", 9).alias("nanos"))
    plain_time = lambda c: c.cast("timestamp_ntz")
    return rows.select("event_id", "millis", plain_time(V.datetime64_of("millis", 3)).alias("from_millis"), plain_time(V.datetime_of("seconds")).alias("from_seconds"), plain_time(V.datetime64_of("nanos", 9)).alias("from_nanos"))


@query("SELECT l_orderkey, l_linenumber, CAST(CAST(trunc(CAST(l_extendedprice AS DECIMAL(18, 4)) * 100) AS DECIMAL(18, 0)) / 100 AS DOUBLE) AS price, CAST(-l_orderkey / 1000.0 AS DOUBLE) AS below FROM lineitem")
def decimal_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decimals of their mantissas, also below zero."""
    price = F.col("l_extendedprice").cast("decimal(18,4)")
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", V.decimal_of(V.decimal_mantissa(price, 2), 18, 2).cast("double").alias("price"), V.decimal_of(-F.col("l_orderkey"), 18, 3).cast("double").alias("below"))


@query("SELECT event_id, event_type AS name, CASE event_type WHEN 'click' THEN -300 WHEN 'view' THEN 300 WHEN 'purchase' THEN 0 ELSE NULL END AS number FROM events")
def enum_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of a 16-bit enum that does not have every name."""
    kind = types.enum_string("Enum16", {"click": -300, "purchase": 0, "view": 300})
    return read(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("name"), V.enum_value("event_type", kind, strict=False).alias("number"))


@query("SELECT n, '2001:db8::' || format('{:x}', n) AS address, '20010DB8' || repeat('0', 20) || upper(lpad(format('{:x}', n), 4, '0')) AS bytes FROM (SELECT DISTINCT user_id % 65535 + 1 AS n FROM events)")
def ipv6_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses as bytes and as their shortest text."""
    users = read(spark, sf_dir, "events").select((F.col("user_id") % 65535 + 1).alias("n")).distinct()
    made = users.select("n", V.ipv6_bytes(F.concat(F.lit("2001:0db8:0:0:0:0:0:"), F.lower(F.hex("n")))).alias("bytes"))
    return made.select("n", V.ipv6_text("bytes").alias("address"), F.hex("bytes").alias("bytes"))


@query("SELECT o_custkey, o_orderkey, array_to_string([1, 1 + o_orderkey % 3, 1 + o_orderkey % 3 + 2], ',') AS ends FROM orders")
def array_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the arrays of an array end in their concatenation."""
    key = F.col("o_orderkey")
    arrays = F.array(F.array(key), V.zero_to(key % 3), F.array(key, key))
    return read(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.array_join(F.transform(V.array_offsets(arrays), lambda x: x.cast("string")), ",").alias("ends"))


@query("""SELECT user_id, hours, CAST(count(*) AS INTEGER) AS n, string_agg(event_type || '=' || event_id, ',' ORDER BY event_type) AS last_of FROM
 (SELECT user_id, event_type, max(event_id) AS event_id, max(count(*)) OVER (PARTITION BY user_id) AS hours FROM events GROUP BY user_id, event_type) GROUP BY user_id, hours""")
def map_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's events by type as a map of pairs, in which the last of a type wins; its keys, values and size."""
    events = read(spark, sf_dir, "events").select("user_id", "event_type", "event_id")
    most = events.groupBy("user_id", "event_type").count().groupBy("user_id").agg(F.max("count").alias("hours"))
    pairs = events.groupBy("user_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("event_id", "event_type"))), lambda x: F.struct(x["event_type"].alias("key"), x["event_id"].alias("value"))).alias("pairs"))
    made = pairs.join(most, "user_id").select("user_id", "hours", V.pairs_map("pairs").alias("m"))
    told = F.array_sort(F.zip_with(F.map_keys("m"), F.map_values("m"), lambda k, v: F.concat(k, F.lit("="), v.cast("string"))))
    return made.select("user_id", "hours", F.size("m").alias("n"), F.array_join(told, ",").alias("last_of"))


@query("SELECT user_id, n, concat_ws('.', n & 255, (n >> 8) & 255, (n >> 16) & 255, (n >> 24) & 255) AS address, n AS back FROM (SELECT DISTINCT user_id, (user_id * 2654435) % 4294967296 AS n FROM events)")
def ipv4_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = read(spark, sf_dir, "events").select("user_id", ((F.col("user_id") * 2654435) % 4294967296).alias("n")).distinct()
    return users.select("user_id", "n", V.ipv4_text("n").alias("address"), V.ipv4_number(V.ipv4_text("n")).alias("back"))


@query("""SELECT c_custkey, h AS plain, upper(substr(h, 15, 2) || substr(h, 13, 2) || substr(h, 11, 2) || substr(h, 9, 2) || substr(h, 7, 2) || substr(h, 5, 2) || substr(h, 3, 2) || substr(h, 1, 2)
 || substr(h, 31, 2) || substr(h, 29, 2) || substr(h, 27, 2) || substr(h, 25, 2) || substr(h, 23, 2) || substr(h, 21, 2) || substr(h, 19, 2) || substr(h, 17, 2)) AS wire FROM (SELECT c_custkey, md5(c_name) AS h FROM customer)""")
def uuid_wire(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = F.md5(F.col("c_name").cast("binary"))
    parts = F.concat_ws("-", *(F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))))
    rows = read(spark, sf_dir, "customer").select("c_custkey", parts.alias("id"))
    return rows.select("c_custkey", F.replace(V.uuid_text(V.uuid_wire("id")), F.lit("-"), F.lit("")).alias("plain"), F.hex(V.uuid_wire("id")).alias("wire"))


@query("SELECT p_partkey, hex(encode(substr(p_brand, 1, 8))) || repeat('00', 8 - strlen(substr(p_brand, 1, 8))) AS fixed FROM part")
def fixed_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select("p_partkey", F.hex(V.fixed_string(F.substring("p_brand", 1, 8), 8)).alias("fixed"))


@query(f"SELECT event_id, CAST(CASE WHEN value < 0 THEN 32768 ELSE 0 END + CASE WHEN value = 0 THEN 0 ELSE (e + 127) * 128 + q - 128 END AS INTEGER) AS bits, CAST(sign(value) * q * pow(2, e - 7) AS FLOAT) AS rounded FROM ({_ROUGH})")
def bf16_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").select("event_id", V.bf16_bits(F.col("value").cast("float")).alias("bits"), V.to_bfloat16("value").alias("rounded"))


# Hashes of the published algorithm, low and high half.
_HASHED = {
    "": (0x3DF09DFC64C09A2B, 0x3CB540C392E51E29), "a": (0xD27139A1AFE01AD0, 0xFD7E8EE2E4C86CF6), "1234567": (0x8E8777E875B97597, 0x8852D1373EB8453B), "12345678": (0x1D7757A6DD6FD9F3, 0x7282A0F9C3847A18),
    "123456789012345": (0xA7ACA61EF9AD6954, 0x69A896E8852A795B), "1234567890123456": (0xE17786877893C752, 0x983B6DB3A5DADD06), "12345678901234567": (0xAC84E9F3D9B62F76, 0x20C27ED832020C63),
}


@query("SELECT n_nationkey, t.text, t.hash FROM nation, (VALUES " + ", ".join(f"('{k}', '{(a.to_bytes(8, 'little') + b.to_bytes(8, 'little')).hex().upper()}')" for k, (a, b) in _HASHED.items()) + ") t(text, hash)")
def cityhash_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts whose hashes are published, beside every nation."""
    texts = F.explode(F.array(*map(F.lit, _HASHED))).alias("text")
    return read(spark, sf_dir, "nation").select("n_nationkey", texts).select("n_nationkey", "text", F.hex(cityhash128_col(F.col("text").cast("binary"))).alias("hash"))


@query(None)
def cityhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select("p_partkey", F.hex(cityhash128_col(F.col("p_name").cast("binary"))).alias("hash"))


@query("SELECT event_id, CASE WHEN value > 50 THEN value ELSE 'NaN'::DOUBLE END AS value FROM events")
def rows_f64n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").select("event_id", V.or_nan(F.when(F.col("value") > 50, F.col("value"))).alias("value"))


@query("SELECT l_orderkey % 10 AS bucket, CAST(CAST(sum(CAST(9223372036854775807 AS DECIMAL(20, 0)) + l_orderkey) AS DECIMAL(30, 0)) AS VARCHAR) AS total FROM lineitem GROUP BY 1")
def unsigned_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums of unsigned 64-bit values beyond the signed range."""
    wide = F.lit(9223372036854775807).cast("decimal(20,0)") + F.col("l_orderkey")
    return read(spark, sf_dir, "lineitem").groupBy((F.col("l_orderkey") % 10).alias("bucket")).agg(V.wide_sum(wide).cast("decimal(30,0)").cast("string").alias("total"))


# -- composites --------------------------------------------------------------------------------------------------------

plain(
    "array_range",
    "SELECT c_custkey, array_join(IF(c_custkey % 6 > 0, transform(sequence(0L, c_custkey % 6 - 1), x -> CAST(x * 2 AS INT)), CAST(array() AS ARRAY<INT>)), ',') AS items FROM {customer}",
    "SELECT c_custkey, array_to_string(list_transform(range(c_custkey % 6), lambda x: x * 2), ',') AS items FROM customer",
)
plain("array_element", "SELECT vec_id, element_at(embedding, 1) AS first, size(embedding) AS n FROM {embeddings}", "SELECT vec_id, embedding[1] AS first, CAST(len(embedding) AS INTEGER) AS n FROM embeddings")
plain(
    "map_pairs",
    "SELECT c_custkey, e.key, e.value FROM (SELECT c_custkey, explode(map_entries(map('name', c_name, 'segment', c_mktsegment))) AS e FROM {customer})",
    "SELECT c_custkey, e.key AS key, e.value AS value FROM (SELECT c_custkey, unnest(map_entries(MAP {'name': c_name, 'segment': c_mktsegment})) AS e FROM customer)",
)
plain("tuple_field", "SELECT t.c_name AS name, t.c_custkey AS key FROM (SELECT struct(c_name, c_custkey) AS t FROM {customer})", "SELECT c_name AS name, c_custkey AS key FROM customer")
plain("json_field", "SELECT event_id, get_json_object(props, '$.k') AS k FROM {events}", "SELECT event_id, props->>'$.k' AS k FROM events")


@query("SELECT event_type, count(*) AS n, CAST(dense_rank() OVER (ORDER BY event_type) - 1 AS INTEGER) AS code, 1 AS width FROM events GROUP BY event_type")
def dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dictionary codes and key width: the window runs over the distinct values only."""
    words = read(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n"))
    order = Window.orderBy("event_type")
    size = F.count("*").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    coded = words.select("event_type", "n", (F.dense_rank().over(order) - 1).alias("code"), size.alias("size"))
    return coded.select("event_type", "n", "code", V.key_width("size").alias("width"))


# -- aggregates, order, totals -----------------------------------------------------------------------------------------

plain(
    "hourly_fold",
    "SELECT unix_micros(CAST(ts AS TIMESTAMP)) div 3600000000 * 3600000 AS bucket, count(*) AS n, CAST(round(sum(value), 4) AS DOUBLE) AS total FROM {events} GROUP BY 1",
    "SELECT CAST(epoch_us(ts) // 3600000000 * 3600000 AS BIGINT) AS bucket, count(*) AS n, CAST(round(sum(value), 4) AS DOUBLE) AS total FROM events GROUP BY 1",
)
plain("seven_doubles", "SELECT l_orderkey, l_quantity, l_extendedprice, l_discount, l_tax, l_quantity * l_tax AS a, l_discount + l_tax AS b, l_extendedprice - l_discount AS c FROM {lineitem}")
plain(
    "totals",
    "SELECT l_returnflag, grouping(l_returnflag) AS is_total, count(*) AS n, CAST(sum(l_linenumber) AS BIGINT) AS lines FROM {lineitem} GROUP BY GROUPING SETS ((l_returnflag), ())",
    "SELECT l_returnflag, CAST(grouping(l_returnflag) AS TINYINT) AS is_total, count(*) AS n, CAST(sum(l_linenumber) AS BIGINT) AS lines FROM lineitem GROUP BY GROUPING SETS ((l_returnflag), ())",
)
plain("extremes", "SELECT min(l_quantity) AS q0, max(l_quantity) AS q1, min(l_orderkey) AS k0, max(l_orderkey) AS k1, min(l_shipdate) AS d0, max(l_shipdate) AS d1 FROM {lineitem}")
plain("top_prices", "SELECT o_orderkey, o_totalprice FROM {orders} ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 10")
plain("filtered_count", "SELECT count(*) AS n FROM {lineitem} WHERE l_quantity > 25 AND l_returnflag = 'R'")
plain("customer_sums", "SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS total, count(*) AS n FROM {orders} GROUP BY o_custkey")
plain(
    "pricing_summary",
    """SELECT l_returnflag, l_linestatus, CAST(round(sum(l_quantity), 2) AS DOUBLE) AS quantity, CAST(round(sum(l_extendedprice * (1 - l_discount)), 2) AS DOUBLE) AS revenue,
    CAST(round(avg(l_discount), 6) AS DOUBLE) AS discount, count(*) AS n FROM {lineitem} WHERE l_shipdate <= TIMESTAMP '1998-09-02 00:00:00' GROUP BY l_returnflag, l_linestatus""",
)

# -- what SQL text can ask for beyond --------------------------------------------------------------------------------------

plain(
    "region_revenue",
    """SELECT r_name, CAST(round(sum(l_extendedprice * (1 - l_discount)), 2) AS DOUBLE) AS revenue FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {customer} ON o_custkey = c_custkey
    JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey GROUP BY r_name""",
)
plain("customers_without_large_orders", "SELECT c_custkey, c_name FROM {customer} WHERE NOT EXISTS (SELECT 1 FROM {orders} WHERE o_custkey = c_custkey AND o_totalprice > 400000)")
plain("customers_with_large_orders", "SELECT c_custkey FROM {customer} WHERE c_custkey IN (SELECT o_custkey FROM {orders} WHERE o_totalprice > 200000)")
plain(
    "order_ranks",
    """SELECT o_orderkey, CAST(row_number() OVER w AS INTEGER) AS place, CAST(count(*) OVER (PARTITION BY o_custkey) AS BIGINT) AS n, coalesce(lag(o_orderkey) OVER w, -1) AS before FROM {orders}
    WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""",
)
plain("segments_cube", "SELECT coalesce(c_mktsegment, 'all') AS segment, coalesce(c_nationkey, -1) AS nation, count(*) AS n FROM {customer} GROUP BY CUBE (c_mktsegment, c_nationkey)")
plain("keys_in_both", "SELECT l_partkey AS k FROM {lineitem} INTERSECT SELECT p_partkey FROM {part} WHERE p_size > 10")
plain("keys_in_one", "SELECT p_partkey AS k FROM {part} EXCEPT SELECT l_partkey FROM {lineitem} WHERE l_quantity > 40")
plain(
    "promoted_share",
    "WITH p AS (SELECT p_partkey, p_type LIKE '%BRASS%' AS brass FROM {part}) SELECT brass, count(*) AS n, CAST(round(sum(l_extendedprice), 2) AS DOUBLE) AS price FROM {lineitem} JOIN p ON l_partkey = p_partkey GROUP BY brass",
)


@query("""SELECT e.event_id, coalesce(p.event_id, -1) AS purchase FROM (SELECT * FROM events WHERE event_type <> 'purchase') e ASOF LEFT JOIN
 (SELECT user_id, ts, max(event_id) AS event_id FROM events WHERE event_type = 'purchase' GROUP BY user_id, ts) p ON e.user_id = p.user_id AND e.ts >= p.ts""")
def last_purchase(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every event the user's last purchase at or before it, without a range join. Windows run over a user's day, and over the days of a user, one row each, to carry the
    last purchase on; so a user with very many events is spread over days."""
    events = read(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type", F.to_date("ts").alias("day"))
    bought = F.col("event_type") == "purchase"
    upto = Window.partitionBy("user_id", "day").orderBy("ts", F.when(bought, 0).otherwise(1), "event_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy("user_id").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    daily = events.groupBy("user_id", "day").agg(F.max(F.when(bought, F.struct("ts", "event_id")))["event_id"].alias("last"))
    carried = daily.select("user_id", "day", F.last("last", ignorenulls=True).over(before).alias("carried"))
    own = events.withColumn("purchase", F.last(F.when(bought, F.col("event_id")), ignorenulls=True).over(upto)).where(~bought)
    return own.join(carried, ["user_id", "day"]).select("event_id", F.coalesce("purchase", "carried", F.lit(-1)).alias("purchase"))
