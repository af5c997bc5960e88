from __future__ import annotations

import datetime as dt
import threading
import time
import uuid
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pytest
from pyspark.errors import PySparkException

from colonnade import types
from colonnade.errors import DrainOverflowError, EngineError, QueryError, SchemaMismatchError, SettingError
from colonnade.operators import drain, retry
from colonnade.operators.engine import Engine, EngineOptions, InputColumn, InsertQuery, ResultColumn, SelectQuery, Setting, parse_host_port, parse_insert
from colonnade.plans.registry import EVENT_TYPES, TYPED, typed_events
from colonnade.sources import native_block
from colonnade.streaming import stream


@pytest.fixture(scope="module")
def engine(spark):
    return Engine(spark)


@pytest.fixture
def table(spark):
    name = f"t_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {name} (id INT, name STRING, score DOUBLE) USING parquet")
    yield name
    spark.sql(f"DROP TABLE {name}")


def collected(engine, text, **more):
    out = []
    engine.select(SelectQuery(text, on_block=out.append, **more))
    return out


def test_addresses_and_server(engine):
    assert [parse_host_port(x) for x in ("h:1", "h", "h:", "h:x", "a:b:2")] == [("h", 1), ("h", 9000), ("h", 9000), ("h", 9000), ("a:b", 2)]
    engine.ping()
    assert engine.server.time_zone == "UTC" and engine.server.database == "default"


def test_select_checks_columns(engine):
    blocks = collected(engine, "SELECT number AS n, toString(number) AS s FROM numbers(10)", results=[ResultColumn("Int64", "n"), ResultColumn("String")])
    assert sum(b.rows for b in blocks) == 10 and sorted(x for b in blocks for x in b.values[0].tolist()) == list(range(10))
    for results, said in (([ResultColumn("Int32"), ResultColumn("String")], "Int64, not Int32"), ([ResultColumn("Int64")], "2 columns"), ([ResultColumn("Int64", "x"), ResultColumn("String")], "not 'x'"), ([ResultColumn("Int64")] * 3, "3 are expected")):
        with pytest.raises(SchemaMismatchError, match=said):
            collected(engine, "SELECT number AS n, toString(number) AS s FROM numbers(10)", results=results)
    with pytest.raises(SchemaMismatchError, match="Nullable"):
        collected(engine, "SELECT if(number = 3, NULL, number) AS n FROM numbers(10)", results=[ResultColumn("Int64")])
    assert collected(engine, "SELECT number FROM numbers(0)", results=[ResultColumn("Int64")]) == []


def events(spark, n):
    kinds = list(EVENT_TYPES)
    rows = [(i, dt.datetime(2024, 1, 1 + i % 28, i % 24), 7 * i, kinds[i % 5], 3.125 * i, f'{{"k": {i}}}') for i in range(n)]
    return spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")


def test_typed_columns_keep_their_strings(engine, spark):
    rows = events(spark, 40).coalesce(1)
    frame = rows.select(*typed_events(rows))
    frame.createOrReplaceTempView("typed_view")
    (block, *_) = collected(engine, "SELECT * FROM typed_view", results=[ResultColumn(t, n) for n, t in TYPED.items()])
    assert {f.name: str(types.of_spark(f.dataType, False, f.metadata)) for f in frame.schema.fields} == TYPED
    row = dict(zip(block.names, [v[35] for v in block.values], strict=True))
    assert row["amount"] == Decimal("109.37") and row["code"] == "click" and row["since"] == dt.timedelta(7) and row["tag"] == b"click\0\0\0" and row["large"] == 109 and row["rough"] == 109.5


def test_settings(engine, spark):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    blocks = collected(engine, "SELECT number FROM numbers(1000) SETTINGS max_block_size = 100")
    assert max(b.rows for b in blocks) <= 100 and spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before
    assert collected(engine, "SELECT 1 AS x", settings=[Setting("nobody_knows", "1")])
    with pytest.raises(SettingError):
        collected(engine, "SELECT 1 AS x", settings=[Setting("nobody_knows", "1", important=True)])


def test_totals_and_extremes_are_apart(engine):
    seen = {}
    rows = engine.select(SelectQuery("SELECT number AS n FROM numbers(10)", on_totals=lambda b: seen.update(t=b.values[0]), totals=["n"], extremes=True, on_extremes=lambda b: seen.update(e=b.values[0])))
    assert rows == 10 and list(seen["t"]) == [45] and list(seen["e"]) == [0, 9]


def test_totals_come_with_the_data(engine, spark):
    """The query runs once: a value that differs from run to run is totalled as it was delivered."""
    seen, told = [], {}
    text = "SELECT rand() AS r, number AS n, if(number % 3 = 0, NULL, number * 0.25D) AS x, CAST(number AS DECIMAL(20, 2)) AS d, toString(number) AS s, array(number) AS a FROM numbers(1000) SETTINGS max_block_size = 64"
    progress, profile = [], []
    engine.select(SelectQuery(text, on_block=seen.append, totals=["r", "n", "x", "d"], extremes=True, on_totals=lambda b: told.update(t=b), on_extremes=lambda b: told.update(e=b), on_progress=progress.append, on_profile=profile.append))
    column = lambda i: [v for b in seen for v in (b.values[i].tolist() if isinstance(b.values[i], np.ndarray) else b.values[i]) if v is not None]
    assert [v[0] for v in told["t"].values] == [pytest.approx(sum(column(0))), 499500, pytest.approx(sum(column(2))), Decimal("499500.00")]
    assert [str(t) for t in told["t"].types] == ["Nullable(Float64)", "Nullable(Int64)", "Nullable(Float64)", "Nullable(Decimal(30, 2))"]
    assert told["e"].values == [[min(column(i)), max(column(i))] for i in range(6)]
    assert profile[0].rows == progress[-1].rows == 1000 and profile[0].blocks == len(seen) == len(progress) and profile[0].bytes == progress[-1].bytes > 8000
    with pytest.raises(SchemaMismatchError):
        engine.select(SelectQuery("SELECT 1 AS x", totals=["y"], on_totals=print))
    engine.select(SelectQuery("SELECT number AS n FROM numbers(0)", totals=["n"], extremes=True, on_totals=lambda b: told.update(t=b), on_extremes=lambda b: told.update(e=b)))
    assert told["t"].values == [[None]] and told["e"].values == [[None, None]]


def test_json_is_checked(engine):
    assert collected(engine, """SELECT CAST('{"a": [1,  2]}' AS JSON) AS j""")[0].values[0] == ['{"a":[1,2]}']
    with pytest.raises(QueryError):
        collected(engine, "SELECT CAST('{a' AS JSON) AS j")


def test_server_and_table_columns(engine, table):
    assert engine.server.address and engine.server.revision >= 4_000_000
    assert [(c.name, c.type) for c in engine.table_columns(table)] == [("id", "Nullable(Int32)"), ("name", "Nullable(String)"), ("score", "Nullable(Float64)")]
    with pytest.raises(SettingError):
        engine.frame(SelectQuery("SELECT 1 AS x", settings=[Setting("nobody_knows", "1", important=True)]))


def test_errors_keep_cause_and_condition(engine):
    with pytest.raises(QueryError) as wrong:
        engine.select(SelectQuery("SELECT nothing FROM nowhere"))
    assert wrong.value.condition == "TABLE_OR_VIEW_NOT_FOUND" and wrong.value.sql_state == "42P01" and wrong.value.__cause__ is not None
    with pytest.raises(QueryError):
        engine.select(SelectQuery("SELECT 1 / 0 AS x FROM numbers(1) WHERE assumeNotNull(NULL) = 1"))


def test_inserts(engine, spark, table):
    columns = [InputColumn("id", "Int32", [1, 2]), InputColumn("name", "String", ["alpha", None]), InputColumn("score", "Float64", [1.5, 2.5])]
    left = [[([3], ["gamma"], [3.5])], []]
    rounds = iter(left[0])

    def more():
        for values in rounds:
            for c, v in zip(columns, values, strict=True):
                c.values = v
            return True
        return False

    assert engine.insert(InsertQuery(f"INSERT INTO {table} VALUES", columns, more)) == 3
    assert sorted(map(tuple, spark.table(table).collect())) == [(1, "alpha", 1.5), (2, "", 2.5), (3, "gamma", 3.5)]
    assert engine.insert(InsertQuery(f"INSERT INTO {table} (score, id)", [InputColumn("score", "Float64", [9.0]), InputColumn("id", "Int32", [9])])) == 1
    assert tuple(spark.sql(f"SELECT * FROM {table} WHERE id = 9").first()) == (9, None, 9.0)
    for columns in ([InputColumn("id", "Int64", [1])], [InputColumn("nope", "Int32", [1])], [InputColumn("id", "Int32", [1]), InputColumn("score", "Float64", [])]):
        with pytest.raises((SchemaMismatchError, QueryError)):
            engine.insert(InsertQuery(f"INSERT INTO {table}", columns))
    assert parse_insert("insert into `a`.`b` (x, `y`) VALUES;") == ("`a`.`b`", ["x", "y"])


def test_ddl_on_the_surface(engine, spark):
    name = f"c_{uuid.uuid4().hex}"
    engine.execute(f"CREATE TABLE {name} (id Int32, tags Array(String), score Nullable(Float64)) ENGINE = Memory")
    engine.execute(f"INSERT INTO {name} VALUES (1, array('a'), NULL)")
    assert spark.table(name).count() == 1
    engine.execute(f"DROP TABLE IF EXISTS {name}")


def test_streams(engine):
    rows, blocks = [], []
    stream.rows_i64f64n(engine, "SELECT number, if(number = 1, NULL, toFloat64(number)) FROM numbers(3)", lambda n, x: rows.append((n, x)))
    assert [r[0] for r in sorted(rows)] == [0, 1, 2] and np.isnan(sorted(rows)[1][1])
    stream.blocks_i64f64(engine, "SELECT number, toFloat64(number) FROM numbers(100)", lambda n, x: blocks.append((n.sum(), x.sum(), n.dtype, x.dtype)))
    assert sum(b[0] for b in blocks) == 4950 == sum(b[1] for b in blocks) and blocks[0][2:] == (np.int64, np.float64)
    got = []
    stream.rows_i64a64a64(engine, "SELECT number, array(toFloat64(number), 1.5D), CAST(array() AS ARRAY<DOUBLE>) FROM numbers(2)", lambda n, a, b: got.append((n, a.tolist(), b.tolist())))
    assert sorted(got) == [(0, [0.0, 1.5], []), (1, [1.0, 1.5], [])]
    with pytest.raises(SchemaMismatchError):
        stream.rows_i64(engine, "SELECT if(number = 1, NULL, number) FROM numbers(3)", lambda n: None)
    with pytest.raises(SchemaMismatchError):
        stream.rows_i64(engine, "SELECT toFloat64(number) FROM numbers(3)", lambda n: None)
    assert stream.fold(engine, "SELECT number FROM numbers(1000)", ["Int64"], 0, lambda held, a: held + int(a.sum()), lambda a, b: a + b) == 499500
    assert len(stream.ROW_SHAPES) == 16 and len(stream.BLOCK_SHAPES) == 12
    assert all(hasattr(stream, f"rows_{s}") and hasattr(retry, f"rows_{s}") for s in stream.ROW_SHAPES) and all(hasattr(stream, f"blocks_{s}") and hasattr(retry, f"blocks_{s}") for s in stream.BLOCK_SHAPES)
    held = []
    stream.columns(engine, SelectQuery("SELECT number FROM numbers(5)", [ResultColumn("Int64")]), held.append)
    assert sum(b.rows for b in held) == 5


def test_partitions_are_folded_together(engine):
    def slow(held, a):
        time.sleep(1.5)
        return held + len(a)

    stream.fold(engine, "SELECT number FROM numbers(4)", ["Int64"], 0, lambda held, a: held + len(a), lambda a, b: a + b)
    began = time.monotonic()
    assert stream.fold(engine, "SELECT /*+ REPARTITION(4) */ number FROM numbers(4)", ["Int64"], 0, slow, lambda a, b: a + b) == 4
    assert time.monotonic() - began < 5


@pytest.mark.parametrize("first, fetch, size", [(1, 1, 1 << 28), (2, 3, 1 << 28), (4, 32, 1)])
def test_results_come_in_partition_order(engine, monkeypatch, first, fetch, size):
    from colonnade.operators import engine as module

    for name, value in (("FIRST", first), ("FETCH", fetch), ("FETCH_BYTES", size)):
        monkeypatch.setattr(module, name, value)
    found = []
    stream.blocks_i64(engine, "SELECT id FROM range(0, 100000, 1, 9) SETTINGS max_block_size = 1000", lambda a: found.append(a))
    assert np.array_equal(np.concatenate(found), np.arange(100000)) and max(map(len, found)) <= 1000
    stream.blocks_i64(engine, "SELECT number FROM numbers(0)", lambda a: pytest.fail("no rows"))


def test_a_running_query_is_cancelled(engine):
    threading.Timer(2, lambda: engine.cancel("endless")).start()
    with pytest.raises(QueryError):
        engine.select(SelectQuery("SELECT count(*) AS n FROM range(10000000000) a JOIN range(100000) b ON a.id % 7 = b.id % 7", query_id="endless"))


def test_drain(engine):
    ids, values = drain.IntoArray(np.zeros(12, np.int64)), drain.IntoArray(np.zeros(12))
    frontier = []
    assert drain.drain(engine, "SELECT number, toFloat64(number) FROM numbers(10)", [ids, values], frontier.append) == 10
    assert ids.rows == 10 == frontier[-1] and sorted(ids.filled.tolist()) == list(range(10)) and ids.filled.base is ids.array and values.item_size == 8
    with pytest.raises(DrainOverflowError):
        drain.drain(engine, "SELECT number, toFloat64(number) FROM numbers(10)", [ids, values])
    assert 10 <= ids.rows == values.rows <= 12
    ids.reset()
    assert ids.rows == 0 and ids.array[:10].any()
    ids.put(pa.array([], pa.int64()))
    with pytest.raises(EngineError):
        drain.IntoArray(np.zeros(3, "U3"))
    with pytest.raises(EngineError):
        ids.encode()
    (wide,) = drain.count_then_drain(engine, "SELECT CAST(18446744073709551615 AS DECIMAL(20, 0)) AS x", ["uint64"])
    assert wide.tolist() == [2**64 - 1]


def attempts(outcomes, policy=retry.RetryPolicy(), touch=False):
    slept, tried = [], []

    def attempt(gate):
        tried.append(1)
        if touch:
            gate.touch()
        outcome = outcomes[min(len(tried), len(outcomes)) - 1]
        if isinstance(outcome, Exception):
            raise outcome
        return outcome

    try:
        result = retry.run_attempts(policy, attempt, slept.append)
    except Exception as error:
        result = error
    return result, len(tried), slept


def test_retries():
    lost = ConnectionError()
    assert attempts([lost, lost, "done"]) == ("done", 3, [1.0, 2.0])
    assert attempts([lost]) == (lost, 5, [1.0, 2.0, 4.0, 8.0])
    assert attempts([lost], touch=True) == (lost, 1, [])
    assert attempts([lost], retry.RetryPolicy(max_attempts=1)) == (lost, 1, [])
    wrong = ValueError()
    assert attempts([wrong]) == (wrong, 1, [])
    query = QueryError("x")
    query.__cause__ = TimeoutError()
    assert retry.is_retryable(query) and not retry.is_retryable(QueryError("y"))
    for kind in (TimeoutError, EOFError, BrokenPipeError, OSError):
        assert retry.is_retryable(kind())
    assert not retry.is_retryable(FileNotFoundError())


def test_no_retry_after_a_row(engine):
    seen, connected = [], []

    def connect(_):
        connected.append(1)
        return engine

    def action(n):
        seen.append(n)
        raise ConnectionError

    with pytest.raises(ConnectionError):
        retry.rows_i64(EngineOptions(), retry.RetryPolicy(), "SELECT number FROM numbers(5)", action, connect=connect, sleep=lambda s: None)
    assert len(seen) == len(connected) == 1


@pytest.mark.parametrize("compression", ["none", "lz4", "zstd"])
def test_block_files(spark, tmp_path, compression):
    from pyspark.sql import functions as F

    spark.dataSource.register(native_block.NativeBlockSource)
    path = str(tmp_path / "blocks")
    kinds = {**TYPED, "id": "UUID", "six": "IPv6", "d": "Date32", "t": "DateTime64(6)", "u": "UInt64", "q": "IntervalMonth"}
    rows = events(spark, 50).repartition(3)
    frame = rows.select(*typed_events(rows), F.lit("00010203-0405-0607-0809-0a0b0c0d0e0f").alias("id"), F.lit("::1").alias("six"), F.lit(dt.date(1950, 1, 2)).alias("d"), F.lit(dt.datetime(2001, 2, 3, 4, 5, 6, 7)).alias("t"), F.col("event_id").cast("decimal(20,0)").alias("u"), F.col("event_id").alias("q"))
    import json

    frame.write.format("native_block").option("compression", compression).option("block_rows", 7).option("types", json.dumps({k: kinds[k] for k in ("id", "six", "d", "t", "u", "q")})).mode("append").save(path)
    back = spark.read.format("native_block").load(path)
    assert {f.name: str(types.of_spark(f.dataType, False, f.metadata)) for f in back.schema.fields if f.name not in ("caption", "actor")} == {k: v for k, v in kinds.items() if k not in ("caption", "actor")}
    key = lambda r: r["actor"]
    assert sorted(back.collect(), key=key) == sorted(frame.collect(), key=key)
    few = spark.read.format("native_block").schema("caption string, rough float").load(path)
    assert few.count() == 50 and few.agg(F.sum("rough")).first()[0] == frame.agg(F.sum("rough")).first()[0]
    assert native_block.read_blocks_anywhere(spark, path, {"actor": "Int32", "kind": "LowCardinality(String)"}).count() == 50
    with pytest.raises(PySparkException, match="a null in a column"):
        frame.select(F.lit(None).cast("string").alias("id")).write.format("native_block").option("types", '{"id": "UUID"}').mode("append").save(path)
    assert spark.read.format("native_block").load(path).count() == 50
    frame.limit(0).write.format("native_block").mode("overwrite").option("types", json.dumps({k: kinds[k] for k in ("id", "six", "d", "t", "u", "q")})).save(path)
    assert spark.read.format("native_block").load(path).count() == 0
