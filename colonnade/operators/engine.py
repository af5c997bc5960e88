"""The engine: SQL text and expected columns in, typed blocks out; inserts of one or many blocks; settings, pings and errors."""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from py4j.protocol import Py4JJavaError
from pyspark import inheritable_thread_target
from pyspark.core.rdd import _load_from_socket
from pyspark.errors import PySparkException
from pyspark.serializers import NoOpSerializer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .. import types
from ..errors import QueryError, SchemaMismatchError, SettingError
from ..functions import sqlcompat
from ..sources.block import Block
from ..sources.columns import decode, encode
from ..sources.wire import Reader, Writer

MIN_SPARK = (4, 0)
#: Settings of the query surface, by the Spark setting that does the same.
SETTINGS = {"max_block_size": "spark.sql.execution.arrow.maxRecordsPerBatch", "max_threads": "spark.sql.shuffle.partitions", "session_timezone": "spark.sql.session.timeZone"}
BLOCK_ROWS = 65536


def parse_host_port(address: str, default: int = 9000) -> tuple[str, int]:
    """Host and port of ``host:port``; without a port, or with one that is no number, the default."""
    host, colon, port = address.rpartition(":")
    if not colon:
        return address, default
    return host, int(port) if port.isdigit() else default


@dataclass(frozen=True)
class EngineOptions:
    """How to get a session: master and application, current database, session settings."""

    master: str | None = None
    app: str = "colonnade"
    database: str = "default"
    block_rows: int = BLOCK_ROWS
    #: ``surface``: query text is rewritten by functions.sqlcompat first; ``spark``: it is Spark SQL as it stands.
    dialect: str = "surface"
    config: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Setting:
    """A setting of one query; an important one must be known."""

    key: str
    value: str
    important: bool = False


@dataclass(frozen=True)
class ResultColumn:
    """An expected column: its type, and its name unless any will do."""

    type: str
    name: str = ""


@dataclass(frozen=True)
class SelectQuery:
    """SQL text, expected columns (none: whatever comes) and what to call with each block.

    Totals (grand sums of the named columns) and extremes are taken while the data pass by and come after them, to callbacks of their own, so that they are
    told from data. ``on_progress`` is called after each block with what has come so far, ``on_profile`` at the end.
    """

    body: str
    results: Sequence[ResultColumn] = ()
    on_block: Callable[[Block], None] | None = None
    query_id: str = ""
    settings: Sequence[Setting] = ()
    args: dict[str, object] | None = None
    totals: Sequence[str] = ()
    extremes: bool = False
    on_totals: Callable[[Block], None] | None = None
    on_extremes: Callable[[Block], None] | None = None
    on_progress: Callable[[Progress], None] | None = None
    on_profile: Callable[[Profile], None] | None = None


@dataclass(frozen=True)
class Progress:
    """What has been read of a result so far, and how long that took."""

    rows: int
    bytes: int
    seconds: float


@dataclass(frozen=True)
class Profile(Progress):
    """A whole result."""

    blocks: int


@dataclass
class InputColumn:
    """A column to insert: a name, a type and the values of the next block."""

    name: str
    type: str
    values: list = field(default_factory=list)


@dataclass
class InsertQuery:
    """``INSERT INTO table [(columns)] [VALUES]`` and its columns. After each block ``on_input`` may refill them and return
    True for another."""

    body: str
    input: Sequence[InputColumn]
    on_input: Callable[[], bool] | None = None
    query_id: str = ""
    settings: Sequence[Setting] = ()


@dataclass(frozen=True)
class ServerInfo:
    name: str
    version: str
    time_zone: str
    database: str
    #: Host and port of the driver, and the version as one number.
    address: str = ""
    revision: int = 0


def _plain(kind: T.DataType) -> T.DataType:
    """A type without nullability inside, which Spark derives and nobody declares."""
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_plain(kind.elementType))
    if isinstance(kind, T.MapType):
        return T.MapType(_plain(kind.keyType), _plain(kind.valueType))
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _plain(f.dataType)) for f in kind.fields])
    return kind


def check_schema(schema: T.StructType, results: Sequence[ResultColumn]) -> list[types.TypeNode]:
    """The types of a result's columns, if they are the expected ones, in number, by name and by type."""
    if not results:
        return [types.of_spark(f.dataType, f.nullable, f.metadata) for f in schema.fields]
    if len(schema.fields) != len(results):
        raise SchemaMismatchError(f"the query has {len(schema.fields)} columns ({', '.join(schema.names)}), {len(results)} are expected")
    nodes = []
    for place, (found, want) in enumerate(zip(schema.fields, results, strict=True)):
        node = types.parse(want.type)
        if want.name and want.name != found.name:
            raise SchemaMismatchError(f"column {place} is {found.name!r}, not {want.name!r}")
        own = found.metadata.get(types.METADATA_KEY)
        fits = types.is_compatible(want.type, own) or types.is_compatible(want.type, f"Nullable({own})") if own else _plain(node.spark).simpleString() == _plain(found.dataType).simpleString()
        if not fits:
            server = str(types.of_spark(found.dataType, found.nullable, found.metadata))
            hint = types.mismatch_hint(want.type, server)
            raise SchemaMismatchError(f"column {found.name!r} is {server}, not {want.type}" + (f"; {hint}" if hint else ""))
        nodes.append(node)
    return nodes


def _ipc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each batch as one row of bytes."""
    for batch in batches:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batch.schema) as stream:
            stream.write_batch(batch)
        yield pa.RecordBatch.from_arrays([pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["ipc"])


def numbered(df: DataFrame) -> DataFrame:
    """Columns named by position, as a result may have several of one name."""
    return df.toDF(*(f"_{i}" for i in range(len(df.columns))))


#: Partitions that are fetched in the first job and in any one, and bytes of results that a job should stay below.
FIRST, FETCH, FETCH_BYTES = 4, 32, 1 << 28


def _fetched(df: DataFrame) -> Iterator[list[bytes]]:
    """The encoded batches of a result, some partitions at a time in partition order. Executors encode them, each job fetches several partitions, and the next
    job runs while the last one's are delivered. How many depends on the sizes seen so far, so that the driver holds about twice FETCH_BYTES, or two partitions."""
    spark = df.sparkSession
    context = spark.sparkContext
    encoded = df._jdf.toArrowBatchRdd().toJavaRDD()
    n = encoded.getNumPartitions()

    @inheritable_thread_target(spark)
    def job(lo: int, hi: int) -> list[bytes]:
        which = context._jvm.java.util.ArrayList()
        for i in range(lo, hi):
            which.add(i)
        return list(_load_from_socket(context._jvm.PythonRDD.runJob(context._jsc.sc(), encoded, which), NoOpSerializer()))

    with ThreadPoolExecutor(1) as one:
        lo, hi, largest = 0, min(FIRST, n), 1
        ahead = one.submit(job, lo, hi) if n else None
        while ahead is not None:
            try:
                got = ahead.result()
            except Exception as wrong:
                if hi - lo == 1 or "maxResultSize" not in str(wrong):
                    raise
                largest, hi = FETCH_BYTES, lo + 1
                ahead = one.submit(job, lo, hi)
                continue
            largest = max(largest, sum(map(len, got)) // (hi - lo))
            lo, hi = hi, min(n, hi + max(1, min(FETCH, FETCH_BYTES // largest)))
            ahead = one.submit(job, lo, hi) if lo < n else None
            yield got


def arrow_batches(df: DataFrame) -> Iterator[pa.RecordBatch]:
    """The non-empty Arrow batches of a result, in partition order; the driver holds a few partitions at a time."""
    df = numbered(df)
    if not hasattr(df, "_jdf"):  # a remote session, whose partitions come one by one
        for row in df.mapInArrow(_ipc, "ipc binary").toLocalIterator(prefetchPartitions=True):
            with pa.ipc.open_stream(bytes(row["ipc"])) as stream:
                yield from (batch for batch in stream if batch.num_rows)
        return
    large = df.sparkSession.conf.get("spark.sql.execution.arrow.useLargeVarTypes", "false") == "true"
    schema = to_arrow_schema(df.schema, prefers_large_types=large)
    for got in _fetched(df):
        for part in got:
            batch = pa.ipc.read_record_batch(pa.py_buffer(part), schema)
            if batch.num_rows:
                yield batch


class Engine:
    """A session that runs queries. Safe to share between threads, as the session is; a query's settings hold while it runs."""

    def __init__(self, spark: SparkSession, options: EngineOptions | None = None):
        self.spark, self.options = spark, options or EngineOptions()
        sqlcompat.register(spark)

    @classmethod
    def connect(cls, options: EngineOptions | None = None) -> Engine:
        options = options or EngineOptions()
        builder = SparkSession.builder.appName(options.app)
        if options.master:
            builder = builder.master(options.master)
        for key, value in {"spark.sql.session.timeZone": "UTC", "spark.sql.mapKeyDedupPolicy": "LAST_WIN", **options.config}.items():
            builder = builder.config(key, value)
        spark = builder.getOrCreate()
        version = tuple(int(x) for x in re.findall(r"\d+", spark.version)[:2])
        if version < MIN_SPARK:
            raise QueryError(f"Spark {spark.version} is too old")
        spark.catalog.setCurrentDatabase(options.database)
        return cls(spark, options)

    def ping(self) -> None:
        """Runs the least of jobs; raises what goes wrong."""
        with self._told("ping"):
            self.spark.range(1).count()

    @property
    def server(self) -> ServerInfo:
        host, port = (self.spark.conf.get(f"spark.driver.{x}", "") for x in ("host", "port"))
        numbers = [int(x) for x in re.findall(r"\d+", self.spark.version)[:3]]
        return ServerInfo("Apache Spark", self.spark.version, self.spark.conf.get("spark.sql.session.timeZone"), self.spark.catalog.currentDatabase(), f"{host}:{port}" if port else host, sum(n * 1000**i for i, n in enumerate(reversed(numbers))))

    def close(self) -> None:
        self.spark.stop()

    def __enter__(self) -> Engine:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()

    # -- queries ------------------------------------------------------------------------------------------------------

    @contextmanager
    def _told(self, query_id: str) -> Iterator[None]:
        """Spark's errors as QueryError, with their causes."""
        try:
            yield
        except PySparkException as wrong:
            raise QueryError(f"query {query_id}: {wrong}", wrong.getCondition() or "", wrong.getSqlState() or "") from wrong
        except Py4JJavaError as wrong:  # such as of a job that was cancelled
            raise QueryError(f"query {query_id}: {wrong.java_exception.getMessage()}") from wrong

    @contextmanager
    def _set(self, settings: Sequence[Setting]) -> Iterator[None]:
        """The settings of a query, and back."""
        conf, before = self.spark.conf, {}
        try:
            for s in settings:
                key = SETTINGS.get(s.key, s.key)
                if self._known(s):
                    before.setdefault(key, conf.get(key, None))
                    conf.set(key, s.value)
            yield
        finally:
            for key, value in before.items():
                if value is None:
                    conf.unset(key)
                else:
                    conf.set(key, value)

    @contextmanager
    def _query(self, query_id: str, settings: Sequence[Setting]) -> Iterator[str]:
        query_id = query_id or str(uuid.uuid4())
        self.spark.addTag(query_id)
        # The jobs that fetch results belong to no action of the session, so they bear the tag as jobs.
        context = getattr(self.spark, "sparkContext", None) if hasattr(self.spark, "_jsparkSession") else None
        if context is not None:
            context.addJobTag(query_id)
        try:
            with self._told(query_id), self._set([Setting("max_block_size", str(self.options.block_rows)), *settings]):
                yield query_id
        finally:
            self.spark.removeTag(query_id)
            if context is not None:
                context.removeJobTag(query_id)

    def cancel(self, query_id: str) -> None:
        """Stops the jobs of a query that runs in another thread."""
        self.spark.interruptTag(query_id)
        if hasattr(self.spark, "_jsparkSession"):
            self.spark.sparkContext.cancelJobsWithTag(query_id)

    def _text(self, body: str) -> str:
        return body if self.options.dialect == "spark" else sqlcompat.translate(body)

    def _settings(self, body: str, settings: Sequence[Setting]) -> list[Setting]:
        """The settings of a query and of its SETTINGS clause."""
        own = {} if self.options.dialect == "spark" else sqlcompat.settings_of(body)[1]
        return [*settings, *(Setting(k, v) for k, v in own.items())]

    def frame(self, query: SelectQuery) -> DataFrame:
        """A query as a DataFrame, its columns checked; nothing runs yet. Settings hold while ``select``, ``blocks`` and the streams run a query; a DataFrame runs
        later, under the session's. An important setting that the session does not know is an error here, too."""
        for s in self._settings(query.body, query.settings):
            self._known(s)
        body = self._text(query.body)
        df = self.spark.sql(body, query.args) if query.args else self.spark.sql(body)
        check_schema(df.schema, query.results)
        return df

    def _known(self, s: Setting) -> bool:
        if s.key in SETTINGS or self.spark.conf.get(s.key, None) is not None:
            return True
        if s.important:
            raise SettingError(f"the session does not know the setting {s.key!r}")
        return False

    def blocks(self, query: SelectQuery) -> Iterator[Block]:
        """The non-empty blocks of a result. A null in a column that was declared without nulls is an error."""
        yield from (block for block, _ in self._blocks(query))

    def _blocks(self, query: SelectQuery, begin: Callable[[DataFrame], None] = lambda df: None) -> Iterator[tuple[Block, pa.RecordBatch]]:
        with self._query(query.query_id, self._settings(query.body, query.settings)):
            df = self.frame(query)
            begin(df)
            nodes = check_schema(df.schema, query.results)
            names = df.schema.names
            for batch in arrow_batches(df):
                yield self._block(batch, names, nodes, bool(query.results)), batch

    @staticmethod
    def _block(batch: pa.RecordBatch, names: list[str], nodes: list[types.TypeNode], declared: bool) -> Block:
        for name, node, values in zip(names, nodes, batch.columns, strict=True):
            if declared and values.null_count and not node.nullable:
                raise SchemaMismatchError(f"column {name!r} has nulls: " + types.mismatch_hint(str(node), f"Nullable({node})"))
        values = [c.to_pylist() if c.null_count or pa.types.is_nested(c.type) or pa.types.is_decimal(c.type) or not pa.types.is_primitive(c.type) or pa.types.is_temporal(c.type) else c.to_numpy(zero_copy_only=False) for c in batch.columns]
        return Block(names, nodes, values, batch.num_rows)

    def select(self, query: SelectQuery) -> int:
        """Runs a query, calls ``on_block`` with every non-empty block, and returns the number of rows. Statements without a result
        give 0."""
        rows = size = blocks = 0
        ends: list[_Ends] = []
        began = time.monotonic()
        for block, batch in self._blocks(query, lambda df: ends.append(_Ends(df, query))):
            rows, size, blocks = rows + block.rows, size + batch.nbytes, blocks + 1
            ends[0].add(batch)
            if query.on_block:
                query.on_block(block)
            if query.on_progress:
                query.on_progress(Progress(rows, size, time.monotonic() - began))
        if query.on_totals and query.totals:
            query.on_totals(ends[0].totals())
        if query.on_extremes and query.extremes:
            query.on_extremes(ends[0].extremes())
        if query.on_profile:
            query.on_profile(Profile(rows, size, time.monotonic() - began, blocks))
        return rows

    def table_columns(self, table: str) -> list[InputColumn]:
        """The columns of a table, by name and type, ready to be filled and inserted."""
        return [InputColumn(f.name, str(types.of_spark(f.dataType, f.nullable, f.metadata))) for f in self.spark.table(table).schema.fields]

    def execute(self, body: str, settings: Sequence[Setting] = (), query_id: str = "") -> None:
        """Runs a statement without a result, such as CREATE or DROP."""
        with self._query(query_id, self._settings(body, settings)):
            self.spark.sql(self._text(body)).collect()

    def insert(self, query: InsertQuery) -> int:
        """Appends the columns' values as blocks, each committed on its own, and returns the number of rows.

        The table's columns are checked against the declared ones before anything is written; columns of unequal lengths are an error.
        """
        table, columns = parse_insert(query.body)
        with self._query(query.query_id, query.settings):
            target = self.spark.table(table).schema
            names = columns or ([c.name for c in query.input] if all(c.name for c in query.input) else target.names)
            if len(names) != len(query.input):
                raise SchemaMismatchError(f"{len(names)} columns of {table} named, {len(query.input)} given")
            if unknown := [n for n in names if n not in target.names]:
                raise SchemaMismatchError(f"{table} has no columns {unknown}")
            check_schema(T.StructType([target[n] for n in names]), [ResultColumn(c.type) for c in query.input])
            rows = 0
            while True:
                rows += self._append(table, target, names, query.input)
                if query.on_input is None or not query.on_input():
                    return rows

    def _append(self, table: str, target: T.StructType, names: list[str], columns: Sequence[InputColumn]) -> int:
        sizes = {len(c.values) for c in columns}
        if len(sizes) != 1:
            raise SchemaMismatchError(f"columns of different lengths: {sorted(sizes)}")
        if not (n := sizes.pop()):
            return 0
        checked = [self._through_codec(c) for c in columns]
        schema = T.StructType([T.StructField(name, target[name].dataType, True) for name in names])
        flat = all(not isinstance(f.dataType, T.ArrayType | T.MapType | T.StructType | T.DayTimeIntervalType | T.YearMonthIntervalType | T.TimestampType) for f in schema.fields)
        block = self.spark.createDataFrame(pa.table([pa.array(v, f.type) for v, f in zip(checked, to_arrow_schema(schema), strict=True)], to_arrow_schema(schema)) if flat else list(zip(*checked, strict=True)), schema)
        missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in target.fields if f.name not in names]
        block.select("*", *missing).select(target.names).write.insertInto(table)
        return n

    @staticmethod
    def _through_codec(column: InputColumn) -> Sequence:
        """The values as the column's type holds them: rounded, truncated or refused as it does. They go on as arrays, and as rows only where they are nested."""
        node, out = types.parse(column.type), Writer()
        encode(node, column.values, out)
        values = decode(node, Reader(out.take()), len(column.values))
        values = values if isinstance(values, list) else values.tolist()
        return [dict(v) if node.name == "Map" else v for v in values]


class _Ends:
    """Sums of some columns, and the least and largest values of all, of a result that passes by. Nulls do not count, nor do NaNs for extremes unless there is nothing else."""

    def __init__(self, df: DataFrame, query: SelectQuery):
        self.names = df.schema.names
        self.sums = {c: None for c in query.totals} if query.on_totals else {}
        if unknown := [c for c in self.sums if c not in self.names]:
            raise SchemaMismatchError(f"no columns {unknown} to total")
        self.ends: list[list] | None = [[None, None] for _ in self.names] if query.extremes and query.on_extremes else None
        summed = df.agg(*(F.sum(c) for c in self.sums)).schema.fields if self.sums else []
        self.sum_types = [types.of_spark(f.dataType, True, f.metadata) for f in summed]
        self.types = [types.of_spark(f.dataType, True, f.metadata) for f in df.schema.fields]

    def add(self, batch: pa.RecordBatch) -> None:
        for name, held in self.sums.items():
            values = batch.column(self.names.index(name)).drop_null()
            if len(values):
                self.sums[name] = _whole_sum(values) + (held or 0)
        for ends, values in zip(self.ends or (), batch.columns, strict=False):
            values = values.drop_null()
            if not len(values):
                continue
            if pa.types.is_nested(values.type):
                listed = values.to_pylist()
                found = [f(listed, key=repr) if pa.types.is_map(values.type) or pa.types.is_struct(values.type) else f(listed) for f in (min, max)]
            else:
                found = list(pc.min_max(values).as_py().values())
            for k, f in enumerate((min, max)):
                ends[k] = found[k] if ends[k] is None or ends[k] != ends[k] else f(ends[k], found[k])

    def totals(self) -> Block:
        return Block(list(self.sums), self.sum_types, [[v] for v in self.sums.values()], 1)

    def extremes(self) -> Block:
        return Block(self.names, self.types, self.ends or [], 2)


def _whole_sum(values: pa.Array) -> object:
    """A sum that does not overflow: integers in two halves, decimals as wide ones."""
    if pa.types.is_integer(values.type):
        x = values.to_numpy(zero_copy_only=False).astype(np.int64)
        return (int((x >> 32).sum()) << 32) + int((x & 0xFFFFFFFF).sum())
    if pa.types.is_decimal(values.type):
        return pc.sum(values.cast(pa.decimal256(76, values.type.scale))).as_py()
    return pc.sum(values).as_py()


_INSERT = re.compile(r"\s*INSERT\s+INTO\s+(?:TABLE\s+)?(?P<table>`[^`]+`(?:\.`[^`]+`)*|[\w.]+)\s*(?:\((?P<columns>[^)]*)\))?\s*(?:VALUES|FORMAT\s+\w+)?\s*;?\s*", re.I)


def parse_insert(body: str) -> tuple[str, list[str]]:
    """Table and columns of an insert statement without rows."""
    found = _INSERT.fullmatch(body)
    if not found:
        raise QueryError(f"no insert statement: {body!r}")
    columns = [c.strip().strip("`") for c in (found["columns"] or "").split(",") if c.strip()]
    return found["table"], columns


__all__ = ["BLOCK_ROWS", "Engine", "EngineOptions", "InputColumn", "InsertQuery", "Profile", "Progress", "ResultColumn", "SelectQuery", "ServerInfo", "Setting", "arrow_batches", "check_schema", "numbered", "parse_host_port", "parse_insert"]
