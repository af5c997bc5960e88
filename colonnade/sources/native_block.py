"""The ``native_block`` data source: tables in files of blocks.

    spark.dataSource.register(NativeBlockSource)
    df.write.format("native_block").option("compression", "lz4").mode("append").save(folder)
    spark.read.format("native_block").load(folder)

A folder holds one file for each task that wrote rows; a file is a series of blocks (each in a checksummed frame, if compressed) and ends with an
empty block. Files are read in parallel, blocks one after another; only the columns of the given schema are decoded, others are passed over. A file
appears under its name only when the whole write is committed.

Options: ``path``; ``compression`` (none, lz4, zstd; read from the file's name when reading); ``block_rows`` (65536); ``types``, a JSON object of type
strings by column for the writer, where the schema's metadata does not name them.

The folder must be one that driver and executors share. ``read_blocks_anywhere`` reads files from any store that Spark reads.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema

from .. import types
from ..errors import CodecError
from .block import Block, decode_block, empty_block, encode_block, read_blocks
from .columns import NUMBERS
from .frames import METHODS, decode_frame, encode_frame
from .wire import Reader

SUFFIX = ".blocks"


def storage_type(node: types.TypeNode) -> T.DataType:
    """The Spark type of a column in this source: months are counts, as Spark has no Python values for them."""
    return T.LongType() if types.INTERVALS.get(node.name, ("",))[0] == "month" else node.spark


def storage_schema(names: list[str], kinds: list[types.TypeNode]) -> T.StructType:
    fields = []
    for name, kind in zip(names, kinds, strict=True):
        plain = kind.field(name)
        fields.append(T.StructField(name, storage_type(kind), plain.nullable, plain.metadata))
    return T.StructType(fields)


def to_batch(block: Block, schema: pa.Schema) -> pa.RecordBatch:
    """A block's columns by the names of an Arrow schema."""
    at = {name: i for i, name in enumerate(block.names)}
    if missing := [f.name for f in schema if f.name not in at]:
        raise CodecError(f"the block has no columns {missing}")
    values = [(f, block.values[at[f.name]]) for f in schema]
    return pa.RecordBatch.from_arrays([pa.array(v.tolist() if pa.types.is_decimal(f.type) and isinstance(v, np.ndarray) else v, f.type) for f, v in values], schema=schema)


def compression_of(path: str) -> str:
    """What a file's name says: part.lz4.blocks is compressed, part.blocks is not."""
    kind = path.removesuffix(SUFFIX).rpartition(".")[2]
    return kind if kind in METHODS else "none"


def files(path: str) -> list[str]:
    path = path.removeprefix("file://") if path.startswith("file://") else path.removeprefix("file:")
    if os.path.isfile(path):
        return [path]
    return sorted(os.path.join(path, f) for f in os.listdir(path) if f.endswith(SUFFIX) and not f.startswith(("_", ".")))


def header(path: str) -> Block:
    """The first block of a file, of which only names and types are of interest."""
    with open(path, "rb") as file:
        reader = Reader(file.read())
    return decode_block(Reader(decode_frame(reader)) if compression_of(path) != "none" else reader)


@dataclass
class FilePartition(InputPartition):
    path: str


class BlockReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict[str, str]):
        self.schema, self.options = schema, options

    def partitions(self) -> list[InputPartition]:
        return [FilePartition(p) for p in files(self.options["path"])]

    def read(self, partition: FilePartition) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(self.schema)
        with open(partition.path, "rb") as file:
            data = file.read()
        for block in read_blocks(data, compression_of(partition.path) != "none", self.schema.names):
            yield to_batch(block, schema)


@dataclass
class Written(WriterCommitMessage):
    path: str
    rows: int


class BlockWriter(DataSourceArrowWriter):
    def __init__(self, schema: T.StructType, options: dict[str, str], overwrite: bool):
        self.schema, self.options, self.overwrite = schema, options, overwrite
        self.compression = options.get("compression", "none").lower()
        if self.compression not in METHODS:
            raise CodecError(f"unknown compression {self.compression!r}")
        told = json.loads(options.get("types", "{}"))
        self.kinds = [types.parse(told[f.name]) if f.name in told else types.of_spark(f.dataType, f.nullable, f.metadata) for f in schema.fields]

    @property
    def folder(self) -> str:
        return self.options["path"].removeprefix("file://").removeprefix("file:")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        size, rows, path = int(self.options.get("block_rows", 65536)), 0, ""
        os.makedirs(self.folder, exist_ok=True)
        name = f"_part-{uuid.uuid4().hex}" + ("" if self.compression == "none" else f".{self.compression}") + SUFFIX
        file = None
        try:
            for batch in iterator:
                for at in range(0, batch.num_rows, size):
                    part = batch.slice(at, size)
                    if file is None:
                        path = os.path.join(self.folder, name)
                        file = open(path, "wb")  # noqa: SIM115
                    values = [column(c, k) for c, k in zip(part.columns, self.kinds, strict=True)]
                    self.put(file, encode_block(self.schema.names, self.kinds, values))
                    rows += part.num_rows
            if file is not None:
                self.put(file, empty_block())
        finally:
            if file is not None:
                file.close()
        return Written(path, rows)

    def put(self, file, block: bytes) -> None:
        file.write(block if self.compression == "none" else encode_frame(block, self.compression))

    def commit(self, messages: list[Written | None]) -> None:
        os.makedirs(self.folder, exist_ok=True)
        new = {m.path for m in messages if m and m.path}
        old = files(self.folder) if self.overwrite else []
        if not new:
            path = os.path.join(self.folder, f"_part-{uuid.uuid4().hex}{SUFFIX}")
            with open(path, "wb") as file:  # the schema of a table without rows
                file.write(encode_block(self.schema.names, self.kinds, [[] for _ in self.kinds]))
            new.add(path)
        # Old files go when the new ones are there: a driver that dies in between leaves both, never neither.
        for path in new:
            os.rename(path, os.path.join(self.folder, os.path.basename(path)[1:]))
        for path in old:
            os.remove(path)

    def abort(self, messages: list[Written | None]) -> None:
        for m in messages:
            if m and m.path and os.path.exists(m.path):
                os.remove(m.path)


def column(values: pa.Array, kind: types.TypeNode) -> Sequence:
    """A column's values as the codec takes them. A null in a type that has none is an error, not a silent default."""
    if values.null_count and not kind.nullable:
        raise CodecError(f"a null in a column of {kind}; declare Nullable({kind})")
    if kind.name in NUMBERS and pa.types.is_primitive(values.type):
        return values.to_numpy(zero_copy_only=False)
    return values.to_pylist()


class NativeBlockSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "native_block"

    def schema(self) -> T.StructType:
        found = files(self.options["path"])
        if not found:
            raise CodecError(f"no block files in {self.options['path']}")
        block = header(found[0])
        return storage_schema(block.names, block.types)

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return BlockReader(schema, dict(self.options))

    def writer(self, schema: T.StructType, overwrite: bool) -> BlockWriter:
        return BlockWriter(schema, dict(self.options), overwrite)


def read_blocks_anywhere(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    """The named columns (type strings) of block files in any store that Spark reads."""
    schema = storage_schema(list(columns), [types.parse(k) for k in columns.values()])
    arrow = to_arrow_schema(schema)
    names = schema.names

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for block in read_blocks(content.as_py(), compression_of(name) != "none", names):
                    yield to_batch(block, arrow)

    source = spark.read.format("binaryFile").option("pathGlobFilter", f"*{SUFFIX}").load(path)
    return source.select("path", "content").mapInArrow(read, schema)
