"""Byte-level BPE by overlapping chunks.

A long text is cut into chunks that overlap. Chunks are pre-tokenised on their own, in parallel; each reports only the pre-token
boundaries inside its two overlaps. Two neighbours are stitched at a boundary that both found: from a true boundary on, pre-tokens
depend on what follows alone, so both agree from there. The first chunk's boundaries are true from its start, hence by induction every stitch
is a true boundary. Where an overlap has no common boundary - one pre-token longer than the overlap - the chunks are joined and read as one.
Each piece between stitches is then encoded by itself, and a text's ids are those of its pieces in order. Decoding concatenates
the raw bytes of the ids.

A text of one chunk needs no stitching and is encoded where it is read; only long texts are moved, each chunk to
any task, and each distinct long text once. No task needs more than a few chunks until the ids of one text meet in order.

Defined results: a null text is the empty text and has no ids; a null or repeated doc_id is of no consequence, since rows are
never matched by id; equal rows give equal rows; other columns are ignored, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of a chunk beyond which a text is cut, and by which neighbours overlap.
CHUNK, OVERLAP = 32768, 512
#: Matches that end so near a chunk's end may come out otherwise with more text: contractions look two characters ahead.
EDGE = 3
#: Characters up to which a piece goes to the library whole. Its pattern matcher needs stack for each character of an endless run of white space
#: and stops the process at about a million, so longer pieces are cut into pre-tokens here.
WHOLE = 65536


def load_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a tiktoken file."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Codec:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, path: str, pattern: str):
        ranks = load_ranks(path)
        self.bytes_of = {i: t for t, i in ranks.items()}
        self.pattern = regex.compile(pattern)
        self.merges = tiktoken.Encoding(name=path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def boundaries(self, text: str) -> list[int]:
        """Where pre-tokens end."""
        return [m.end() for m in self.pattern.finditer(text)]

    def encode(self, text: str) -> list[int]:
        """The ids of a text that starts and ends at pre-token boundaries; it may be one pre-token of any length."""
        if len(text) <= WHOLE:
            return self.merges.encode_ordinary(text)
        ids: list[int] = []
        for m in self.pattern.finditer(text):
            ids += self.merges._encode_single_piece(m[0])
        return ids

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


_CODECS: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """One codec for each vocabulary and worker."""
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = Codec(path, pattern)
    return _CODECS[path, pattern]


def zones(text: str, first: bool, last: bool, start: int, found: list[int], overlap: int = OVERLAP) -> tuple[list[int], list[int]]:
    """The boundaries, as places in the whole text, in a chunk's overlap with the one before and with the one after."""
    head = [] if first else [start + b for b in found if b <= overlap]
    tail = [] if last else [start + b for b in found if len(text) - overlap <= b <= len(text) - EDGE]
    return head, tail


def stitched(text: str, c: Codec, chunk: int = CHUNK, overlap: int = OVERLAP) -> list[int]:
    """The ids of one text by way of chunks, in one process: what the distributed plan does, for tests and single texts."""
    step = chunk - overlap
    starts = list(range(0, max(len(text) - overlap, 1), step))
    zone = [zones(t := text[s : s + chunk], s == 0, k == len(starts) - 1, s, c.boundaries(t), overlap) for k, s in enumerate(starts)]
    cuts = [0] + [max(both) for a, b in zip(zone, zone[1:], strict=False) if (both := set(a[1]) & set(b[0]))] + [len(text)]
    return [i for a, b in zip(cuts, cuts[1:], strict=False) for i in c.encode(text[a:b])]


def digest(ids: list[int]) -> str:
    return hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()


def encode_texts(docs: DataFrame, path: str, pattern: str, emit: Callable[[Codec, list[list[int]]], dict[str, pa.Array]], schema: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id of each row of ``docs`` and the columns that ``emit`` makes of its text's ids; ``schema`` names those columns."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    is_long = F.octet_length("text") > chunk  # bytes are at least as many as characters
    names = [x.split()[0] for x in schema.split(",")]

    def table(c: Codec, ids: list[list[int]], **first: pa.Array) -> pa.RecordBatch:
        columns = first | emit(c, ids)
        return pa.RecordBatch.from_arrays([columns[n] for n in (*first, *names)], names=[*first, *names])

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                yield table(c, [c.encode(x) for x in part.column(1).to_pylist()], doc_id=part.column(0))

    small = rows.where(~is_long).mapInArrow(short, f"doc_id long, {schema}")

    # Long texts: each distinct one is cut, its chunks are dealt to all tasks, stitched by equality joins, and encoded.
    big = rows.where(is_long).select("doc_id", "text", F.sha2(F.col("text").cast("binary"), 256).alias("key"))
    step = chunk - overlap
    last = F.greatest(F.floor((F.length("text") - 1 - overlap) / step), F.lit(0))
    cut = F.transform(F.sequence(F.lit(0), last.cast("int")), lambda k: F.struct(k.alias("k"), F.substring(F.col("text"), k * step + 1, F.lit(chunk)).alias("t"), (k == last).alias("end")))
    chunks = big.select("key", F.explode(cut).alias("x")).select("key", "x.k", F.col("x.t").alias("t"), F.col("x.end").alias("end")).dropDuplicates(["key", "k"])

    def pretokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for batch in batches:
            found = [zones(t, k == 0, e, k * step, c.boundaries(t), overlap) for k, t, e in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True)]
            place = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(3), pa.array([h for h, _ in found], place), pa.array([t for _, t in found], place)], names=["key", "k", "end", "head", "tail"])

    zoned = chunks.mapInArrow(pretokenise, "key string, k int, end boolean, head array<long>, tail array<long>")
    after = zoned.select("key", (F.col("k") - 1).alias("k"), F.col("head").alias("next"))
    seams = zoned.join(after, ["key", "k"], "left").select("key", "k", F.array_max(F.array_intersect("tail", "next")).alias("seam"))
    # A chunk opens a run if the seam before it holds; runs of several chunks are rare and as long as one endless pre-token.
    seams = seams.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("k", "seam"))).alias("s"))
    # Each run: its first and last chunk and the places between which it is encoded.
    closes = F.filter("s", lambda x: x["seam"].isNotNull() | (x["k"] == F.size("s") - 1))
    runs = seams.select("key", closes.alias("c")).select(
        "key",
        F.posexplode(F.transform("c", lambda x, i: F.struct(F.when(i == 0, F.lit(0)).otherwise(F.try_element_at("c", i)["k"] + 1).alias("k0"), F.when(i == 0, F.lit(0).cast("long")).otherwise(F.try_element_at("c", i)["seam"]).alias("lo"), x["k"].alias("k1"), x["seam"].alias("hi")))).alias("run", "r"),
    )
    pieces = runs.select("key", "run", F.explode(F.sequence("r.k0", "r.k1")).alias("k"), F.col("r.k0").alias("k0"), F.col("r.lo").alias("lo"), F.col("r.hi").alias("hi"))

    def span(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A run's text from its chunks; lo may lie in the chunk before, whose tail the chunk repeats."""
        c = codec(path, pattern)
        for batch in batches:
            out = []
            for ts, k0, lo, hi in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4, 5)), strict=True):
                whole = ts[0]["t"] + "".join(x["t"][overlap:] for x in ts[1:])
                ids = c.encode(whole[lo - k0 * step : None if hi is None else hi - k0 * step])
                out.append(np.asarray(ids, "<u4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], names=["key", "run", "ids"])

    texts = pieces.join(chunks.select("key", "k", "t"), ["key", "k"]).groupBy("key", "run", "k0", "lo", "hi").agg(F.sort_array(F.collect_list(F.struct("k", "t"))).alias("ts"))
    encoded = texts.select("key", "run", "ts", "k0", "lo", "hi").mapInArrow(span, "key string, run int, ids binary")
    whole = encoded.groupBy("key").agg(F.transform(F.sort_array(F.collect_list(F.struct("run", "ids"))), lambda x: x["ids"]).alias("ids"))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for batch in batches:
            for at in range(batch.num_rows):
                ids = np.frombuffer(b"".join(batch.column(1)[at].as_py()), "<u4").tolist()
                yield table(c, [ids], key=batch.column(0).slice(at, 1))

    done = whole.mapInArrow(finish, f"key string, {schema}")
    large = big.select("doc_id", "key").join(done, "key").select("doc_id", *names)
    return small.unionByName(large)


def encode_digests(docs: DataFrame, path: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and, after decoding the ids again, decoded_sha256 of every row."""

    def emit(c: Codec, ids: list[list[int]]) -> dict[str, pa.Array]:
        return {
            "n_tokens": pa.array([len(x) for x in ids], pa.int64()),
            "ids_sha256": pa.array([digest(x) for x in ids], pa.string()),
            "decoded_sha256": pa.array([hashlib.sha256(c.decode(x)).hexdigest() for x in ids], pa.string()),
        }

    return encode_texts(docs, path, pattern, emit, "n_tokens long, ids_sha256 string, decoded_sha256 string", chunk, overlap)


def encode_ids(docs: DataFrame, path: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id and the ids of every row's text, as an array of integers."""

    def emit(c: Codec, ids: list[list[int]]) -> dict[str, pa.Array]:
        return {"ids": pa.array(ids, pa.list_(pa.int32()))}

    return encode_texts(docs, path, pattern, emit, "ids array<int>", chunk, overlap)


def decode_ids(rows: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """id and the raw bytes of each row of ids (null: none); bytes, since ids need not end where a character does."""

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for batch in batches:
            out = [c.decode(x or ()) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["doc_id", "bytes"])

    return rows.select(F.col(id_col).cast("long"), F.col(ids_col)).mapInArrow(back, "doc_id long, bytes binary")
