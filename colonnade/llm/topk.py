"""Exact top-k search by columnar branch and bound.

Vectors are quantised to integers and packed into blocks in vertical layout (one contiguous run of values per
dimension). A block of queries meets a block of vectors; scores accumulate over a few dimensions at a time, and after each
step only the candidates whose score so far, plus the most that the remaining dimensions can add (Cauchy-Schwarz on the
remaining masses), reaches the k-th best known score stay in the compacted candidate list. Nothing is approximate.

Defined results: a vector that is null, or has a null or non-finite component, takes no part, nor does a row without an id.
An empty vector scores 0 against other empty ones. Vectors are compared with vectors of the same length only. A query's
own row is every row that bears its id. Repeated rows each count as a row: of a repeated query id all rows are searched, and their pairs ranked
together. Ties go to the smaller id. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_BLOCK = "dim int, n int, ids binary, data binary"
#: Floats hold every integer up to this one, so sums below it may use the float matrix product.
_FLOAT_EXACT = 2**53


def _packer(rows: int, scale: float):
    """A function for mapInArrow that packs (id, vector) rows into blocks of up to ``rows`` vectors of one length."""

    def emit(dim: int, ids: list[np.ndarray], parts: list[np.ndarray]) -> pa.RecordBatch:
        all_ids, matrix = np.concatenate(ids), np.concatenate(parts)
        vertical = np.ascontiguousarray(matrix.T, dtype="<i8")
        return pa.RecordBatch.from_arrays(
            [pa.array([dim], pa.int32()), pa.array([len(all_ids)], pa.int32()), pa.array([all_ids.tobytes()], pa.binary()), pa.array([vertical.tobytes()], pa.binary())],
            names=["dim", "n", "ids", "data"],
        )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list, list, int]] = {}
        for batch in batches:
            ids, vectors = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
            lengths = np.diff(vectors.offsets.to_numpy())
            values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            starts = np.concatenate([[0], np.cumsum(lengths)])[:-1]
            for dim in np.unique(lengths):
                of = np.flatnonzero(lengths == dim)
                whole = np.floor(values[starts[of][:, None] + np.arange(dim)] * scale)
                if dim and whole.size and not np.abs(whole).max() < 2**62:
                    raise ValueError("a quantised component does not fit a 64-bit integer")
                a, b, n = held.setdefault(int(dim), ([], [], 0))
                a.append(ids[of].astype("<i8"))
                b.append(whole.astype("<i8"))
                held[int(dim)] = (a, b, n + len(of))
                if n + len(of) >= rows:
                    all_ids, matrix = np.concatenate(a), np.concatenate(b)
                    full = len(all_ids) // rows * rows
                    for at in range(0, full, rows):
                        yield emit(int(dim), [all_ids[at : at + rows]], [matrix[at : at + rows]])
                    held[int(dim)] = ([all_ids[full:]], [matrix[full:]], len(all_ids) - full)
        for dim, (a, b, n) in held.items():
            if n:
                yield emit(dim, a, b)

    return pack


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to smaller ids."""
    if len(scores) > 4 * k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= edge)
    else:
        near = np.arange(len(scores))
    return near[np.lexsort((ids[near], -scores[near]))[:k]]


def search_block(q_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vertical: np.ndarray, k: int, step: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query its k best (ids, scores) in one block. queries: (n, dims); vertical: (dims, rows); both integers."""
    dims = vertical.shape[0]
    most = int(np.abs(queries).max(initial=0)) * int(np.abs(vertical).max(initial=0)) * max(dims, 1)
    if most >= 2**63:
        raise ValueError("a score does not fit a 64-bit integer")
    kind = np.float64 if most < _FLOAT_EXACT else np.int64
    queries, vertical = queries.astype(kind), vertical.astype(kind)
    cuts = list(range(0, dims, step)) + [dims]

    def masses(x: np.ndarray, axis: int) -> list[np.ndarray]:
        """The root of the squared mass that lies in the dimensions from each cut on, a little rounded up."""
        squares = np.square(x.astype(np.float64))
        return [np.sqrt(squares.take(range(c, dims), axis=axis).sum(axis=axis)) * (1 + 1e-9) for c in cuts]

    rest_x, rest_q = masses(vertical, 0), masses(queries, 1)
    first = queries[:, : cuts[1]] @ vertical[: cuts[1]] if dims else np.zeros((len(queries), len(ids)), kind)
    for i, q in enumerate(queries):
        alive = np.flatnonzero(ids != q_ids[i])
        score = first[i][alive]
        for j in range(1, len(cuts) - 1):
            if len(alive) > k:
                lead = alive[np.argpartition(score, len(score) - k)[len(score) - k :]]
                floor = (q @ vertical[:, lead]).min()
                stay = score + rest_q[j][i] * rest_x[j][alive] >= floor - 1
                alive, score = alive[stay], score[stay]
            score = score + q[cuts[j] : cuts[j + 1]] @ vertical[cuts[j] : cuts[j + 1], alive]
        top = _best(ids[alive], score, k)
        yield int(q_ids[i]), ids[alive][top], score[top].astype(np.int64)


def exact_topk(vectors: DataFrame, queries: DataFrame, k: int = 5, scale: float = 256.0, id_col: str = "vec_id", vector_col: str = "embedding", block_rows: int = 2048, query_rows: int = 256, step: int = 16) -> DataFrame:
    """The ``k`` best rows of ``vectors`` for each row of ``queries`` by integer inner product of floor(scale * x).

    Returns query_id, rank (from 1), vec_id, score. Every block of vectors is dealt to one lane and every block of queries
    to all lanes; a lane joins its blocks, so the work is spread evenly however the vectors look, and the merge moves k rows
    per query and block.
    """
    lanes = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def usable(df: DataFrame) -> DataFrame:
        value = F.transform(F.col(vector_col), lambda x: x.cast("double"))
        fine = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
        return df.select(F.col(id_col).cast("long").alias("id"), value.alias("v")).where(F.col("id").isNotNull() & F.col("v").isNotNull() & fine)

    asked = usable(queries)
    lane = F.pmod(F.xxhash64("ids"), F.lit(lanes)).cast("int")
    right = usable(vectors).mapInArrow(_packer(block_rows, scale), _BLOCK).withColumn("lane", lane)
    left = asked.mapInArrow(_packer(query_rows, scale), _BLOCK).select(F.col("dim"), F.col("n").alias("q_n"), F.col("ids").alias("q_ids"), F.col("data").alias("q_data"), F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))).alias("lane"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                dim, n, ids, data, q_n, q_ids, q_data = (batch.column(c)[row].as_py() for c in range(7))
                found = list(search_block(np.frombuffer(q_ids, "<i8"), np.frombuffer(q_data, "<i8").reshape(dim, q_n).T, np.frombuffer(ids, "<i8"), np.frombuffer(data, "<i8").reshape(dim, n), k, step))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([np.full(len(a), q) for q, a, _ in found]), pa.int64()),
                        pa.array(np.concatenate([a for _, a, _ in found]), pa.int64()),
                        pa.array(np.concatenate([s for _, _, s in found]), pa.int64()),
                    ],
                    names=["query_id", "vec_id", "score"],
                )

    pairs = right.join(left, ["dim", "lane"]).select("dim", "n", "ids", "data", "q_n", "q_ids", "q_data")
    near = pairs.mapInArrow(search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
