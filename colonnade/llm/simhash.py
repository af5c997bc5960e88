"""SimHash near-duplicates by deletion-variant signatures.

The fingerprint of a text: a bit is 1 if it is set in over half of the hashes of its word shingles. Fingerprints link at
``bits`` or fewer differing bits. To find all links, a fingerprint is cut into so few segments - ``bits // 2 + 1``, two
for two bits - that in any linked pair one segment differs by one bit at most. Every segment is indexed by
its one-wildcard variants (the segment with one bit deleted), so linked pairs meet in an equality join on some variant, and are verified there.

A variant shared by more than ``bucket`` fingerprints is not joined, as that would make pairs by the square. Its fingerprints
go another exact way: for two differing bits, each puts down itself and its 64 one-bit neighbours, and fingerprints that share such a
neighbour differ by two bits at most, while linked ones always share one; each is tied to the smallest there, so the rows
stay in proportion. No link between different fingerprints is lost either way.

Equal texts, and texts with equal fingerprints, are one node from the start. Nothing unbounded is collected: fingerprints, links and
components remain tables; connected components take a number of rounds logarithmic in the longest chain.

Defined results: a null or empty text, or one of white space alone, has fingerprint zero, which links as any other; a null doc_id keeps its
row, and a component of such rows alone has a null id; repeated rows stay repeated; other columns are ignored, whatever
their names; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable, packed_row, skew_join, unpacked_row
from .components import components

SHINGLE, SEED, BITS, BUCKET = 3, 42, 2, 32


def bit_totals(hashes: np.ndarray) -> np.ndarray:
    """How many hashes have each bit, from the lowest."""
    return np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def majority(hashes: np.ndarray) -> int:
    """The fingerprint of some hashes, as a signed integer; 0 of none."""
    return int(np.packbits(bit_totals(hashes) * 2 > len(hashes), bitorder="little").view("<i8")[0])


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The 64-bit fingerprint of a text, as a signed integer. Long texts are hashed piece by piece, whole."""
    words = text.lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    totals = np.zeros(64, np.int64)
    for at in range(0, n, 65536):
        part = words[at : at + 65536 + shingle - 1]
        grams = map(b" ".join, zip(*(part[i : len(part) - shingle + 1 + i] for i in range(shingle)), strict=True)) if len(words) >= shingle else [b" ".join(words)]
        totals += bit_totals(np.array([digest(g, seed) for g in grams], "<u8"))
    bits = np.packbits(totals * 2 > n, bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """doc_id, t (hash of id and text) and fp (signed 64-bit) of every row."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                fps = [fingerprint(t, shingle, seed) for t in batch.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps, pa.int64())], names=["doc_id", "t", "fp"])

    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", text).alias("t"), text.cast("binary").alias("body"))
    return rows.mapInArrow(scan, "doc_id long, t long, fp long")


def variants(fp, segments: int):
    """The array of one-wildcard signatures of a fingerprint column: segment number, deleted bit and the segment without it."""
    width = -(-64 // segments)
    out = []
    for s in range(segments):
        low, size = s * width, min(width, 64 - s * width)
        part = F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << size) - 1 if size < 64 else -1))
        out += [F.struct(F.lit(s * 64 + bit).cast("short").alias("place"), part.bitwiseAND(F.lit(~(1 << bit) if bit < 63 else (1 << 63) - 1)).alias("rest")) for bit in range(size)]
    return F.array(*out)


def links(fps: DataFrame, bits: int = BITS, bucket: int = BUCKET) -> DataFrame:
    """Edges (a, b) between distinct fingerprints ``fps`` (fp) that differ by at most ``bits`` bits, enough of them to connect all that link."""
    if bits not in (0, 1, 2):
        raise ValueError("bits must be 0, 1 or 2: beyond, hot variants would have no exact way but all pairs")
    segments = bits // 2 + 1
    # A fingerprint becomes 64 rows, so few partitions of fingerprints would make large tasks.
    fps = fps.repartition(int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp")
    distance = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    # A variant is known by its hash: what falls together by chance is told apart by the distance.
    spread = fps.select("fp", F.inline(variants(F.col("fp"), segments))).select("fp", F.xxhash64("place", "rest").alias("variant"))
    # Adaptive execution knows the size of the fingerprints, not that each becomes 64 rows here, and would send those to the driver as a small table.
    met = durable(skew_join(spread.hint("merge"), spread.groupBy("variant").agg(F.count("*").alias("n")).where("n > 1"), "variant"))
    few = met.where(F.col("n") <= bucket).select("variant", "fp")
    pairs = few.withColumnRenamed("fp", "a").join(few.withColumnRenamed("fp", "b"), "variant").where((F.col("a") < F.col("b")) & (distance <= bits)).select("a", "b")
    many = met.where(F.col("n") > bucket).select("fp").distinct()
    flips = F.array(F.col("fp"), *(F.col("fp").bitwiseXOR(F.lit(1 << b if b < 63 else -(1 << 63))) for b in range(64)))
    near = many.select("fp", F.explode(flips).alias("near"))
    if bits == 2:
        more = skew_join(near.hint("merge"), near.groupBy("near").agg(F.min("fp").alias("a")), "near").where(F.col("a") < F.col("fp")).select("a", F.col("fp").alias("b"))
    else:
        more = near.hint("merge").join(many.select(F.col("fp").alias("b")), F.col("near") == F.col("b")).where(F.col("fp") < F.col("b")).select(F.col("fp").alias("a"), "b").where(distance <= bits)
    return pairs.unionByName(more).distinct()


def grouped(docs: DataFrame, bits: int, shingle: int, seed: int, bucket: int) -> DataFrame:
    """doc_id, t, fp, component_id and root - a key of the component that is never null - of every row."""
    rows = durable(fingerprints(docs, shingle, seed))
    nodes = durable(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(links(nodes.select("fp"), bits, bucket))
    tied = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    smallest = tied.groupBy("root").agg(F.min("least").alias("component_id"))
    return skew_join(rows, skew_join(tied.select("fp", "root"), smallest, "root"), "fp")


def near_duplicates(docs: DataFrame, bits: int = BITS, shingle: int = SHINGLE, seed: int = SEED, bucket: int = BUCKET) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (smallest doc_id of the component) of every row."""
    return grouped(docs, bits, shingle, seed, bucket).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def representatives(docs: DataFrame, bits: int = BITS, shingle: int = SHINGLE, seed: int = SEED, bucket: int = BUCKET) -> DataFrame:
    """One row of each component, with all its columns: the one with the smallest doc_id, rows without an id last; of rows with
    equal id the one whose text hashes lowest, and any one of equal rows."""
    return one_of_each(docs, grouped(docs, bits, shingle, seed, bucket))


def one_of_each(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """The chosen row of each root of ``groups`` (doc_id, t, root)."""
    chosen = groups.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "t")).alias("x"))
    chosen = chosen.select(F.coalesce("x.doc_id", F.lit(0)).alias("id"), F.col("x.t").alias("t"))
    marked = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"), F.xxhash64("doc_id", F.coalesce(F.col("text"), F.lit(""))).alias("t"), packed_row(docs.columns))
    return marked.join(chosen, ["id", "t"], "left_semi").dropDuplicates(["id", "t"]).select(*unpacked_row(docs.columns))
