"""Near copies by word shingles: texts whose sets of 5-word shingles have a Jaccard similarity of ``LIKENESS`` or more.

Texts with equal sets are one node from the start. Candidate pairs of nodes come from two sources:

* SimHash (``simhash.py``): fingerprints of the shingles that differ by two bits or fewer, found by deletion variants;
* since two texts of similarity 0.8 differ by ten bits on average, which no cut of 64 bits finds, ``BANDS`` bands of ``ROWS`` minima of the same hashes
  each: sets that share a band meet. A pair of similarity s is missed with probability (1 - s^ROWS)^BANDS, which is 5e-8 at 0.8 and less above.

Every candidate is verified on the whole sets before it links, so no pair below the bound does.

Bands that many sets share are not paired by the square. All members of a band are first verified against one, its *hub*: the member that
shares most bands with most sets, which for copies of one text is the least changed copy. A pair that has a band in common has its hub in common too, and what
is left to find is pairs that are not both linked to it. For these an exact filter works on the *differences* from the hub, D(x) = x without hub and hub without x:

    J(x, y) >= s  if and only if  |D(x) & D(y)| >= (g(x) + g(y)) / 2,  g(x) = |D(x)| - c |x|,  c = (1 - s) / (1 + s)

and x is linked to the hub h if and only if g(x) <= c |h|. With the differences' shingles in one order, rarest first, a pair has one in common among the first
few of both: of y the first |D(y)| - t + 1 where t is the least overlap that it must have with anything not linked to the hub. Shingles that only one set
has - those of its own changes - meet nothing, so copies that were changed too much to link cost next to nothing, however many they are.

Defined results: words are split at ASCII white space and lowered in ASCII; a text of fewer than five words is one shingle; a null or
empty text, or one of white space alone, has the empty set, and all such are copies of each other; rows without an id come last.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import simhash
from .common import durable, skew_join, stored
from .components import components

SHINGLE, LIKENESS, BANDS, ROWS, SEED = 5, 0.8, 32, 4, 42
_FACTORS = np.random.default_rng(SEED).integers(0, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: What sums of fractions may be off by.
SLACK = 1e-6


def shingles(text: bytes) -> np.ndarray:
    """The sorted 64-bit hashes of a text's word shingles, each once."""
    words = text.lower().split()
    digest = xxhash.xxh64_intdigest
    if len(words) < SHINGLE:
        return np.array([digest(b" ".join(words), SEED)] if words else [], "<u8")
    return np.unique(np.array([digest(b" ".join(g), SEED) for g in zip(*(words[i:] for i in range(SHINGLE)), strict=False)], "<u8"))


def bands(hashes: np.ndarray) -> list[int]:
    """One signed key for each band of minima; none for the empty set."""
    if not len(hashes):
        return []
    least = np.full(len(_FACTORS), 2**64 - 1, np.uint64)
    for at in range(0, len(hashes), 4096):
        least = np.minimum(least, (hashes[at : at + 4096, None] * _FACTORS).min(axis=0))
    return [sign(xxhash.xxh64_intdigest(part.tobytes(), i)) for i, part in enumerate(least.reshape(BANDS, ROWS))]


def sign(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def alike(a: bytes, b: bytes, likeness: float) -> bool:
    """Whether two sets, each packed, have that Jaccard similarity."""
    small, large = sorted((len(a) // 8, len(b) // 8))
    if small < likeness * large:
        return False
    both = len(np.intersect1d(np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8"), assume_unique=True))
    return both / (small + large - both) >= likeness


def difference(x: bytes, hub: bytes, likeness: float) -> tuple[np.ndarray, float, float]:
    """D(x), g(x) and c |hub|."""
    c = (1 - likeness) / (1 + likeness)
    d = np.setxor1d(np.frombuffer(x, "<i8"), np.frombuffer(hub, "<i8"), assume_unique=True)
    return d, len(d) - c * (len(x) // 8), c * (len(hub) // 8)


def _text(docs: DataFrame) -> tuple:
    text = F.coalesce(F.col("text"), F.lit(""))
    return F.xxhash64("doc_id", text).alias("t"), text.cast("binary").alias("body")


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, rows):
            yield whole.slice(at, rows)


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, t (hash of id and text), node (hash of the shingle set), fp (its SimHash) and keys (of the bands) of every row."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            sets = [shingles(x) for x in batch.column(2).to_pylist()]
            nodes = [sign(xxhash.xxh64_intdigest(s.tobytes(), SEED)) for s in sets]
            columns = [pa.array(nodes, pa.int64()), pa.array([simhash.majority(s) for s in sets], pa.int64()), pa.array([bands(s) for s in sets], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=["doc_id", "t", "node", "fp", "keys"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), *_text(docs)).mapInArrow(scan, "doc_id long, t long, node long, fp long, keys array<long>")


def shingle_sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """node and hashes (its packed set) of ``nodes`` (node, t)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([shingles(x).tobytes() for x in batch.column(1).to_pylist()], pa.binary())], names=["node", "hashes"])

    texts = docs.select(*_text(docs)).join(nodes, "t").dropDuplicates(["node"]).select("node", "body")
    return stored(texts.mapInArrow(scan, "node long, hashes binary"))


def with_sets(pairs: DataFrame, sets: DataFrame, a: str, b: str) -> DataFrame:
    """``pairs`` with the sets of their columns a and b as x and y."""
    left = skew_join(pairs, sets.select(F.col("node").alias(a), F.col("hashes").alias("x")), a)
    return skew_join(left, sets.select(F.col("node").alias(b), F.col("hashes").alias("y")), b)


def verified(pairs: DataFrame, sets: DataFrame, likeness: float) -> DataFrame:
    """The ``pairs`` (a, b) that are alike, by their whole sets."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            told = [alike(x, y, likeness) for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(told, pa.bool_()))

    return with_sets(pairs, sets, "a", "b").select("a", "b", "x", "y").mapInArrow(compare, "a long, b long")


def ordered(a, b) -> DataFrame:
    return F.least(a, b).alias("a"), F.greatest(a, b).alias("b")


def by_fingerprint(nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) of ``nodes`` (node, fp) whose fingerprints are equal or link, enough of them to connect all that do."""
    fps = durable(nodes.groupBy("fp").agg(F.min("node").alias("lead")))
    same = skew_join(nodes, fps, "fp").where("node <> lead").select(*ordered(F.col("node"), F.col("lead")))
    linked = simhash.links(fps.select("fp")).join(fps.select(F.col("fp").alias("a"), F.col("lead").alias("p")), "a").join(fps.select(F.col("fp").alias("b"), F.col("lead").alias("q")), "b")
    return same.unionByName(linked.select(*ordered(F.col("p"), F.col("q"))))


def met_in_bands(nodes: DataFrame) -> DataFrame:
    """key, node and hub of the bands of ``nodes`` (node, keys) that several share."""
    spread = nodes.select("node", F.explode("keys").alias("key"))
    # Not as a broadcast: each node becomes ``BANDS`` rows, of which the size that Spark goes by knows nothing.
    met = durable(skew_join(spread.hint("merge"), spread.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "key"))
    weight = met.groupBy("node").agg(F.sum("n").alias("weight"))
    hubs = skew_join(met, weight, "node").groupBy("key").agg(F.max(F.struct("weight", "node")).alias("x")).select("key", F.col("x.node").alias("hub"))
    return durable(skew_join(met.select("key", "node"), hubs, "key"))


def candidates(far: DataFrame, sets: DataFrame, likeness: float) -> DataFrame:
    """The pairs (a, b) of ``far`` (hub, node, root) that may be alike: of one hub, not of one root, not both linked to the hub."""
    c = (1 - likeness) / (1 + likeness)

    def differ(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, 64):
            keep, out = [], []
            for i, (x, y) in enumerate(zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True)):
                d, g, bound = difference(x, y, likeness)
                # The least overlap with what is not linked to the hub, and with anything; the latter only for those not linked themselves.
                near = max(1, math.ceil((g + bound) / 2 - SLACK))
                any_ = max(1, math.ceil(g - c * (len(x) // 8) / likeness - SLACK)) if g > bound - SLACK else len(d) + 1
                if len(d) >= min(near, any_):
                    keep.append(i)
                    out.append((d, g, near, any_))
            columns = [pa.array([x[k] for x in out], t) for k, t in enumerate((pa.list_(pa.int64()), pa.float64(), pa.int32(), pa.int32()))]
            yield pa.RecordBatch.from_arrays([*(batch.column(i).take(pa.array(keep, pa.int32())) for i in range(3)), *columns], names=["hub", "node", "root", "d", "g", "near", "any"])

    shown = with_sets(far.withColumn("a", F.col("node")).withColumn("b", F.col("hub")), sets, "a", "b").select("hub", "node", "root", "x", "y")
    rows = stored(shown.mapInArrow(differ, "hub long, node long, root long, d array<long>, g double, near int, any int"))
    tokens = rows.select("hub", "node", F.explode("d").alias("token"))
    key = F.xxhash64("hub", "token").alias("key")
    shared = tokens.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")
    # Shingles of one set come first in the order and meet nothing: only the others are put in order; left: how many come from there on, itself included.
    few = skew_join(tokens.select("hub", "node", key).hint("merge"), shared, "key").groupBy("hub", "node").agg(F.sort_array(F.collect_list(F.struct("n", "key"))).alias("order"))
    placed = few.join(rows.drop("d"), ["hub", "node"]).select("hub", "node", "root", "g", "near", "any", F.posexplode("order").alias("at", "x"), F.size("order").alias("of"))
    placed = durable(placed.select("hub", "node", "root", "g", F.col("x.key").alias("key"), (F.col("of") - F.col("at")).alias("left"), "near", "any").where("left >= near OR left >= any"))
    short = placed.where("left >= near").select("key", F.col("node").alias("b"), F.col("root").alias("root_b"), F.col("g").alias("g_b"), F.col("left").alias("left_b"))
    # A pair is asked for by one that is not linked to the hub; the other side is what its partners must show.
    asks = placed.where("left >= any").select("key", F.col("node").alias("a"), "root", "g", "left")
    met = skew_join(asks, short, "key").where((F.col("root") != F.col("root_b")) & (F.least("left", "left_b") >= (F.col("g") + F.col("g_b")) / 2 - SLACK))
    return met.select(*ordered(F.col("a"), F.col("b"))).distinct()


def grouped(docs: DataFrame, likeness: float = LIKENESS) -> DataFrame:
    """doc_id, t and root - a key of the component that is never null - of every row."""
    rows = durable(signatures(docs))
    nodes = durable(rows.groupBy("node").agg(F.min("t").alias("t"), F.first("fp").alias("fp"), F.first("keys").alias("keys")))
    met = met_in_bands(nodes.select("node", "keys"))
    to_hub = met.where("node <> hub").select(*ordered(F.col("node"), F.col("hub")))
    first = durable(by_fingerprint(nodes.select("node", "fp")).unionByName(to_hub).distinct())
    asked = met.select("node").unionByName(first.select(F.explode(F.array("a", "b")).alias("node"))).distinct()
    sets = shingle_sets(docs, asked.join(nodes.select("node", "t"), "node"))
    links = durable(verified(first, sets, likeness))
    # Bands whose members are of one component have nothing left to find.
    named = skew_join(met, components(links), "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = durable(named)
    open_keys = named.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("key")
    far = durable(skew_join(named, open_keys, "key").where("node <> hub").select("hub", "node", "root").distinct())
    more = durable(candidates(far, sets, likeness).join(first, ["a", "b"], "left_anti"))
    links = links.unionByName(verified(more, sets, likeness))
    return skew_join(rows.select("doc_id", "t", "node"), components(links), "node", "left").select("doc_id", "t", F.coalesce("root", "node").alias("root"))


def representatives(docs: DataFrame, likeness: float = LIKENESS) -> DataFrame:
    """One row of each component, with all its columns, chosen as in ``simhash.representatives``."""
    return simhash.one_of_each(docs, grouped(docs, likeness))
