"""Removal of repeated passages: every byte covered by a ``length``-byte string that also starts anywhere else.

Which texts must be sorted together is found by anchors: every ``length``-byte string has one, the ``GRAM``-byte string in it with the smallest hash
(the leftmost of equals), so equal strings have equal anchors at equal places. Starts that share an anchor's occurrence form a run; its
context is the run's strings put together. Then, all in tables:

1. Anchors are counted over all texts. An anchor with one occurrence proves its strings unique. If all occurrences have one
   context - exact copies - all its strings repeat, and equality has settled them. Likewise contexts that occur twice among others.
2. What is left - an anchor with several contexts - is sorted. One context of each kind is fetched and dealt by its anchor; a task takes blocks of
   anchors; it leaves out starts whose strings' hashes no other start in the block has, counts equal pieces once, and builds the suffix array
   of the pieces (``suffix.py``): strings repeat where neighbours in it agree on ``length`` bytes.
3. An anchor with over ``CROWD`` contexts is not gathered in a task. Its contexts are cut into about ``PARTS`` parts, each of which has a longer anchor: the core that
   its strings have in common, and its place. Parts go through steps 1 and 2 like contexts: cores seen once prove their strings unique, equal parts are settled by equality,
   and cores with up to ``CROWD`` kinds of parts are sorted.
4. Parts of a core with more kinds than that are cut into tiles of a few starts, which are counted by 128
   bits of hash in an aggregate with partial sums; of tiles that occur once and share their core with others, strings are counted one by one against one tile of each kind. So a
   passage in a third of all texts is spread like any other.

Texts are matched by (doc_id, hash of the text); tables of a step are written to the shared folder.

Defined results: a null text is empty; a text shorter than ``length`` bytes loses nothing; rows alike in every respect repeat each other and lose
all that they have; strings are judged on the input, never on what is left, and never cross texts; other columns ride along where asked, whatever their
names; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import packed_row, quoted, skew_join, stored, unpacked_row
from .suffix import repeated_starts

LENGTH, GRAM = 200, 48
#: Contexts of an anchor that may meet in one task.
CROWD = 64
#: Starts of a tile, and parts of a whole run: contexts of larger anchors are cut into parts, and parts of larger cores into tiles.
TILE, PARTS = 8, 4
#: Bytes of contexts that are sorted together, at about.
BLOCK = 200_000
#: Starts that are hashed together; a longer text is read in segments.
SEGMENT = 1 << 20

_BASE = (0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1)


class Hasher:
    """Polynomial hashes, modulo 2^64, of all substrings of one length at once, from prefix sums."""

    def __init__(self, base: int):
        size = SEGMENT + 4096
        self.table = np.random.default_rng(base & 0xFFFF).integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
        with np.errstate(over="ignore"):
            self.power = np.concatenate([[np.uint64(1)], np.cumprod(np.full(size, base, np.uint64))])
            self.inverse = np.concatenate([[np.uint64(1)], np.cumprod(np.full(size, pow(base, -1, 1 << 64), np.uint64))])

    def sums(self, data: np.ndarray) -> np.ndarray:
        return np.concatenate([[np.uint64(0)], np.cumsum(self.table[data] * self.power[: len(data)])])

    def between(self, sums: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return stir((sums[hi] - sums[lo]) * self.inverse[lo])

    def each(self, sums: np.ndarray, size: int) -> np.ndarray:
        return stir((sums[size:] - sums[:-size]) * self.inverse[: len(sums) - size])


def stir(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


_HASHERS: list[Hasher] = []


def hashers() -> list[Hasher]:
    if not _HASHERS:
        _HASHERS.extend(Hasher(b) for b in _BASE)
    return _HASHERS


def segments(texts: list[bytes], length: int) -> Iterator[tuple[bytes, list[tuple[int, int, int, int]]]]:
    """Buffers of about SEGMENT bytes and what is in them: (text, first start, place in the buffer, number of starts)."""
    parts: list[bytes] = []
    inside: list[tuple[int, int, int, int]] = []
    size = 0
    for i, text in enumerate(texts):
        for at in range(0, len(text) - length + 1, SEGMENT):
            part = text[at : at + SEGMENT + length - 1]
            if size and size + len(part) > SEGMENT:
                yield b"".join(parts), inside
                parts, inside, size = [], [], 0
            inside.append((i, at, size, len(part) - length + 1))
            parts.append(part)
            size += len(part)
    if parts:
        yield b"".join(parts), inside


def runs(texts: list[bytes], length: int = LENGTH, gram: int = GRAM) -> Iterator[dict[str, np.ndarray]]:
    """Runs of starts that share an anchor's occurrence: text, first start, number of starts, anchor hash, context hash."""
    one, two = hashers()
    window = length - gram + 1
    for buffer, inside in segments(texts, length):
        data = np.frombuffer(buffer, np.uint8)
        sums = one.sums(data)
        grams = one.each(sums, gram)
        low = np.uint64((1 << 21) - 1)
        least = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
        size = 1
        while size * 2 <= window:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        if rest := window - size:
            least = np.minimum(least[:-rest], least[rest:])
        anchor = (least & low).astype(np.int64)
        owner = np.full(len(anchor), -1, np.int64)
        for k, (_, _, place, count) in enumerate(inside):
            owner[place : place + count] = k
        starts = np.flatnonzero(owner >= 0)
        opens = np.flatnonzero(np.concatenate([[True], (np.diff(anchor[starts]) != 0) | (np.diff(owner[starts]) != 0)]))
        first = starts[opens]
        count = np.diff(np.append(opens, len(starts)))
        table = np.array(inside, np.int64)[owner[first]]
        context = two.between(two.sums(data), first, first + count + (length - 1)) + count.astype(np.uint64)
        yield {"text": table[:, 0], "lo": table[:, 1] + first - table[:, 2], "n": count, "h": grams[anchor[first]].view(np.int64), "c": context.view(np.int64)}


def cells(data: np.ndarray, sums: np.ndarray, size: int, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """A context's starts cut into cells of ``size``, counted from its anchor: their first starts and numbers of starts, where the cell begins (which may be before its first start), the
    hash of the cell's core - what all its strings have in common - and the anchor's place. Equal strings lie at equal places in cells of equal cores. ``sums``: of the first hasher."""
    one = hashers()[0]
    count = len(data) - length + 1
    anchor = int(np.argmin(one.each(sums[: length + 1], gram) & ~np.uint64((1 << 21) - 1)))
    cuts = np.unique(np.concatenate([[0, count], np.arange(anchor % size, count, size)]))
    first, n = cuts[:-1], np.diff(cuts)
    cell = first - (first - anchor) % size
    core = one.between(sums, np.minimum(cell + size - 1, cell + length), cell + length)
    return first, n, cell, core, anchor


def sort_block(contexts: list[tuple[int, int, bytes]], length: int) -> list[np.ndarray]:
    """For each (anchor, copies, context), whether its starts repeat among them; contexts of one anchor differ from each other."""
    one = hashers()[0]
    marks = [np.full(len(c) - length + 1, m > 1) for _, m, c in contexts]
    buffer = b"".join(c for _, _, c in contexts)
    begins = np.cumsum([0] + [len(c) for _, _, c in contexts])
    strings = one.each(one.sums(np.frombuffer(buffer, np.uint8)), length)
    owner = np.full(len(strings), -1, np.int64)
    for k, m in enumerate(marks):
        owner[begins[k] : begins[k] + len(m)] = k
    starts = np.flatnonzero(owner >= 0)
    _, code, number = np.unique(strings[starts], return_inverse=True, return_counts=True)
    # A start that no other hashes like cannot repeat. Neighbouring ones that may are a piece.
    maybe = starts[number[code] > 1]
    if not len(maybe):
        return marks
    opens = np.flatnonzero(np.concatenate([[True], (np.diff(maybe) != 1) | (np.diff(owner[maybe]) != 0)]))
    first, count = maybe[opens], np.diff(np.append(opens, len(maybe)))
    pieces: dict[bytes, list[int]] = {}
    for k, (a, n) in enumerate(zip(first.tolist(), count.tolist(), strict=True)):
        pieces.setdefault(buffer[a : a + n + length - 1], []).append(k)
    # Groups all of whose pieces have copies are settled by them; the others' pieces are sorted.
    group = [contexts[owner[a]][0] for a in first]
    copies = {p: len(k) + sum(contexts[owner[first[x]]][1] > 1 for x in k) for p, k in pieces.items()}
    open_groups = {group[k[0]] for p, k in pieces.items() if copies[p] == 1}
    chosen = [p for p, k in pieces.items() if any(group[x] in open_groups for x in k)]
    sorted_marks = dict(zip(chosen, repeated_starts(chosen, length), strict=True))
    for p, k in pieces.items():
        for x in k:
            o, a = owner[first[x]], first[x] - begins[owner[first[x]]]
            marks[o][a : a + count[x]] |= True if copies[p] > 1 else sorted_marks[p]
    return marks


def spans_of(mark: np.ndarray, shift: int, length: int) -> list[tuple[int, int]]:
    """The covered [from, to) of marked starts."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], mark, [False]]).astype(np.int8)))
    return [(int(a) + shift, int(b) - 1 + length + shift) for a, b in zip(edge[::2], edge[1::2], strict=True)]


_KEYED = ("id", "t")


def keyed(docs: DataFrame, id_col: str, text_col: str) -> list[Column]:
    """The columns that match a text: its id (null: 0) and its hash."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return [F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("id"), F.xxhash64(F.col(id_col), text).alias("t")]


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, crowd: int = CROWD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, t, spans) of the texts that have repeated strings; spans: array of [a, b) byte ranges that these cover, which may overlap."""
    body = F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("body")
    texts = docs.select(*keyed(docs, id_col, text_col), body).where(F.octet_length("body") >= length)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                ids, hashes = (batch.column(i).to_numpy() for i in (0, 1))
                for r in runs(batch.column(2).to_pylist(), length, gram):
                    columns = [ids[r["text"]], hashes[r["text"]], r["h"], r["c"], r["lo"], r["n"].astype(np.int32)]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["id", "t", "h", "c", "lo", "n"])

    found = texts.mapInArrow(scan, "id long, t long, h long, c long, lo long, n int")
    seen = found.groupBy("h").agg(F.count("*").alias("k"), F.min("c").alias("c0"), F.max("c").alias("c1")).where("k > 1")
    rows = stored(skew_join(found, seen.select("h", F.expr("c0 <> c1").alias("mixed")), "h").select("id", "t", "h", "c", "lo", "n", "mixed"))

    # The whole run of a context that occurs more than once is covered.
    mixed = rows.where("mixed")
    kinds = stored(mixed.groupBy("h", "c").agg(F.count("*").alias("m"), F.min(F.struct("id", "t", "lo", "n")).alias("at")))
    twice = kinds.where("m > 1").select("c", F.col("h").alias("h2"))
    copies = skew_join(mixed, twice, "c").where("h = h2").select("id", "t", "lo", "n").unionByName(rows.where("not mixed").select("id", "t", "lo", "n"))
    covered = copies.select("id", "t", F.col("lo").alias("a"), (F.col("lo") + F.col("n") + (length - 1)).alias("b"))

    many = kinds.groupBy("h").agg(F.count("*").alias("d")).where("d > 1")
    wanted = skew_join(kinds, many, "h").select("h", "m", "d", "at.*")
    cut = F.expr(f"substring(body, cast(lo as int) + 1, n + {length - 1})").alias("context")
    fetched = stored(wanted.join(texts, ["id", "t"]).select("h", "m", "d", "id", "t", "lo", cut).dropDuplicates(["id", "t", "lo"]))

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by anchor; a block ends where an anchor does."""
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                if size > BLOCK and held[-1][0] != row[0]:
                    yield block(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[5])
        if held:
            yield block(held)

    def block(held: list[tuple]) -> pa.RecordBatch:
        marks = sort_block([(h, m, c) for h, m, _, _, _, c in held], length)
        out = [(i, t, a, b) for (_, m, i, t, lo, _), mark in zip(held, marks, strict=True) if m == 1 for a, b in spans_of(mark, lo, length)]
        columns = list(zip(*out, strict=True)) or [[], [], [], []]
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], names=["id", "t", "a", "b"])

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Contexts cut into parts of a few tiles; h: hash of a part's core, its place and its anchor; c: hash of its strings put together."""
        one, two = hashers()
        size = max(1, -(-(length - gram) // (PARTS * TILE))) * TILE
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                found, context = [], []
                for h, body in zip(batch.column(0).to_numpy().view(np.uint64), batch.column(5).to_pylist(), strict=True):
                    data = np.frombuffer(body, np.uint8)
                    first, n, cell, core, anchor = cells(data, one.sums(data), size, length, gram)
                    place = stir(h ^ (cell - anchor).astype(np.uint64))
                    joint = two.between(two.sums(data), first, first + n + (length - 1)) + n.astype(np.uint64)
                    found.append((stir(core ^ place), joint, first, n))
                    context += [body[a : a + k + length - 1] for a, k in zip(first.tolist(), n.tolist(), strict=True)]
                key, joint, first, n = (np.concatenate(x) for x in zip(*found, strict=True))
                index = np.repeat(np.arange(len(found)), [len(x[0]) for x in found])
                copies, ids, hashes, lo = (batch.column(i).to_numpy()[index] for i in (1, 2, 3, 4))
                columns = [key.view(np.int64), joint.view(np.int64), copies, ids, hashes, lo + first, n.astype(np.int32)]
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(context, pa.binary())], names=["h", "c", "m", "id", "t", "lo", "n", "context"])

    crowded = fetched.where(F.col("d") > crowd).select("h", "m", "id", "t", "lo", "context")
    part = stored(crowded.mapInArrow(parts, "h long, c long, m long, id long, t long, lo long, n int, context binary"))
    part_kinds = part.groupBy("h", "c").agg(F.sum("m").alias("m"), F.min(F.struct("id", "t", "lo", "n")).alias("at"), F.first("context").alias("context"))
    equal = part.groupBy("h", "c").agg(F.sum("m").alias("m")).where("m > 1").select("c", F.col("h").alias("h2"))
    by_part = skew_join(part.where("m = 1").select("h", "c", "id", "t", "lo", "n"), equal, "c").where("h = h2").select("id", "t", F.col("lo").alias("a"), (F.col("lo") + F.col("n") + (length - 1)).alias("b"))
    cores = part.select("h", "c").distinct().groupBy("h").agg(F.count("*").alias("d")).where("d > 1")
    open_parts = stored(skew_join(part_kinds, cores, "h").select("h", "m", "d", "at.id", "at.t", "at.lo", "context"))

    dealt = fetched.unionByName(open_parts).where(F.col("d") <= crowd).select("h", "m", "id", "t", "lo", "context").repartition("h").sortWithinPartitions("h", "id", "t", "lo")
    by_sort = dealt.mapInArrow(settle, "id long, t long, a long, b long")

    def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Parts cut into tiles of TILE starts; a tile's hash is that of its strings put together."""
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                found = []
                for data in (np.frombuffer(x, np.uint8) for x in batch.column(4).to_pylist()):
                    sums = [u.sums(data) for u in hashers()]
                    first, size, _, core, _ = cells(data, sums[0], TILE, length, gram)
                    joint = [u.between(x, first, first + size + (length - 1)) + size.astype(np.uint64) for u, x in zip(hashers(), sums, strict=True)]
                    found.append((first, size, *joint, core, *(u.each(x, length) for u, x in zip(hashers(), sums, strict=True))))
                first, size, w1, w2, core, v1, v2 = (np.concatenate(x) for x in zip(*found, strict=True))
                index = np.repeat(np.arange(len(found)), [len(x[0]) for x in found])
                ids, hashes, copies, lo = (batch.column(i).to_numpy()[index] for i in (1, 2, 0, 3))
                ends = pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32))
                lists = [pa.ListArray.from_arrays(ends, pa.array(v.view(np.int64))) for v in (v1, v2)]
                columns = [w1.view(np.int64), w2.view(np.int64), core.view(np.int64), copies, ids, hashes, lo + first, size.astype(np.int64)]
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns), *lists], names=["w1", "w2", "core", "m", "id", "t", "a", "n", "v1", "v2"])

    # Tiles that occur more than once are covered. Of the others each string is counted, against one tile of every kind; as all strings of a tile
    # contain its core - what they have in common - only kinds whose core another kind has can have strings in common with it.
    tiled = open_parts.where(F.col("d") > crowd).select("m", "id", "t", "lo", "context").mapInArrow(tiles, "w1 long, w2 long, core long, m long, id long, t long, a long, n long, v1 array<long>, v2 array<long>")
    kind = tiled.groupBy("w1", "w2").agg(F.sum("m").alias("k"), F.min(F.struct("id", "t", "a")).alias("at"), F.first("core").alias("core"), F.first("v1").alias("v1"), F.first("v2").alias("v2"))
    common = skew_join(tiled.where("m = 1").select("w1", "w2", "id", "t", "a", "n"), kind.where("k > 1").select("w1", F.col("w2").alias("w3")), "w1").where("w2 = w3")
    by_tile = common.select("id", "t", "a", (F.col("a") + F.col("n") + (length - 1)).alias("b"))
    tile_cores = kind.groupBy("core").agg(F.count("*").alias("kinds")).where("kinds > 1").select("core")
    single = skew_join(kind, tile_cores, "core").select(F.least("k", F.lit(2)).alias("k"), "at", F.posexplode(F.arrays_zip("v1", "v2")).alias("i", "v")).select("k", "at.id", "at.t", (F.col("at.a") + F.col("i")).alias("a"), "v.v1", "v.v2")
    again = single.groupBy("v1", "v2").agg(F.sum("k").alias("k")).where("k > 1").select("v1", F.col("v2").alias("v3"))
    by_string = skew_join(single.where("k = 1"), again, "v1").where("v2 = v3").select("id", "t", "a", (F.col("a") + length).alias("b"))
    by_count = by_tile.unionByName(by_string)

    sorted_spans = stored(by_sort.unionByName(by_part).unionByName(by_count))
    everything = covered.unionByName(sorted_spans)
    return everything.groupBy("id", "t").agg(F.collect_set(F.struct("a", "b")).alias("spans"))


def without(text: bytes, spans: np.ndarray) -> tuple[bytes, int, int]:
    """What is left of a text without the union of spans (n, 2), how many bytes went and in how many runs."""
    if not len(spans):
        return text, 0, 0
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    opens = np.concatenate([[True], spans[1:, 0] > reach[:-1]])
    a, b = spans[opens, 0], reach[np.append(np.flatnonzero(opens)[1:] - 1, len(spans) - 1)]
    kept = b"".join(text[x:y] for x, y in zip([0, *b.tolist()], [*a.tolist(), len(text)], strict=True))
    return kept, int((b - a).sum()), len(a)


def remove_repeats(docs: DataFrame, emit: Callable[[list[bytes], list[tuple[bytes, int, int]]], dict[str, pa.Array]], schema: str, keep: tuple[str, ...], length: int = LENGTH, gram: int = GRAM, crowd: int = CROWD) -> DataFrame:
    """The columns ``keep`` of every row and those that ``emit`` makes of its text (bytes) and (rest, bytes removed, runs removed)."""
    spans = repeated_spans(docs, length, gram, crowd)
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("body")
    rows = docs.select(*keyed(docs, "doc_id", "text"), body, packed_row(keep))
    both = rows.join(spans, [*_KEYED], "left").select("row", "body", F.transform("spans", lambda x: x["a"]).alias("a"), F.transform("spans", lambda x: x["b"]).alias("b"))
    names = [x.split()[0] for x in schema.split(",")]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                texts = batch.column(1).to_pylist()
                pairs = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
                left = [without(t, np.array([a, b], np.int64).T if a else np.empty((0, 2), np.int64)) for t, (a, b) in zip(texts, pairs, strict=True)]
                made = emit(texts, left)
                row = batch.column(0)
                yield pa.RecordBatch.from_arrays([row, *(made[n] for n in names)], names=["row", *names])

    kind = both.schema["row"].dataType.simpleString()
    out = both.mapInArrow(apply, f"row {kind}, {schema}")
    return out.select(*unpacked_row(keep), *names)


def digests(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, crowd: int = CROWD) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row."""

    def emit(texts: list[bytes], left: list[tuple[bytes, int, int]]) -> dict[str, pa.Array]:
        return {
            "n_bytes": pa.array([len(t) for t in texts], pa.int64()),
            "n_removed": pa.array([n for _, n, _ in left], pa.int64()),
            "n_spans": pa.array([n for _, _, n in left], pa.int64()),
            "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k, _, _ in left], pa.string()),
        }

    return remove_repeats(docs, emit, "n_bytes long, n_removed long, n_spans long, kept_sha256 string", ("doc_id",), length, gram, crowd)


def clean(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, crowd: int = CROWD) -> DataFrame:
    """Every row with what is left of its text; a character of which a byte went goes whole. n_chars, if there, is counted anew."""

    def emit(_: list[bytes], left: list[tuple[bytes, int, int]]) -> dict[str, pa.Array]:
        return {"rest": pa.array([k.decode("utf-8", "ignore") for k, _, _ in left], pa.string())}

    keep = tuple(c for c in docs.columns if c != "text")
    out = remove_repeats(docs, emit, "rest string", keep, length, gram, crowd).toDF(*keep, "text")
    if "n_chars" in keep:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*map(quoted, docs.columns))
