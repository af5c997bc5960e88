"""Chroma audio fingerprints, and recordings aligned by them.

A recording (a WAV file in a binary column) becomes mono samples at a low rate, overlapping frames, the energy of the 12 pitch classes in each
frame, smoothed and scaled to length one. ``FILTERS`` compare areas of this image of frames by pitch classes; areas are sums from one
integral image. Each filter's log ratio is quantised to two bits in Gray code, and the bits of the 16 filters are packed into one 32-bit integer
per frame.

Recordings of equal fingerprints are one class. A query recording meets every class, in blocks. An integer is cut into the ``PARTS``, and each part
that a frame of either recording has in common votes for the offset between the two: a histogram of offsets. Whole integers would be too coarse, since at 15 % of
bits in error one in two hundred is the same, while one half in fourteen is. At every offset with ``VOTES`` votes the share of differing bits over the
overlap decides; of several, the one where most bits agree beyond chance is told. The bounds lie between copies - shifted by any part of a hop and with 20 dB of noise they
differ in 7 to 15 % of the bits - and chance, which over 32 frames and more hardly gets below 18 %, so that the number of matches goes with that of copies. Every block of queries meets
every block of classes through an equality join on lanes; a block looks parts up in an index, so no pair without a part in common costs anything.

Defined results: null, empty or unreadable audio, and audio shorter than a fingerprint needs, has an empty fingerprint, matches nothing and is in the class
of such rows; a row without an id takes no part; of several rows with one id each is a member of its class, and the query is the one with the smallest fingerprint;
between offsets that are equally good the nearest to zero wins, then the smaller; other columns are ignored, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable, skew_join

#: Samples a second that are analysed, samples of a frame and between frames.
RATE, FRAME, HOP = 4000, 1024, 512
#: Frequencies that count, in hertz.
LOW, HIGH = 55.0, 1760.0
SMOOTH = np.array([0.25, 0.75, 1.0, 0.75, 0.25]) / 3
#: Bounds of the quantiser: log ratios below, between and above these.
BOUNDS = (-0.25, 0.0, 0.25)
#: A match has as many votes for one offset, at most this share of differing bits, and as many frames in common.
VOTES, ERRORS, OVERLAP = 3, 0.15, 32
#: The parts of an integer that vote: lowest bit and number of bits.
PARTS = ((0, 16), (16, 16))
_PART = 1 << 16


def filters() -> list[tuple[int, int, int, int]]:
    """(kind, first pitch class, pitch classes, frames) of the 16 filters, by rule: kinds in turn, windows that widen and move up."""
    return [(k % 4, (5 * k) % 9, 3 + (k % 3), 2 + k % 7) for k in range(16)]


FILTERS = filters()
WIDEST = max(frames for *_, frames in FILTERS)


def read_wav(data: bytes | None) -> tuple[np.ndarray, int]:
    """Mono samples from -1 to 1 and their rate; none of what is no uncompressed WAV."""
    none = np.zeros(0), RATE
    if not data or data[:4] != b"RIFF" or data[8:12] != b"WAVE":
        return none
    at, form = 12, None
    while at + 8 <= len(data):
        name, size = data[at : at + 4], struct.unpack("<I", data[at + 4 : at + 8])[0]
        body = data[at + 8 : at + 8 + size]
        if name == b"fmt " and len(body) >= 16:
            form = struct.unpack("<HHIIHH", body[:16])
        elif name == b"data" and form:
            code, channels, rate, _, _, bits = form
            kinds = {(1, 8): np.uint8, (1, 16): "<i2", (1, 32): "<i4", (3, 32): "<f4", (3, 64): "<f8"}
            if (code, bits) not in kinds or not channels or not rate:
                return none
            wide = bits // 8 * channels
            x = np.frombuffer(body[: len(body) // wide * wide], kinds[code, bits]).reshape(-1, channels).astype(np.float64).mean(axis=1)
            if code == 1:
                x = (x - 128) / 128 if bits == 8 else x / 2.0 ** (bits - 1)
            return np.nan_to_num(x, nan=0.0, posinf=0.0, neginf=0.0), rate
        at += 8 + size + size % 2
    return none


def write_wav(samples: np.ndarray, rate: int = RATE) -> bytes:
    """16-bit mono WAV of integer samples."""
    body = np.asarray(samples, "<i2").tobytes()
    return b"RIFF" + struct.pack("<I", 36 + len(body)) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, rate, rate * 2, 2, 16) + b"data" + struct.pack("<I", len(body)) + body


def resample(x: np.ndarray, rate: int) -> np.ndarray:
    """Samples at RATE: a moving average against what would fold over, then linear interpolation."""
    if rate == RATE or not len(x):
        return x
    if (wide := round(rate / RATE)) > 1:
        x = np.convolve(x, np.full(wide, 1 / wide), "same")
    return np.interp(np.arange(int(len(x) * RATE / rate)) * (rate / RATE), np.arange(len(x)), x)


def pitch_classes() -> np.ndarray:
    """(spectrum bins, 12): which pitch class a bin counts for."""
    hertz = np.arange(FRAME // 2 + 1) * RATE / FRAME
    out = np.zeros((len(hertz), 12), np.float32)
    bins = np.flatnonzero((hertz >= LOW) & (hertz <= HIGH))
    out[bins, np.round(12 * np.log2(hertz[bins] / 440)).astype(int) % 12] = 1
    return out


_PITCH, _HANN = pitch_classes(), np.hanning(FRAME).astype(np.float32)


def chroma(samples: np.ndarray) -> np.ndarray:
    """(frames, 12) smoothed pitch-class energies of length one; silent frames are zero."""
    if len(samples) < FRAME:
        return np.zeros((0, 12))
    out = []
    frames = np.lib.stride_tricks.sliding_window_view(samples.astype(np.float32), FRAME)[::HOP]
    for at in range(0, len(frames), 512):
        out.append((np.abs(np.fft.rfft(frames[at : at + 512] * _HANN, axis=1)) ** 2) @ _PITCH)
    energy = np.concatenate(out).astype(np.float64)
    if len(energy) < len(SMOOTH):
        return np.zeros((0, 12))
    smooth = sum(w * energy[i : len(energy) - len(SMOOTH) + 1 + i] for i, w in enumerate(SMOOTH))
    length = np.sqrt((smooth**2).sum(axis=1, keepdims=True))
    return np.where(length > 1e-6, smooth / np.maximum(length, 1e-12), 0.0)


def fingerprint(image: np.ndarray) -> np.ndarray:
    """One 32-bit integer for each place where the widest filter fits."""
    n = len(image) - WIDEST + 1
    if n < 1:
        return np.zeros(0, np.uint32)
    sums = np.zeros((len(image) + 1, 13))
    sums[1:, 1:] = image.cumsum(axis=0).cumsum(axis=1)
    start = np.arange(n)

    def area(t0: int, t1: int, p0: int, p1: int) -> np.ndarray:
        return sums[start + t1, p1] - sums[start + t0, p1] - sums[start + t1, p0] + sums[start + t0, p0]

    out = np.zeros(n, np.uint32)
    for kind, first, tall, wide in FILTERS:
        top, middle, half = first + tall, first + tall // 2, (wide + 1) // 2
        if kind == 0:  # all of it against what lies outside it
            a, b = area(0, wide, first, top), area(0, wide, 0, 12) - area(0, wide, first, top)
        elif kind == 1:  # upper against lower pitches
            a, b = area(0, wide, middle, top), area(0, wide, first, middle)
        elif kind == 2:  # later against earlier frames
            a, b = area(half, wide, first, top), area(0, half, first, top)
        else:  # crosswise
            a = area(0, half, first, middle) + area(half, wide, middle, top)
            b = area(0, half, middle, top) + area(half, wide, first, middle)
        step = np.searchsorted(BOUNDS, np.log((a + 0.01) / (b + 0.01)), side="right").astype(np.uint32)
        out = out << np.uint32(2) | (step ^ step >> np.uint32(1))
    return out


def fingerprint_wav(data: bytes | None) -> np.ndarray:
    samples, rate = read_wav(data)
    return fingerprint(chroma(resample(samples, rate)))


def bit_errors(a: np.ndarray, b: np.ndarray, offset: int) -> tuple[float, int]:
    """Share of differing bits where b, moved back by offset, lies over a; and how many frames that are."""
    lo, hi = max(0, -offset), min(len(a), len(b) - offset)
    if hi <= lo:
        return 1.0, 0
    return int(np.bitwise_count(a[lo:hi] ^ b[lo + offset : hi + offset]).sum()) / (32 * (hi - lo)), hi - lo


class Index:
    """The parts of the integers of some prints: which print has them, and where."""

    def __init__(self, prints: list[np.ndarray]):
        self.sizes = np.array([len(p) for p in prints], np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.longest = int(self.sizes.max(initial=0))
        self.values = np.concatenate([*prints, np.zeros(0, np.uint32)])
        keys = parts_of(self.values)
        owner = np.repeat(np.arange(len(prints)), [len(p) for p in prints])
        place = np.concatenate([*(np.arange(len(p)) for p in prints), np.zeros(0, np.int64)])
        order = np.argsort(keys.ravel(), kind="stable")
        self.start = np.searchsorted(keys.ravel()[order], np.arange(len(PARTS) * _PART + 1))
        self.owner, self.place = (np.tile(x, len(PARTS))[order] for x in (owner, place))

    def offsets(self, query: np.ndarray, votes: int = VOTES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(print, offset, votes) of every offset with that many votes."""
        keys = parts_of(query).ravel()
        lo, size = self.start[keys], self.start[keys + 1] - self.start[keys]
        at = np.repeat(lo - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
        wide = len(query) + self.longest
        code = self.owner[at] * wide + self.place[at] - np.repeat(np.tile(np.arange(len(query)), len(PARTS)), size) + len(query)
        if len(self.sizes) * wide <= 1 << 22:
            count = np.bincount(code)
            found = np.flatnonzero(count >= votes)
            count = count[found]
        else:
            found, count = np.unique(code, return_counts=True)
            found, count = found[count >= votes], count[count >= votes]
        return found // wide, found % wide - len(query), count


def parts_of(values: np.ndarray) -> np.ndarray:
    """(parts, values): each part as a number of its own."""
    return np.stack([k * _PART + ((values >> np.uint32(low)) & np.uint32((1 << bits) - 1)).astype(np.int64) for k, (low, bits) in enumerate(PARTS)])


def better(share: float, overlap: int, offset: int) -> tuple[float, int, int]:
    """Orders offsets: by the bits that agree beyond chance, then nearest to zero."""
    return -overlap * (0.5 - share), abs(offset), offset


def alignments(query: np.ndarray, index: Index, batch: int = 4096) -> Iterator[tuple[int, int, int, float, int]]:
    """(which print, offset, votes, bit error share, overlap) of the prints that match, each at its best offset."""
    if not len(query) or not index.longest:
        return
    which, off, votes = index.offsets(query)
    overlap = np.minimum(len(query), index.sizes[which] - off) - np.maximum(0, -off)
    long = overlap >= OVERLAP
    which, off, votes, overlap = which[long], off[long], votes[long], overlap[long]
    best: dict[int, tuple] = {}
    for at in range(0, len(which), batch):
        w, o, n, v = (x[at : at + batch] for x in (which, off, overlap, votes))
        # The frames of all pairs one after another.
        frame = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - np.maximum(0, -o), n)
        differ = np.bitwise_count(query[frame] ^ index.values[np.repeat(index.begins[w] + o, n) + frame])
        share = np.add.reduceat(differ.astype(np.int64), np.cumsum(n) - n) / (32 * n)
        for k in np.flatnonzero(share <= ERRORS).tolist():
            told = (better(float(share[k]), int(n[k]), int(o[k])), int(o[k]), int(v[k]), float(share[k]), int(n[k]))
            if (x := int(w[k])) not in best or told < best[x]:
                best[x] = told
    for x in sorted(best):
        yield x, *best[x][1:]


def fingerprints(recordings: DataFrame, id_col: str = "rec_id", audio_col: str = "audio") -> DataFrame:
    """rec_id and fp (packed 32-bit integers, little-endian) of every row."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint_wav(x.as_py()).astype("<u4").tobytes() for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.binary())], names=["rec_id", "fp"])

    return recordings.select(F.col(id_col).cast("long").alias("rec_id"), F.col(audio_col).cast("binary").alias("audio")).mapInArrow(scan, "rec_id long, fp binary")


def _blocks(name: str, rows: int):
    """A function for mapInArrow that packs (id, fp) rows into blocks."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                ids, fps = (batch.column(i).slice(at, rows).to_pylist() for i in (0, 1))
                columns = [pa.array([ids], pa.list_(pa.int64())), pa.array([fps], pa.list_(pa.binary()))]
                yield pa.RecordBatch.from_arrays(columns, names=[f"{name}_ids", f"{name}_fps"])

    return pack


def match_recordings(prints: DataFrame, queries: DataFrame, block_rows: int = 2048, query_rows: int = 64, among: bool = True) -> DataFrame:
    """Members and matches of ``prints`` (rec_id, fp), for ``queries`` (rec_id, fp), which are rows of prints (``among``) or other recordings.

    Rows of kind ``member``: rec_id and its class_id (the smallest rec_id with its fingerprint). Rows of kind ``match``: a query's
    rec_id, class_id of a class that matches, others (its recordings, but for the query itself where it is among them), offset (frames by which the class lies later), votes,
    bit_errors (share) and overlap (frames).
    """
    spark = prints.sparkSession
    lanes = int(spark.conf.get("spark.sql.shuffle.partitions"))
    prints = prints.where("rec_id IS NOT NULL")
    key = F.sha2("fp", 256).alias("key")
    classes = durable(prints.groupBy(key).agg(F.min("rec_id").alias("class_id"), F.count("*").alias("size"), F.first("fp").alias("fp")))
    members = skew_join(prints.select("rec_id", key), classes.select("key", "class_id"), "key").select("rec_id", "class_id")

    # Queries of one fingerprint are searched as one, under the smallest of their ids.
    asked = durable(queries.where("rec_id IS NOT NULL").groupBy("rec_id").agg(F.min("fp").alias("fp")).select("rec_id", key, "fp"))
    sought = asked.groupBy("key").agg(F.min("rec_id").alias("asked"), F.first("fp").alias("fp"))
    lane = F.pmod(F.xxhash64("d_ids"), F.lit(lanes)).cast("int").alias("lane")
    right = classes.where(F.octet_length("fp") > 0).select("class_id", "fp").mapInArrow(_blocks("d", block_rows), "d_ids array<long>, d_fps array<binary>").select("*", lane)
    left = sought.where(F.octet_length("fp") > 0).select("asked", "fp").mapInArrow(_blocks("q", query_rows), "q_ids array<long>, q_fps array<binary>").select("*", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))).alias("lane"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                ids, fps, q_ids, q_fps = (batch.column(i)[row].as_py() for i in range(4))
                data = [np.frombuffer(x, "<u4") for x in fps]
                index = Index(data)
                out = [(q, ids[w], o, v, round(s, 9), n) for q, f in zip(q_ids, q_fps, strict=True) for w, o, v, s, n in alignments(np.frombuffer(f, "<u4"), index)]
                columns = list(zip(*out, strict=True)) or [[]] * 6
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["asked", "found", "offset", "votes", "bit_errors", "overlap"])

    met = right.join(left, "lane").select("d_ids", "d_fps", "q_ids", "q_fps").mapInArrow(search, "asked long, found long, offset int, votes int, bit_errors double, overlap int")
    sizes = classes.select(F.col("class_id").alias("found"), F.col("key").alias("found_key"), F.col("size").alias("n"))
    matches = skew_join(skew_join(met, sizes, "found"), sought.select("asked", "key"), "asked")
    # Each class's matches are written out for the queries in it, which the query set bounds.
    per_query = asked.select("rec_id", "key").join(matches, "key")
    own = (F.col("key") == F.col("found_key")).cast("long") if among else F.lit(0)
    others = (F.col("n") - own).alias("others")
    told = per_query.select(F.lit("match").alias("kind"), "rec_id", F.col("found").alias("class_id"), others, "offset", "votes", "bit_errors", "overlap").where("others > 0")
    return members.select(F.lit("member").alias("kind"), "rec_id", "class_id").unionByName(told, allowMissingColumns=True)


def sonify(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", delay: int = 0, noise: float = 0.0) -> DataFrame:
    """Recordings (rec_id, audio) made from vectors, as a source of audio for tables without any: a component is a note, and
    ``id mod 5`` notes of silence lead in, so equal vectors sound alike at several offsets. Missing components are rests. ``delay`` samples of silence and noise of that share of the
    recording's strength, the same each time for an id, make another recording of the same."""
    time = np.arange(HOP) / RATE
    notes = [np.round(9000 * (np.sin(2 * np.pi * 220 * 2 ** (k / 12) * time) + 0.4 * np.sin(4 * np.pi * 220 * 2 ** (k / 12) * time))).astype("<i2") for k in range(12)]
    notes.append(np.zeros(HOP, "<i2"))

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.stack(notes)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                out = []
                for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    x = np.array(v or [], np.float64)
                    pitch = np.where(np.isfinite(x), np.floor(np.nan_to_num(x, posinf=0, neginf=0) * 16) % 12, 12).astype(int)
                    sound = table[np.concatenate([np.full((i or 0) % 5, 12), pitch])].reshape(-1)
                    if delay or noise:
                        sound = np.concatenate([np.zeros(delay), sound])
                        hiss = np.random.default_rng(abs(i or 0)).standard_normal(len(sound))
                        sound = np.clip(np.round(sound + hiss * noise * np.sqrt(np.square(sound).mean() if len(sound) else 0)), -32768, 32767)
                    out.append(None if v is None else write_wav(sound))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["rec_id", "audio"])

    return vectors.select(F.col(id_col).cast("long").alias("rec_id"), F.col(vector_col).cast("array<double>")).mapInArrow(render, "rec_id long, audio binary")
