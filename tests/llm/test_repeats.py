from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest

from colonnade.llm import repeats
from colonnade.llm.suffix import repeated_starts, suffix_array

DOCS = "doc_id long, text string, id string, body string"


def test_suffix_array_against_sorting():
    rng = random.Random(0)
    for _ in range(2000):
        text = [rng.randrange(rng.choice([1, 2, 3, 5])) for _ in range(rng.randint(0, 30))]
        assert suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])
    for text in ([0] * 500, [0, 1] * 300, list(range(400)), list(range(400))[::-1]):
        assert suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def test_repeated_starts_against_counting():
    rng = random.Random(1)
    for _ in range(200):
        pieces = [bytes(rng.choices(b"ab\x00\xff", k=rng.randint(0, 40))) for _ in range(rng.randint(1, 4))]
        length = rng.randint(1, 8)
        count = Counter(p[i : i + length] for p in pieces for i in range(len(p) - length + 1))
        assert [m.tolist() for m in repeated_starts(pieces, length)] == [[count[p[i : i + length]] > 1 for i in range(len(p) - length + 1)] for p in pieces]


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    count = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if count[d[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(d, gone, strict=True) if not g)
        runs = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(d), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdeé", k=rng.randint(1, 6)))
    passages = [" ".join(word() for _ in range(rng.randint(4, 30))) for _ in range(6)]
    texts = []
    for _ in range(70):
        parts = [" ".join(word() for _ in range(rng.randint(0, 30)))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            cut = rng.randint(0, len(p) // 2) if rng.random() < 0.4 else 0
            parts += [p[cut:], " ".join(word() for _ in range(rng.randint(0, 20)))]
        texts.append(" ".join(parts))
    near = [t[: len(t) // 2] + "X" + t[len(t) // 2 :] for t in texts[:10]]
    return [*texts, *near, *texts[:4], "ab" * 200, "tick " * 80, "tick " * 50, "", None, "é" * 90]


@pytest.mark.parametrize("crowd", [1, 5, 64])
@pytest.mark.parametrize("length, gram", [(40, 12), (25, 25)])
def test_query_against_brute_force(spark, length, gram, crowd):
    texts = corpus(crowd)
    rows = [(i if i != 5 else None, t, "x", "y") for i, t in enumerate(texts)] + [(3, texts[3], "x", "y")]
    texts = [*texts, texts[3]]
    got = sorted(map(tuple, repeats.digests(spark.createDataFrame(rows, DOCS).repartition(5), length, gram, crowd).collect()), key=str)
    assert got == sorted(((r[0], *b) for r, b in zip(rows, brute(texts, length), strict=True)), key=str)


def test_crowds_are_cut_by_longer_anchors(spark, monkeypatch):
    """A short line in texts that share nothing else fills an anchor's crowd, but repeats nothing; a long one repeats up to its edges. Cores leave few tiles of either."""
    rng = random.Random(3)
    some = lambda n: "".join(rng.choices("abcdefgh ", k=n))
    short, long = some(30), some(110)
    texts = [f"{some(100)}{rng.choice([short, long])}{some(100)}" for _ in range(300)]
    made: Counter = Counter()
    frame = type(spark.range(0))
    plain = frame.mapInArrow

    def counted(self, f, schema, *a, **b):
        total = spark.sparkContext.accumulator(0)
        made[f.__name__] = total

        def g(batches):
            for x in f(batches):
                total.add(x.num_rows)
                yield x

        return plain(self, g, schema, *a, **b)

    monkeypatch.setattr(frame, "mapInArrow", counted)
    got = sorted(map(tuple, repeats.digests(spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)], DOCS).repartition(5), 80, 16, 8).collect()))
    assert got == sorted((i, *b) for i, b in enumerate(brute(texts, 80)))
    assert 0 < made["tiles"].value < 12 * len(texts)


def test_long_texts_are_read_in_segments(monkeypatch):
    monkeypatch.setattr(repeats, "SEGMENT", 500)
    text = " ".join(str(i * i) for i in range(800)).encode()
    covered = sorted(i for r in repeats.runs([b"short", text], 40, 12) for k, lo, n in zip(r["text"], r["lo"], r["n"], strict=True) if k == 1 for i in range(lo, lo + n))
    assert covered == list(range(len(text) - 39))


def test_empty_table(spark):
    assert repeats.digests(spark.createDataFrame([], DOCS)).count() == 0
