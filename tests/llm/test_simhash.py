from __future__ import annotations

import random
import re

import xxhash

from colonnade.llm import simhash
from colonnade.llm.components import components

DOCS = "doc_id long, text string, fp long, root string"


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(values, bits=2):
    names = list(range(len(values)))
    for i, a in enumerate(values):
        for j in range(i):
            if bin(a ^ values[j]).count("1") <= bits and names[i] != names[j]:
                old, new = max(names[i], names[j]), min(names[i], names[j])
                names = [new if n == old else n for n in names]
    return names


def sign(x):
    return x - (1 << 64) if x >> 63 else x


def test_fingerprint_is_the_contract():
    for text in ("", " \t\n", "One", "One two", "A b C d e f", "Éa É b x\x0by", "tick tock " * 50):
        assert simhash.fingerprint(text.encode()) % 2**64 == brute_fingerprint(text)


def test_long_texts_are_hashed_whole():
    rng = random.Random(5)
    for n in (65_537, 65_538, 65_539, 150_000):
        text = " ".join(f"w{rng.randrange(9999)}" for _ in range(n))
        assert simhash.fingerprint(text.encode()) % 2**64 == brute_fingerprint(text)
    assert simhash.fingerprint(b"x" * 3_000_000) % 2**64 == brute_fingerprint("x" * 3_000_000)


def test_query_against_brute_force(spark):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(50)]
    base = [" ".join(rng.choices(words, k=rng.randint(1, 400))) for _ in range(40)]
    near = [b + " end" for b in base[:15]] + [" ".join(b.split()[1:]) for b in base[:15]]
    texts = [*base, *near, *base[:5], None, "", "  "]
    rows = [(None if i == 3 else i, t, 1, "r") for i, t in enumerate(texts)]
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(spark.createDataFrame(rows, DOCS), bucket=4).collect()}
    prints = [brute_fingerprint(t) for t in texts]
    names = brute_components(prints)
    for i, name in enumerate(names):
        least = min(j for j, n in enumerate(names) if n == name and j != 3)
        assert got[None if i == 3 else i] == (f"{prints[i]:016x}", least)


def linked(spark, values, bits, bucket):
    edges = [tuple(r) for r in simhash.links(spark.createDataFrame([(sign(v),) for v in values], "fp long"), bits, bucket).collect()]
    at = {sign(v): i for i, v in enumerate(values)}
    assert all(bin((a ^ b) % 2**64).count("1") <= bits for a, b in edges)
    names = list(range(len(values)))
    for a, b in edges:
        old, new = max(names[at[a]], names[at[b]]), min(names[at[a]], names[at[b]])
        names = [new if n == old else n for n in names]
    return names


def test_hot_variants_lose_no_link(spark):
    rng = random.Random(2)
    centre = rng.getrandbits(64)
    values = {centre} | {centre ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(150)} | {rng.getrandbits(64) for _ in range(30)}
    values = sorted(values)
    for bits in (0, 1, 2):
        for bucket in (2, 32):
            assert linked(spark, values, bits, bucket) == brute_components(values, bits)


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (103, 101), (7, 7), (None, 5)] + [(200, 200 + i) for i in range(1, 30)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**dict.fromkeys(range(1, 41), 1), **dict.fromkeys((100, 101, 103), 100), **dict.fromkeys(range(200, 230), 200)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_empty_table(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], DOCS)).count() == 0


def test_no_variants_are_sent_to_the_driver(spark, sent_to_all):
    rng = random.Random(6)
    values = {rng.getrandbits(64) for _ in range(300)}
    values |= {v ^ 1 << rng.randrange(64) for v in list(values)[:100]}
    fps = spark.createDataFrame([(sign(v),) for v in values], "fp long")
    for bucket in (1, 32):
        assert simhash.links(fps, bucket=bucket).count() >= 100
    assert sent_to_all() <= 32 * len(values)
