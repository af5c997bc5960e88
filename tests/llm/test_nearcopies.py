from __future__ import annotations

import random

import corpus_pipeline
from colonnade.llm import nearcopies

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def brute_roots(texts, likeness=0.8):
    sets = []
    for t in texts:
        w = (t or "").lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))})
    names = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            if len(a & sets[j]) / len(a | sets[j]) >= likeness and names[i] != names[j]:
                old, new = max(names[i], names[j]), min(names[i], names[j])
                names = [new if n == old else n for n in names]
    return names


def test_stage_finds_all_pairs_of_the_bound(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(300)]
    texts = [" ".join(rng.choices(words, k=rng.randint(5, 300))) for _ in range(30)]
    for base in texts[:30]:
        for changes in (1, 2, 4, 8):
            copy = base.split()
            for _ in range(changes):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(999)}"
            texts.append(" ".join(copy))
    crowd = rng.choices(words, k=200)
    texts += [" ".join([*crowd[:i], f"y{i}", *crowd[i + 1 :]]) for i in range(80)]
    texts += [None, "", " \t", "one two", "One  two", "one three"]
    roots = brute_roots(texts)
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], DOCS).repartition(4)
    kept = {r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()}
    assert kept == {i for i, r in enumerate(roots) if r == i} and len(kept) < len(texts) - 100


def test_a_star_of_copies_and_copies_of_copies(spark):
    """Copies of one text with so many changes that most are like the text or nothing, versions of it with copies of their own, cut and lengthened ones."""
    rng = random.Random(11)
    words = [f"w{i}" for i in range(500)]
    base = rng.choices(words, k=150)

    def changed(text, n):
        out = list(text)
        for _ in range(n):
            at = rng.randrange(len(out))
            kind = rng.randrange(3)
            out[at : at + (kind != 1)] = [] if kind == 2 else [f"n{rng.randrange(10**6)}"]
        return out

    version = changed(base, 6)
    texts = [changed(base, rng.randint(1, 7)) for _ in range(160)] + [changed(version, rng.randint(1, 5)) for _ in range(100)]
    texts += [base[: rng.randint(90, 150)] for _ in range(30)] + [base + rng.choices(words, k=rng.randint(1, 60)) for _ in range(30)]
    rng.shuffle(texts)
    texts = [" ".join(t) for t in texts]
    roots = brute_roots(texts)
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], DOCS).repartition(4)
    kept = {r["doc_id"] for r in nearcopies.representatives(docs).collect()}
    assert kept == {i for i, r in enumerate(roots) if r == i} and 20 < len(kept) < 250


def test_overlap_of_differences_decides():
    rng = nearcopies.np.random.default_rng(3)
    c = 0.2 / 1.8
    for _ in range(300):
        hub, x, y = (nearcopies.np.unique(rng.integers(0, 60, rng.integers(1, 60))).astype("<u8") for _ in range(3))
        (dx, gx, bound), (dy, gy, _) = (nearcopies.difference(z.tobytes(), hub.tobytes(), 0.8) for z in (x, y))
        like = lambda a, b: len(set(a) & set(b)) / len(set(a) | set(b))
        if abs(like(x, y) - 0.8) > 1e-9:
            assert (like(x, y) >= 0.8) == (len(set(dx) & set(dy)) >= (gx + gy) / 2)
        if abs(like(x, hub) - 0.8) > 1e-9:
            assert (like(x, hub) >= 0.8) == (gx <= bound) and abs(bound - c * len(hub)) < 1e-9


def test_any_column_name_rides_along(spark):
    docs = spark.createDataFrame([(1, "a b", 2, 3, 4), (2, "a b", 5, 6, 7), (None, None, 8, 9, 10)], "doc_id long, text string, `a.b` int, `row` int, `t``x` int")
    assert sorted(map(tuple, nearcopies.representatives(docs).collect()), key=str) == [(1, "a b", 2, 3, 4), (None, None, 8, 9, 10)]


def test_long_texts_are_compared_whole(spark):
    rng = random.Random(6)
    words = [f"w{rng.randrange(9999)}" for _ in range(60_000)]
    near = words[:59_000] + [f"z{i}" for i in range(1000)]
    far = words[:40_000] + [f"y{i}" for i in range(20_000)]
    docs = spark.createDataFrame([(i, " ".join(t), "en", "s", 0) for i, t in enumerate((words, near, far))] + [(3, "x" * 3_000_000, "en", "s", 0)], DOCS)
    assert {r["doc_id"] for r in nearcopies.representatives(docs).collect()} == {0, 2, 3}


def test_the_bound_is_verified():
    pack = lambda *x: nearcopies.np.array(x, "<u8").tobytes()
    assert nearcopies.alike(pack(1, 2, 3, 4), pack(1, 2, 3, 4, 5), 0.8) and not nearcopies.alike(pack(1, 2, 3, 4), pack(1, 2, 3, 5), 0.8)
    assert nearcopies.bands(nearcopies.shingles(b"")) == []


def test_no_bands_are_sent_to_the_driver(spark, sent_to_all):
    nodes = spark.createDataFrame([(n, [32 * max(n, 1) + k for k in range(32)]) for n in range(300)], "node long, keys array<long>").repartition(4, "node")
    met = nearcopies.met_in_bands(nodes)
    assert met.count() == 64 and {r["node"] for r in met.collect()} == {0, 1}
    assert sent_to_all() < 300 * 32
