"""Mixing, sharding and top-k search."""

from __future__ import annotations

import random
from collections import Counter
from zlib import crc32

import duckdb
import numpy as np
import pytest

from colonnade.llm import mixing, queries, sharding, topk

DOCS = "doc_id long, text string, source string, lang string, n_chars long, probability string, mass string, cell string"


def documents(n=400, seed=5):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        text = " ".join(rng.choices(["aa", "b|", "cc!!", "d%%%"], weights=rng.choice([[9, 1, 0, 0], [1, 9, 0, 0], [1, 0, 9, 0], [1, 0, 0, 9]]), k=rng.randint(0, 300)))
        out.append((i, text, rng.choice(["s0", "s0", "s1", "s2", None]), rng.choice(["en", "de", "xx", None]), len(text), "p", "m", "c"))
    return [*out, (None, None, "s0", "en", 0, "", "", ""), (None, "", "s0", "en", 0, "", "", ""), out[7]]


def test_mixing_against_sql(spark):
    rows = documents()
    got = mixing.mix(spark.createDataFrame(rows, DOCS)).select("doc_id", "source", "lang", "topic", "tokens", "probability").collect()
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR, lang VARCHAR, n_chars BIGINT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", [r[:5] for r in rows])
    expected = con.execute(mixing.oracle()).fetchall()
    assert sorted(((*r[:5], round(r[5], 6)) for r in map(tuple, got)), key=str) == sorted(expected, key=str)


CELLS = "source string, lang string, topic string, mass long"


def raked(spark, cells, targets, keep=0.5, sweeps=15):
    marked = [(*("" if x is None else f"={x}" for x in c[:3]), c[3]) for c in cells]
    return mixing.probabilities(spark.createDataFrame(marked, CELLS), targets, keep, sweeps).collect()


def stays(rows, d):
    return {v: sum(r["mass"] * r["probability"] for r in rows if r[d] == v) for v in {r[d] for r in rows}}


def test_raked_cells_meet_the_targets(spark):
    rng = random.Random(2)
    cells = [(s, g, t, rng.randint(500, 1000)) for s in "abc" for g in ("en", None) for t in ("x", "y")]
    total = sum(c[3] for c in cells)
    rows = raked(spark, cells, {"source": {"a": 0.7, "b": 0.2}, "lang": 0.0, "topic": 1.0}, keep=0.2)
    assert stays(rows, "source") == pytest.approx({"=a": 0.14 * total, "=b": 0.04 * total, "=c": 0.02 * total}, rel=1e-4)
    assert stays(rows, "lang") == pytest.approx({"=en": 0.1 * total, "": 0.1 * total}, rel=1e-4) and max(r["probability"] for r in rows) < 1


def test_what_cannot_meet_its_target_stays_whole_and_thins_no_other(spark):
    cells = [(s, g, "x", 1000) for s in "abc" for g in ("en", "de")]
    before = stays(raked(spark, cells, {"source": 0.5, "lang": 0.5, "topic": 0.8}), "source")
    rows = raked(spark, [*cells, ("rare", "en", "x", 3), (None, "fr", "x", 1)], {"source": 0.5, "lang": 0.5, "topic": 0.8})
    assert all(r["probability"] == 1 for r in rows if r["source"] in ("=rare", ""))
    assert all(0.9 * n < stays(rows, "source")[s] < n for s, n in before.items())


def test_levels_without_a_name_keep_a_share(spark):
    cells = [(s, g, "x", m) for s in "ab" for g, m in (("en", 400), ("de", 100), ("fr", 50), ("es", 50), ("it", 100), (None, 300))]
    rows = raked(spark, cells, mixing.TARGETS, keep=0.2)
    assert stays(rows, "lang") == pytest.approx({"=it": 40, "": 120, "=en": 120, "=de": 48, "=fr": 48, "=es": 24}, rel=1e-4)
    for lang in ({"en": 1.0, "de": 0.0, "fr": 0.0, "es": 0.0, "it": 0.0}, {"en": 0.0, "de": 0.0}):
        rows = raked(spark, cells, {**mixing.TARGETS, "lang": lang}, keep=0.2, sweeps=3)
        assert all(r["probability"] == 0 for r in rows if lang.get(r["lang"][1:]) == 0.0) and sum(r["probability"] for r in rows) > 0
    assert {r["probability"] for r in raked(spark, cells, {**mixing.TARGETS, "lang": {g or "": 0.0 for _, g, _, _ in cells} | {"en": 0.0}}, sweeps=2) if r["lang"] != ""} == {0}
    rows = [(i, f"w {i}", "s", ["en", "de", "fr", "es", "it", None][i % 6], 3, "", "", "") for i in range(600)]
    assert {r["lang"] for r in mixing.mix(spark.createDataFrame(rows, DOCS)).collect()} == {"en", "de", "fr", "es", "it", None}
    english = mixing.mix(spark.createDataFrame(rows, DOCS), {**mixing.TARGETS, "lang": {"en": 1.0, "de": 0, "fr": 0, "es": 0, "it": 0}}, sweeps=3).collect()
    assert {r["lang"] for r in english} <= {"en", None}


def test_tables_too_large_to_broadcast_give_the_same(spark, monkeypatch):
    frame = spark.createDataFrame(documents(), DOCS)
    key = lambda r: str(tuple(r))
    few = sorted(mixing.mix(frame, sweeps=3).collect(), key=key)
    monkeypatch.setattr(mixing, "FEW", 8)
    many = sorted(mixing.mix(frame, sweeps=3).collect(), key=key)
    assert [tuple(r)[:-1] for r in many] == [tuple(r)[:-1] for r in few] and [r["probability"] for r in many] == pytest.approx([r["probability"] for r in few])


def test_unmet_marginals_are_told(spark):
    cells = [("a", "en", "x", 100), ("a", "de", "x", 100), ("b", "de", "x", 900)]
    with pytest.warns(UserWarning, match="a marginal is off"):
        raked(spark, cells, {"source": {"a": 0.5, "b": 0.5}, "lang": {"en": 0.5, "de": 0.5}, "topic": 1.0}, keep=0.9, sweeps=1)


def test_rows_of_mix_are_as_they_were(spark):
    docs = spark.createDataFrame([(i, f"w {i}", "s", "en", f"T{i}", 1.5) for i in range(60)], "doc_id long, text string, source string, lang string, topic string, `pro.bability` double")
    got = mixing.rows_of_mix(docs)
    assert got.columns == docs.columns and 10 < got.count() < 50 and all(r["topic"] == f"T{r['doc_id']}" for r in got.collect())


def test_mixing_empty(spark):
    assert mixing.mix(spark.createDataFrame([], DOCS)).count() == 0


def walk(keys, nodes, capacity):
    """Row by row round the ring."""
    used, out = Counter(), []
    for cell in keys:
        order = [s for c, s in nodes if c >= cell] + [s for c, s in nodes if c < cell]
        shard = next(s for s in order if used[s] < capacity[s])
        out.append((cell, shard, used[shard]))
        used[shard] += 1
    return out


def test_ring_against_row_by_row():
    rng = random.Random(3)
    for shards, epsilon in ((1, 0), (5, 0), (7, 0.1), (3, 0.5)):
        keys = sorted(rng.randrange(256) for _ in range(rng.randint(0, 400)))
        nodes, capacity = sharding.virtual_nodes(shards, 8, 256), sharding.capacities(len(keys), shards, epsilon)
        runs = sharding.walk_ring(dict(Counter(keys)), nodes, capacity)
        count = Counter(keys)
        flat = []
        for k, (cell, rank, shard, slot, _) in enumerate(runs):
            stop = runs[k + 1][1] if k + 1 < len(runs) and runs[k + 1][0] == cell else count[cell]
            flat += [(cell, shard, slot + i) for i in range(stop - rank)]
        assert flat == walk(keys, nodes, capacity)


def test_shards(spark):
    rows = documents(1000)
    frame = spark.createDataFrame(rows, DOCS)
    got = sharding.bounded_ring(frame, 16).collect()
    sizes = Counter(r["shard"] for r in got)
    assert len(got) == len(rows) and set(sizes) == set(range(16)) and max(sizes.values()) - min(sizes.values()) <= 1
    for shard, n in sizes.items():
        assert sorted(r["slot"] for r in got if r["shard"] == shard) == list(range(n))
    whole = sharding.bounded_ring(frame.unionByName(frame.where("doc_id = 7").withColumn("c", sharding.F.explode(sharding.F.sequence(sharding.F.lit(1), sharding.F.lit(3000)))).drop("c")), 16, chunk=64).collect()
    assert len(whole) == len(rows) + 6000 and sum(r["doc_id"] == 7 for r in whole) == 6002
    for shard, n in Counter(r["shard"] for r in whole).items():
        assert sorted(r["slot"] for r in whole if r["shard"] == shard) == list(range(n)) and n in (len(whole) // 16, len(whole) // 16 + 1)
    facts = Counter((r[0], len((r[1] or "").encode()) + 1, crc32((r[1] or "").encode())) for r in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == facts
    assert all(r["law"] == "rows" and r["grown_shard"] is None for r in got)
    again = sharding.bounded_ring(frame.repartition(7), 16).collect()
    ids = lambda rs: {(r["doc_id"], r["shard"], r["slot"]) for r in rs if r["doc_id"] not in (None, 7)}
    assert ids(got) == ids(again)
    assert sharding.bounded_ring(spark.createDataFrame([], DOCS)).count() == 0


def test_slack_limits_movement(spark):
    frame = spark.createDataFrame([(i, str(i), "s", "en", 1, "", "", "") for i in range(3000)], DOCS)
    place = lambda df, n: {r["doc_id"]: r["shard"] for r in sharding.bounded_ring(df, n, epsilon=0.25).collect()}
    before, grown = place(frame, 8), place(frame, 9)
    assert max(Counter(before.values()).values()) <= 1.25 * 3000 / 8
    assert sum(before[i] != grown[i] for i in before) < 0.45 * 3000


VECTORS = "vec_id long, embedding array<float>, n int, lane int"


def test_topk_against_brute_force(spark):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((300, 24)).astype(np.float32)
    base[10:60] = base[5]
    rows = [(i, v.tolist(), 1, 2) for i, v in enumerate(base)]
    rows += [(1000, None, 0, 0), (1050, [1.0, None] + [0.0] * 22, 0, 0), (1100, [float("nan")] * 24, 0, 0), (1150, [float("inf")] * 24, 0, 0), (1200, [1.0, 2.0], 0, 0), (1201, [1.0, -2.0], 0, 0), (None, base[0].tolist(), 0, 0), (7, base[7].tolist(), 0, 0)]
    frame = spark.createDataFrame(rows, VECTORS)
    got = {}
    for r in topk.exact_topk(frame, frame.where("vec_id % 50 = 0"), 5, block_rows=64, query_rows=3, step=5).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    fine = [(r[0], np.floor(256 * np.array(r[1], np.float64)).astype(int)) for r in rows if r[0] is not None and r[1] is not None and None not in r[1] and np.isfinite(r[1]).all()]
    expected = {}
    for q, v in {i: v for i, v in fine if i % 50 == 0}.items():
        best = sorted((-int(v @ w), i) for i, w in fine if i != q and len(w) == len(v))[:5]
        expected[q] = {k + 1: (i, -s) for k, (s, i) in enumerate(best)}
    assert got == expected
    assert topk.exact_topk(spark.createDataFrame([], VECTORS), frame).count() == 0


def test_repeated_query_ids_as_in_the_sql(spark):
    rng = np.random.default_rng(6)
    rows = [(i, rng.standard_normal(6).astype(np.float32).tolist(), 1, 2) for i in range(120)]
    rows += [(0, rng.standard_normal(6).astype(np.float32).tolist(), 1, 2), rows[50], rows[7], (50, rows[3][1], 1, 2)]
    frame = spark.createDataFrame(rows, VECTORS)
    got = sorted(map(tuple, topk.exact_topk(frame, frame.where("vec_id % 50 = 0"), 5, block_rows=32, query_rows=2).collect()))
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding FLOAT[])")
    con.executemany("INSERT INTO embeddings VALUES (?, ?)", [r[:2] for r in rows])
    assert got == sorted(con.execute(queries.ORACLE["op5_topk"]).fetchall()) and len(got) == 15


def test_very_long_texts(spark):
    """A text of two million characters, one of a million words in one line, and one that is a single word."""
    texts = ["ab " * 700_000, "\u00e9 " * 1_000_000, "x" * 2_000_000, "short text"]
    rows = [(i, t, "s", "en", len(t), "", "", "") for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, DOCS)
    kept = mixing.mix(frame, {"source": 1.0, "lang": 1.0, "topic": 1.0}, keep=1.0, sweeps=2).collect()
    assert {r["doc_id"]: r["tokens"] for r in kept} == {0: 700_000, 1: 1_000_000, 2: 1, 3: 2}
    placed = sharding.bounded_ring(frame, 2).collect()
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in placed} == {i: (len(t.encode()) + 1, crc32(t.encode())) for i, t in enumerate(texts)}


def test_queries_and_sql_have_names_in_common():
    assert set(queries.ORACLE) <= set(queries.QUERIES) and len(queries.QUERIES) == 10
