"""The pipeline's stages against brute force on a small corpus."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import duckdb
import public_tokenizers as public
import pytest
import tiktoken
from pyspark.sql import functions as F
from test_nearcopies import brute_roots

import corpus_pipeline
from colonnade.llm import bpe, mixing, repeats, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
BAD = ["vile", "rotten", "creep"]


def corpus(n=260, seed=11):
    rng = random.Random(seed)
    words = [a + b + c for a in ("la", "mo", "ti", "re") for b in ("na", "ku", "ster", "pel") for c in ("", "s", "li")]
    passage = " ".join(rng.choices(words, k=60))
    texts, toxic = [], []
    for i in range(n):
        body = rng.choices(words, k=rng.randint(20, 160))
        bad = i % 4 == 0
        for _ in range(len(body) // 12 if bad else 0):
            body.insert(rng.randrange(len(body)), rng.choice(BAD))
        text = " ".join(body)
        if i % 9 == 1:
            text += " " + passage + " " + " ".join(rng.choices(words, k=5))
        texts.append(text)
        toxic.append(int(bad))
    texts[21], texts[22], texts[23] = texts[13], texts[13] + " ", "é" * 150 + texts[26]
    texts[25] = texts[14].rsplit(" ", 1)[0] + " changed"
    rows = [(i, t, rng.choice(["en", "de", None]), rng.choice(["a", "a", "b"]), len(t)) for i, t in enumerate(texts)]
    return [*rows, (n, None, "en", "a", None), (n + 1, "", "en", "b", 0)], [(i, 1, y) for i, y in enumerate(toxic)]


def without_repeats(texts, length=200):
    data = [(t or "").encode() for t in texts]
    count = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if count[d[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        out.append(bytes(x for x, g in zip(d, gone, strict=True) if not g).decode("utf-8", "ignore"))
    return out


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("corpus"))
    documents, labels = corpus()
    spark.createDataFrame(documents, DOCS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").coalesce(1).write.parquet(f"{folder}/labels.parquet")
    return folder, documents


def test_pipeline_against_brute_force(spark, tables):
    folder, documents = tables
    got = corpus_pipeline.run(spark, folder).collect()

    read = lambda name: spark.read.parquet(f"{folder}/{name}.parquet")
    model = toxicity.learn(read("documents"), read("labels"))
    scores = toxicity.scores(model.weights, [d[1] or "" for d in documents], toxicity.Spellings(model.known))
    clean = [d for d, s in zip(documents, scores, strict=True) if s < toxicity.THRESHOLD]
    assert 0.6 * len(documents) < len(clean) < 0.9 * len(documents)

    names = brute_roots([d[1] for d in clean])
    kept = [d for i, d in enumerate(clean) if names[i] == i]
    assert {13, 14} <= {d[0] for d in kept} and not {21, 22, 25} & {d[0] for d in kept}

    rest = without_repeats([d[1] for d in kept])
    assert rest != [d[1] or "" for d in kept]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", [(d[0], t, d[2], d[3], len(t)) for d, t in zip(kept, rest, strict=True)])
    mixed = {i for (i,) in con.execute(mixing.oracle(columns="t.doc_id")).fetchall()}
    assert 0 < len(mixed) < len(kept)

    library = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=bpe.load_ranks(public.path("byte_bpe_50k.tiktoken")), special_tokens={})
    expected = {}
    for d, t in zip(kept, rest, strict=True):
        if d[0] in mixed:
            ids = library.encode_ordinary(t)
            expected[d[0]] = (len(ids), ids, hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
    assert {r["doc_id"]: (r["n_tokens"], r["ids"], r["ids_sha256"], r["decoded_sha256"]) for r in got} == expected and len(got) == len(expected)


def test_stages_keep_the_columns(spark, tables):
    folder, documents = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash near-duplicates", "suffix-array repeats", "mixing", "bpe"]
    for _, stage in corpus_pipeline.STAGES[1:-1]:
        out = stage(spark, docs, folder)
        assert out.schema.simpleString() == docs.schema.simpleString()
        assert stage(spark, docs.limit(0), folder).count() == 0
    row = repeats.clean(docs).where("doc_id = 23").first()
    assert row["n_chars"] == len(row["text"])


def test_one_row_of_equal_rows_stays(spark):
    from colonnade.llm import simhash

    rows = [(1, "a b c d", "en", "s", 7)] * 3 + [(None, "x y z w", "en", "s", 7)] * 2 + [(5, None, "de", "s", None), (4, " ", None, None, 1)]
    out = simhash.representatives(spark.createDataFrame(rows, DOCS).repartition(4)).orderBy(F.col("doc_id").asc_nulls_last()).collect()
    assert [(r["doc_id"], r["text"]) for r in out] == [(1, "a b c d"), (4, " "), (None, "x y z w")]
