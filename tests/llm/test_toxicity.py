from __future__ import annotations

import random
from zlib import crc32

import numpy as np
import pytest

from colonnade.llm import toxicity

DOCS = "doc_id long, text string, score string, row string"
BAD = ["vile", "rotten", "creep"]


def corpus(n, seed=3):
    rng = random.Random(seed)
    common = [f"{a}{b}" for a in ("la", "mo", "ti", "ren", "sof") for b in ("na", "ku", "ster", "pel", "vin", "dra")]
    texts, labels = [], []
    for i in range(n):
        words = rng.choices(common, k=rng.randint(3, 150))
        bad = i % 3 == 0
        for _ in range(max(1, len(words) // 30) if bad else 0):
            words.insert(rng.randrange(len(words) + 1), rng.choice(BAD) + rng.choice(["", ".", "!!"]))
        texts.append(" ".join(words))
        labels.append(int(bad))
    return texts, labels


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    texts, labels = corpus(6)
    known = {g: i for i, g in enumerate(sorted({g for t in texts for word in t.split() for g in toxicity.grams(word)}), 1)}
    spellings = toxicity.Spellings(known)
    index = np.concatenate([toxicity.windows(spellings.ids(t.split())) for t in texts])
    rows = np.array(spellings.rows, np.int32)
    w = {k: v.astype(np.float64) for k, v in toxicity.fresh(len(known)).items()}
    w["evidence"] = rng.standard_normal(len(known) + 1)
    shown = np.ones((len(rows), 1))
    d = rng.standard_normal(len(index))

    def loss():
        return float(toxicity.forward(w, toxicity.project(w, toxicity.embed(w, rows)), index) @ d)

    keep = {}
    toxicity.forward(w, toxicity.project(w, x := toxicity.embed(w, rows)), index, keep)
    grads = toxicity.backward(w, x, shown, rows, keep, d)
    for name in ("inp", "fore", "back", "look", "pick", "out", "out0", "inp0", "look0", "word", "char"):
        flat = w[name].reshape(-1)
        for at in rng.choice(len(flat), 3) if name not in ("word", "char") else [toxicity.WIDTH * int(rows[1, 0 if name == "word" else 1]) + 1]:
            before = flat[at]
            flat[at] = before + 1e-2
            up = loss()
            flat[at] = before - 1e-2
            down = loss()
            flat[at] = before
            assert grads[name].reshape(-1)[at] == pytest.approx((up - down) / 2e-2, rel=0.05, abs=0.02), name


def test_evidence_tells_the_classes_apart():
    texts, labels = corpus(90)
    known = toxicity.common_grams(texts)
    told = toxicity.evidence(texts, labels, known)
    assert told[0] == 0 and min(told[known[f"={w}"]] for w in BAD) > 1 > np.abs(told[known["=lana"]])


def test_every_word_is_in_a_window():
    for n in (0, 1, 31, 32, 33, 56, 57, 500):
        ids = np.arange(1, n + 1)
        assert set(toxicity.windows(ids).reshape(-1)) - {0} == set(ids)


def test_every_character_is_read():
    def read(text):
        return "".join(sorted({c for w in toxicity.tokens(text) for g in toxicity.grams(w)[1:] for c in g.strip("<>")}))

    assert toxicity.tokens("It's a plain, (short) text!! -- 1,5|x") == ["It's", "a", "plain,", "(short)", "text!!", "--", "1", "5", "x"]
    for n in range(1, 60):
        letters = "".join(chr(0x4E00 + i) for i in range(n))
        assert read(letters) == letters
        latin = "".join(chr(0x3B1 + i) if i < 17 else chr(0x430 + i - 17) for i in range(min(n, 49)))
        assert read(latin) == "".join(sorted(latin))
    assert {"vile", "creep"} <= set(toxicity.tokens("some,vile_words-creep")) and {"<坏人", "<他是"} <= {g for w in toxicity.tokens("我们说他是一个坏人。今天") for g in toxicity.grams(w)}


def test_toxic_words_count_in_unspaced_text():
    rng = random.Random(8)
    common = [chr(0x4E00 + i) + chr(0x4F00 + i) for i in range(60)]
    texts, labels = [], []
    for i in range(300):
        words = rng.choices(common, k=rng.randint(20, 60))
        if i % 3 == 0:
            for _ in range(3):
                words.insert(rng.randrange(5, len(words) - 5), "坏蛋")
        texts.append("".join(words))
        labels.append(int(i % 3 == 0))
    model = toxicity.train(texts[:200], labels[:200], 0.33)
    told = toxicity.scores(model.weights, texts[200:], toxicity.Spellings(model.known)) >= 0.5
    assert np.mean(told == np.array(labels[200:], bool)) >= 0.95


def test_held_out_accuracy(spark):
    texts, labels = corpus(600)
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)] + [(None, None, "", ""), (900, "", "", ""), (901, " la na " * 5000, "", "")], DOCS)
    told = spark.createDataFrame([*((i, y, 1) for i, y in enumerate(labels)), (5, None, 1), (None, 1, 1)], "doc_id long, toxic int, quality int")
    rows = toxicity.score(docs, told).collect()
    assert len(rows) == 603 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in rows)
    by = {r["doc_id"]: r for r in rows}
    assert all(by[i]["held_out"] == (crc32(str(i).encode()) % 3 == 1) for i in range(600))
    held = [i for i in range(600) if by[i]["held_out"]]
    assert sum(by[i]["predicted"] == labels[i] for i in held) / len(held) >= 0.95
    assert by[None]["score"] == by[900]["score"] and not by[901]["predicted"]
    kept = toxicity.clean(docs, told)
    assert kept.columns == docs.columns and sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(r["doc_id"]) for r in rows if not r["predicted"])
    again = {r["doc_id"]: r["score"] for r in toxicity.score(docs, told).collect()}
    assert again == {k: r["score"] for k, r in by.items()}


def test_no_labels_and_no_rows(spark):
    told = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r["score"] for r in toxicity.score(spark.createDataFrame([(1, "a", "", "")], DOCS), told).collect()] == [0.0]
    assert toxicity.score(spark.createDataFrame([], DOCS), told).count() == 0
