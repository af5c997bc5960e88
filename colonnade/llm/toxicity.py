"""Toxicity scores from a bidirectional gated recurrent network with attention pooling, trained and run in numpy.

Inputs of a step are a word's own embedding and the mean of the embeddings of its character grams (prefixes and suffixes), for words and grams that
several training texts have, so spellings never seen still have an input by their grams; and how far a word and its grams tell the classes apart, by counts
over the training sample - while training, over the folds of it that a text is not in, so that no text is told its own label. Words stand between white space;
what is glued by punctuation is parted there, and long words and scripts without spaces are read in pieces too, so every character reaches some input. A text is cut into overlapping windows of ``WINDOW`` words, one every ``STRIDE``;
two recurrent passes read each window, attention pools their states, and a logit comes out. All windows of the whole text count: a
text's score is a logistic function of its highest window logit, the mean of its three highest and the mean window probability.

Training takes a bounded sample of the labelled rows of the training folds (``SAMPLE`` of either class, the first in hash order, no longer than
``SAMPLE_BYTES``), on the driver, in whole-text terms: the loss is on the text, whose windows are pooled by log-mean-exp. The trained
weights have a fixed size and travel to the tasks in the function. Scoring is one scan: no shuffle, and a worker holds a slice of a batch.

Defined results: a null or empty text, or one without words, is one window of padding and gets that window's score; scores do not depend on
doc_id, lang, source or labels; repeated rows get equal scores; a null doc_id counts as the text ``''`` for held_out; where a class has no
labelled row in the training folds, all scores are 0; labels that are null are left out, and of several for one id the highest counts; other columns
are ignored, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import string
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import packed_row, trim, unpacked_row

WINDOW, STRIDE = 32, 24
#: Labelled rows of either class, and bytes of a text, for training.
SAMPLE, SAMPLE_BYTES = 1200, 6000
THRESHOLD = 0.7
#: Sizes: embedding, states of one direction, attention.
WIDTH, HIDDEN, LOOK = 8, 8, 8
EPOCHS, BATCH, RATE, SEED = 6, 48, 0.01, 7
#: Spellings whose hashes a worker keeps; it forgets all of them beyond.
MEMO = 150_000
GRAMS = 8
#: Characters of a word that its grams read whole, of a piece, and beyond which a part is taken for several words.
READ, PIECE, MERGED = 10, 6, 20
#: Letters of scripts that do not part words: Thai, Lao, Tibetan, Burmese, Khmer, kana and Han.
_SCRIPTS = "\u0e00-\u0eff\u0f00-\u0fff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9d\U00020000-\U000323af"
_DENSE = re.compile(f"[{_SCRIPTS}]")
#: Vowel signs and marks are no word characters for ``re``, but belong to their words, as apostrophes do.
_MARKS = "'’\u0300-\u036f\u0900-\u0dff\u200c\u200d"
_PARTS = re.compile(rf"(?:[^\W_]|[{_SCRIPTS}{_MARKS}])+")
_WORD = re.compile(rf"[{re.escape(string.punctuation)}]*(?:(?![{_SCRIPTS}])(?:[^\W_]|[{_MARKS}])){{0,{READ}}}[{re.escape(string.punctuation)}]*")
#: Inputs that tell evidence, and the folds of the training texts: a text is told the evidence of the other folds.
FACTS, FOLDS = 4, 5
#: Share of a training batch's spellings that are blanked, and what embeddings lose in a step, in units of the learning rate.
DROP, DECAY = 0.5, 20.0
#: Training texts, and share of them, that a gram must occur in to have an embedding, which keeps the network from learning texts by heart.
LEAST_TEXTS, LEAST_SHARE = 4, 0.006
Weights = dict[str, np.ndarray]


class Model(NamedTuple):
    """The known grams and the weights."""

    known: dict[str, int]
    weights: Weights


def grams(token: str) -> list[str]:
    """What stands for a token: the word, then its prefixes of 2 to 6 and suffixes of 3 and 4 characters."""
    word = token.strip(string.punctuation).lower()
    return [f"={word}", f"<{word[:2]}", f"<{word[:3]}", f"<{word[:4]}", f"<{word[:5]}", f"<{word[:6]}", f"{word[-3:]}>", f"{word[-4:]}>"]


def pieces(token: str) -> list[str]:
    """The words of a token: its parts between punctuation; of a part too long for its grams to read whole, also pieces that
    together hold all its characters, one at every character where the part has no word of its own."""
    out = []
    for part in _PARTS.findall(token):
        bare = part.strip("'’")
        if _DENSE.search(bare) or len(bare) > MERGED:
            out += [bare[i : i + PIECE] for i in range(max(1, len(bare) - 1))]
        elif bare:
            out.append(bare)
            if len(bare) > READ:
                out += [bare[i : i + PIECE] for i in range(PIECE // 2, len(bare) - 4, PIECE // 2)]
    return out or [token]


def tokens(text: str) -> list[str]:
    """The words of a text: what stands between white space, in pieces where that is more than a word."""
    words = text.split()
    odd = {w: pieces(w) for w in set(words) if not _WORD.fullmatch(w)}
    return [x for w in words for x in odd.get(w, (w,))] if odd else words


def common_grams(texts: list[str]) -> dict[str, int]:
    """Numbers from 1 for the grams that at least so many texts have. All others are number 0, whose embedding stays zero."""
    count: Counter[str] = Counter()
    for text in texts:
        count.update({g for word in set(tokens(text)) for g in grams(word)})
    least = max(LEAST_TEXTS, LEAST_SHARE * len(texts))
    return {g: i for i, g in enumerate(sorted(g for g, n in count.items() if n >= least), 1)}


class Spellings:
    """Numbers for spellings, with the grams of each. Number 0 is padding."""

    def __init__(self, known: dict[str, int]):
        self.known = known
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.rows: list[list[int]] = [[0] * GRAMS]
        self.table = np.empty((0, 6 * HIDDEN), np.float32)

    def gates(self, w: Weights) -> np.ndarray:
        """What each number puts into the gates; only numbers that came since the last call are worked out."""
        have = len(self.table)
        if have <= len(self.number):
            self.table = np.concatenate([self.table, project(w, embed(w, np.array(self.rows, np.int32)))])
            self.rows = []
        return self.table

    def ids(self, words: list[str]) -> np.ndarray:
        number, get = self.number, self.known.get
        for word in set(words).difference(number):
            number[word] = len(number) + 1
            self.rows.append([get(g, 0) for g in grams(word)])
        return np.fromiter(map(number.__getitem__, words), np.int32, len(words))


def windows(ids: np.ndarray) -> np.ndarray:
    """All windows of a text's words, the last one flush with its end; a short text is one padded window."""
    n = len(ids)
    if n <= WINDOW:
        return np.pad(ids, (0, WINDOW - n))[None, :]
    starts = np.append(np.arange(0, n - WINDOW, STRIDE), n - WINDOW)
    return ids[starts[:, None] + np.arange(WINDOW)]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def evidence(texts: list[str], labels: list[int], known: dict[str, int]) -> np.ndarray:
    """How far the shares of texts with a gram differ between the classes: their log odds over its standard error, 0 for unknown grams."""
    n = np.zeros((2, len(known) + 1))
    for text, label in zip(texts, labels, strict=True):
        n[label, list({known[g] for word in set(tokens(text)) for g in grams(word) if g in known})] += 1
    of = np.bincount(labels, minlength=2)[:, None] + 1.0
    n += 0.5
    odds = np.log(n / (of - n))
    z = (odds[1] - odds[0]) / np.sqrt((1 / n + 1 / (of - n)).sum(axis=0))
    z[0] = 0
    return (z / 3).astype(np.float32)


def fresh(known: int, seed: int = SEED) -> Weights:
    rng = np.random.default_rng(seed)
    shape = {"word": (known + 1, WIDTH), "char": (known + 1, WIDTH), "inp": (2 * WIDTH + FACTS, 6 * HIDDEN), "fore": (HIDDEN, 3 * HIDDEN), "back": (HIDDEN, 3 * HIDDEN), "look": (2 * HIDDEN, LOOK), "pick": (LOOK,), "out": (2 * HIDDEN,)}
    scale = {"word": 0.01, "char": 0.01, "inp": 0.4, "fore": 0.3, "back": 0.3, "look": 0.4, "pick": 0.4, "out": 0.4}
    w = {k: (rng.standard_normal(s) * scale[k]).astype(np.float32) for k, s in shape.items()}
    w["word"][0] = w["char"][0] = 0
    return w | {"inp0": np.zeros(6 * HIDDEN, np.float32), "look0": np.zeros(LOOK, np.float32), "out0": np.full(1, -1.0, np.float32)}


def embed(w: Weights, rows: np.ndarray, told: np.ndarray | None = None) -> np.ndarray:
    """The inputs of spellings, given their grams: embeddings, and the evidence of the word and of its character grams (mean, most
    and least). Those of padding are zero, as all its grams are unknown."""
    e = (w["evidence"] if told is None else told)[rows]
    chars = e[:, 1:]
    facts = np.column_stack([e[:, 0], chars.mean(axis=1), chars.max(axis=1), chars.min(axis=1)])
    return np.concatenate([w["word"][rows[:, 0]], w["char"][rows[:, 1:]].mean(axis=1), facts], axis=1)


def project(w: Weights, x: np.ndarray) -> np.ndarray:
    return x @ w["inp"] + w["inp0"]


def recur(gate: np.ndarray, u: np.ndarray, order: range, keep: list | None = None) -> np.ndarray:
    """States of one direction. gate: (steps, windows, 3 * hidden), in the order update, reset, candidate."""
    steps, n, _ = gate.shape
    h, out, size = np.zeros((n, HIDDEN), np.float32), np.empty((steps, n, HIDDEN), np.float32), HIDDEN
    for t in order:
        g, a = gate[t], h @ u
        zr = sigmoid(g[:, : 2 * size] + a[:, : 2 * size])
        z, r = zr[:, :size], zr[:, size:]
        c = np.tanh(g[:, 2 * size :] + r * a[:, 2 * size :])
        if keep is not None:
            keep.append((t, h, z, r, c, a[:, 2 * size :]))
        h = c + z * (h - c)
        out[t] = h
    return out


def forward(w: Weights, gates: np.ndarray, index: np.ndarray, keep: dict | None = None) -> np.ndarray:
    """Logits of windows; index: (windows, WINDOW) rows of gates, 0 for padding."""
    index = index.T
    each = gates[index]
    size = 3 * HIDDEN
    fore_keep, back_keep = ([], []) if keep is not None else (None, None)
    fore = recur(each[:, :, :size], w["fore"], range(WINDOW), fore_keep)
    back = recur(each[:, :, size:], w["back"], range(WINDOW - 1, -1, -1), back_keep)
    h = np.concatenate([fore, back], axis=2)
    seen = np.tanh(h @ w["look"] + w["look0"])
    weigh = seen @ w["pick"] + np.where(index > 0, 0, -30).astype(np.float32)
    weigh = np.exp(weigh - weigh.max(axis=0))
    weigh /= weigh.sum(axis=0)
    pooled = np.einsum("tn,tnh->nh", weigh, h)
    if keep is not None:
        keep.update(index=index, fore=fore_keep, back=back_keep, h=h, seen=seen, weigh=weigh, pooled=pooled)
    return pooled @ w["out"] + w["out0"][0]


def backward(w: Weights, x: np.ndarray, shown: np.ndarray, rows: np.ndarray, k: dict, d: np.ndarray) -> Weights:
    """Gradients of all weights, given those of the window logits."""
    g: Weights = {"out": k["pooled"].T @ d, "out0": d.sum(keepdims=True)}
    d_pooled = d[:, None] * w["out"]
    h, weigh, seen = k["h"], k["weigh"], k["seen"]
    d_weigh = np.einsum("nh,tnh->tn", d_pooled, h)
    d_weigh = weigh * (d_weigh - (weigh * d_weigh).sum(axis=0))
    d_seen = d_weigh[:, :, None] * w["pick"] * (1 - seen * seen)
    g["pick"] = np.einsum("tn,tnl->l", d_weigh, seen)
    g["look"] = np.einsum("tnh,tnl->hl", h, d_seen)
    g["look0"] = d_seen.sum(axis=(0, 1))
    d_h = weigh[:, :, None] * d_pooled + d_seen @ w["look"].T
    size, n = HIDDEN, d.shape[0]
    d_gate = np.zeros((WINDOW, n, 6 * size), np.float32)
    for name, at, part in (("fore", 0, d_h[:, :, :size]), ("back", 3 * size, d_h[:, :, size:])):
        u, later = w[name], np.zeros((n, size), np.float32)
        d_u = np.zeros_like(u)
        for t, before, z, r, c, a in reversed(k[name]):
            dh = part[t] + later
            dc = dh * (1 - z) * (1 - c * c)
            dz = dh * (before - c) * z * (1 - z)
            dr = dc * a * r * (1 - r)
            d_gate[t, :, at : at + 3 * size] = np.concatenate([dz, dr, dc], axis=1)
            through = np.concatenate([dz, dr, dc * r], axis=1)
            d_u += before.T @ through
            later = dh * z + through @ u.T
        g[name] = d_u
    flat = d_gate.reshape(-1, 6 * size)
    per_row = np.zeros((len(x), 6 * size), np.float32)
    np.add.at(per_row, k["index"].reshape(-1), flat)
    g["inp"], g["inp0"] = x.T @ per_row, flat.sum(axis=0)
    d_x = per_row @ w["inp"].T * shown
    g["word"], g["char"] = np.zeros_like(w["word"]), np.zeros_like(w["char"])
    np.add.at(g["word"], rows[:, 0], d_x[:, :WIDTH])
    np.add.at(g["char"], rows[:, 1:].reshape(-1), np.repeat(d_x[:, WIDTH : 2 * WIDTH] / (GRAMS - 1), GRAMS - 1, axis=0))
    g["word"][0] = g["char"][0] = 0
    return g


def text_features(logits: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Of each text: its highest window logit, the mean of its three highest, and the mean window probability."""
    out = np.empty((len(starts), 3))
    ends = np.append(starts[1:], len(logits))
    for i, (a, b) in enumerate(zip(starts, ends, strict=True)):
        top = np.sort(np.partition(logits[a:b], -3)[-3:]) if b - a > 3 else np.sort(logits[a:b])
        out[i, :2] = top[-1], top.mean()
    out[:, 2] = np.add.reduceat(sigmoid(logits.astype(np.float64)), starts) / (ends - starts) if len(starts) else 0
    return out


def cut(texts: list[str], vocabulary: Spellings) -> tuple[np.ndarray, np.ndarray]:
    """The windows of all texts, one after the other, and where each text's begin."""
    parts = [windows(vocabulary.ids(tokens(t))) for t in texts]
    return np.concatenate(parts), np.cumsum([0] + [len(p) for p in parts])[:-1]


def train(texts: list[str], labels: list[int], prior: float, seed: int = SEED) -> Model:
    """A model of labelled texts; ``prior`` is the share of label 1 outside the sample, which may hold another."""
    known = common_grams(texts)
    vocabulary, rng, w = Spellings(known), np.random.default_rng(seed), fresh(len(known), seed)
    each = [windows(vocabulary.ids(tokens(t))) for t in texts]
    rows, y = np.array(vocabulary.rows, np.int32), np.array(labels, np.float64)
    weight = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
    m, v, step = {k: np.zeros_like(a) for k, a in w.items()}, {k: np.zeros_like(a) for k, a in w.items()}, 0
    epochs = max(EPOCHS, min(30, 12_000 // max(len(texts), 1)))
    total = epochs * (-(-len(texts) // BATCH) + FOLDS)
    fold = np.arange(len(texts)) % FOLDS
    rng.shuffle(fold)
    told = [evidence([t for t, f in zip(texts, fold, strict=True) if f != k], [v for v, f in zip(labels, fold, strict=True) if f != k], known) for k in range(FOLDS)]
    for _ in range(epochs):
        batches = [(k, some) for k in range(FOLDS) for own in [rng.permutation(np.flatnonzero(fold == k))] for some in np.array_split(own, max(1, -(-len(own) // BATCH))) if len(some)]
        for k, some in [batches[i] for i in rng.permutation(len(batches))]:
            starts = np.cumsum([0] + [len(each[i]) for i in some])[:-1]
            used, index = np.unique(np.concatenate([[[0] * WINDOW], *(each[i] for i in some)]), return_inverse=True)
            index = index.reshape(-1, WINDOW)[1:]
            own = rows[used]
            keep: dict = {}
            shown = (rng.random(len(own)) >= DROP).astype(np.float32)[:, None]
            x = embed(w, own, told[k]) * shown
            z = forward(w, project(w, x), index, keep).astype(np.float64)
            # Log-mean-exp over a text's windows, and the share of each window in its gradient.
            size = np.diff(np.append(starts, len(z)))
            top = np.repeat(np.maximum.reduceat(z, starts), size)
            e = np.exp(z - top)
            sums = np.add.reduceat(e, starts)
            logit = np.maximum.reduceat(z, starts) + np.log(sums / size)
            d_text = (sigmoid(logit) - y[some]) * weight[some] / len(some)
            g = backward(w, x, shown, own, keep, (np.repeat(d_text / sums, size) * e).astype(np.float32))
            step += 1
            rate = RATE * (1 - step / (total + 1)) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for name, grad in g.items():
                m[name] = 0.9 * m[name] + 0.1 * grad
                v[name] = 0.999 * v[name] + 0.001 * grad * grad
                if name in ("word", "char"):
                    w[name] *= 1 - rate * DECAY
                w[name] -= (rate * (m[name] / (np.sqrt(v[name]) + 1e-7))).astype(np.float32)
    # The text's score: logistic regression, by Newton's steps with a small ridge, at the true share of label 1.
    f = np.empty((len(texts), 3))
    for k in range(FOLDS):
        own = np.flatnonzero(fold == k)
        if len(own):
            starts = np.cumsum([0] + [len(each[i]) for i in own])[:-1]
            f[own] = text_features(logits(w, project(w, embed(w, rows, told[k])), np.concatenate([each[i] for i in own])), starts)
    mean, spread = f.mean(axis=0), f.std(axis=0) + 1e-6
    a = np.column_stack([np.ones(len(f)), (f - mean) / spread])
    weight = np.where(y == 1, prior / y.mean(), (1 - prior) / (1 - y.mean())) if 0 < y.mean() < 1 else np.ones(len(y))
    b = np.zeros(a.shape[1])
    for _ in range(30):
        p = sigmoid(a @ b)
        hessian = (a * (weight * p * (1 - p))[:, None]).T @ a + np.diag([1e-3, 1, 1, 1])
        b += np.linalg.solve(hessian, a.T @ (weight * (y - p)) - np.array([1e-3, 1, 1, 1]) * b)
    return Model(known, w | {"evidence": evidence(texts, labels, known), "mean": mean, "spread": spread, "fit": b})


def logits(w: Weights, gates: np.ndarray, index: np.ndarray, at_once: int = 2048) -> np.ndarray:
    return np.concatenate([forward(w, gates, index[i : i + at_once]) for i in range(0, len(index), at_once)]) if len(index) else np.zeros(0, np.float32)


def scores(w: Weights, texts: list[str], vocabulary: Spellings) -> np.ndarray:
    """Scores of whole texts, from all of their windows."""
    if not texts:
        return np.zeros(0)
    if len(vocabulary.number) > MEMO:
        vocabulary.forget()
    index, starts = cut(texts, vocabulary)
    f = text_features(logits(w, vocabulary.gates(w), index), starts)
    return sigmoid(w["fit"][0] + ((f - w["mean"]) / w["spread"]) @ w["fit"][1:])


def held_out(doc_id: Column) -> Column:
    """Whether a row belongs to the fold that training never sees."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES, seed: int = SEED) -> Model | None:
    """Weights from a bounded sample of the labelled rows in the training folds; None where a class has none."""
    told = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where(~held_out(F.col("doc_id")))
    share = told.agg(F.avg("toxic")).first()[0]
    if not share or share >= 1:
        return None
    chosen = [r for c in (0, 1) for r in told.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).collect()]
    few = docs.sparkSession.createDataFrame([(r["doc_id"], int(r["toxic"])) for r in chosen], "doc_id long, toxic int")
    # At most 2 * sample ids, so safe to broadcast; the texts that come back are bounded in number and size.
    texts = docs.select("doc_id", "text").where(F.octet_length("text") <= sample_bytes).join(F.broadcast(few), "doc_id").dropDuplicates(["doc_id"])
    rows = sorted((r["doc_id"], r["text"], r["toxic"]) for r in texts.collect())
    if len({y for _, _, y in rows}) < 2:
        return None
    return train([t for _, t, _ in rows], [y for _, _, y in rows], float(share), seed)


def scored_rows(docs: DataFrame, labels: DataFrame, keep: tuple[str, ...], model: Model | None = None) -> DataFrame:
    """row (a struct of the columns ``keep``) and score of every row."""
    model = model or learn(docs, labels)
    if model is None:
        return docs.select(packed_row(keep), F.lit(0.0).alias("score"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trim()
        vocabulary = Spellings(model.known)
        for batch in batches:
            texts, rows = (batch.column(0).field("text"), batch.column(0)) if inside else (batch.column(1), batch.column(0))
            sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy())
            at = 0
            while at < batch.num_rows:
                stop = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + 1_000_000)))
                told = scores(model.weights, [t or "" for t in texts.slice(at, stop - at).to_pylist()], vocabulary)
                yield pa.RecordBatch.from_arrays([rows.slice(at, stop - at), pa.array(told, pa.float64())], names=["row", "score"])
                at = stop

    inside = "text" in keep  # then the text travels once
    given = docs.select(packed_row(keep), *(() if inside else ("text",)))
    return given.mapInArrow(run, T.StructType([T.StructField("row", given.schema["row"].dataType), T.StructField("score", T.DoubleType())]))


def score(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, model: Model | None = None) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    told = scored_rows(docs, labels, ("doc_id",), model)
    return told.select("row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def clean(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, model: Model | None = None) -> DataFrame:
    """The rows whose score is below the threshold, with all their columns."""
    told = scored_rows(docs, labels, tuple(docs.columns), model).where(F.col("score") < threshold)
    return told.select(*unpacked_row(docs.columns))
