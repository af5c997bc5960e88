from __future__ import annotations

import hashlib

import public_tokenizers as public
import pytest
import tiktoken

from colonnade.llm import bpe

PATH = public.path("byte_bpe_50k.tiktoken")
DOCS = "doc_id long, text string, n_tokens string, key string"


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=bpe.load_ranks(PATH), special_tokens={})


TEXTS = [
    "",
    "a",
    "it's we'll they're 'll",
    "word " * 700,
    "  \n\n  a" * 300,
    "'" * 50 + "'re'll" * 200,
    "a" * 900 + " " + "b" * 300 + "  \t\n" * 200,
    "ééé 'll" * 100 + " " * 500 + "x",
    "日本語テキスト🙂" * 100,
    "<|endoftext|> is ordinary",
]


@pytest.mark.parametrize("chunk, overlap", [(512, 16), (100, 8), (64, 7)])
def test_stitched_chunks_equal_the_whole(library, chunk, overlap):
    codec = bpe.codec(PATH, public.PATTERN)
    for text in TEXTS:
        assert bpe.stitched(text, codec, chunk, overlap) == library.encode_ordinary(text)


def test_distributed_equals_the_library(spark, library):
    texts = [*TEXTS, TEXTS[6], None]
    rows = [(i if i != 2 else None, t, "x", "y") for i, t in enumerate(texts)]
    out = bpe.encode_digests(spark.createDataFrame(rows, DOCS), PATH, public.PATTERN, chunk=100, overlap=8).collect()

    def expected(row):
        ids = library.encode_ordinary(row[1] or "")
        return row[0], len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((row[1] or "").encode()).hexdigest()

    assert sorted(map(tuple, out), key=str) == sorted(map(expected, rows), key=str)


ENDLESS = {"spaces": " " * 10**6 + "x", "lines": "\n" * 10**6 + "x", "letters": "a" * 10**6, "marks": "!" * 10**6, "combining": "e" + "\u0301" * 10**6, "digits": "7" * 10**6}


def test_endless_pre_tokens(spark, library):
    """A million characters of one pre-token, which the library's own matcher may not survive: each is merged by itself, as it is in short texts."""
    rows = [(i, t, "", "") for i, t in enumerate(ENDLESS.values())]
    found = {r["doc_id"]: r for r in bpe.encode_digests(spark.createDataFrame(rows, DOCS), PATH, public.PATTERN).collect()}
    for i, t in enumerate(ENDLESS.values()):
        pieces = [" " * (10**6 - 1), " x"] if t[0] == " " else ["\n" * (10**6 - 1), "\n", "x"] if t[0] == "\n" else ["e", "\u0301" * 10**6] if t[0] == "e" else [t]
        ids = [x for p in pieces for x in library._encode_single_piece(p)]
        assert (found[i]["n_tokens"], found[i]["ids_sha256"]) == (len(ids), bpe.digest(ids))
        assert found[i]["decoded_sha256"] == hashlib.sha256(t.encode()).hexdigest()


def test_a_piece_cut_here_equals_the_library(library):
    codec = bpe.codec(PATH, public.PATTERN)
    text = "".join(TEXTS) * 20
    assert len(text) > bpe.WHOLE
    assert codec.encode(text) == library.encode_ordinary(text)


def test_round_trip_of_ids(spark):
    rows = [(i, t, "", "") for i, t in enumerate(TEXTS)]
    ids = bpe.encode_ids(spark.createDataFrame(rows, DOCS), PATH, public.PATTERN, chunk=100, overlap=8)
    back = {r["doc_id"]: bytes(r["bytes"]) for r in bpe.decode_ids(ids, PATH, public.PATTERN).collect()}
    assert back == {i: t.encode() for i, t in enumerate(TEXTS)}


def test_empty_table(spark):
    assert bpe.encode_digests(spark.createDataFrame([], DOCS), PATH, public.PATTERN).count() == 0
