"""Byte-level BPE against the tiktoken library, over chunks of every kind of seam, and back."""

import random

import public_tokenizers
import pytest
import regex
import tiktoken

from stationlake.llm import bpe

BITS = ["a", "bc", " ", "  ", "\t", "\n", "'l", "'ll", "'", "é", "漢", "1", "23", "!?", "İ", "́", "<|endoftext|>", " the", " hello"]
#: Pre-tokens longer than any small chunk, of every kind.
RUNS = ["a" * 500, "1" * 333, " " * 300, "x" * 200 + " " * 100 + "y" * 50, "!" * 177, "\t" * 90 + "z"]


def mixed(seed: int, n: int) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice(BITS) for _ in range(rng.randrange(120))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(bpe.default_path()), special_tokens={}
    )


def test_merges_of_single_pieces(library):
    """By the heap and by the encoder, which chooses by length."""
    encoder = bpe.PieceEncoder(bpe.default_path())
    rng = random.Random(5)
    letters = ["".join(rng.choice("abcdeéß漢") for _ in range(rng.randrange(1, 200))) for _ in range(300)]
    for text in letters + mixed(1, 200) + RUNS + ["".join(letters)]:
        pieces = regex.findall(public_tokenizers.PATTERN, text)
        want = library.encode_ordinary(text)
        assert [i for p in pieces for i in bpe.merge_long(p.encode(), encoder.ranks)] == want, text
        assert [i for p in pieces for i in encoder.piece_ids(p)] == want, text


@pytest.mark.parametrize("chunk,overlap", [(5, 5), (16, 6), (40, 10), (32_768, 1_024)])
def test_chunks_give_what_the_whole_gives(spark, library, chunk, overlap):
    texts = mixed(2, 150) + RUNS + [None, "", " "]
    rows = [(i, t, "x", "y") for i, t in enumerate(texts)] + [(0, texts[0], "x", "y"), (None, "a b", None, None), (None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, chunk STRING, ids STRING")
    out = bpe.decode(bpe.encode(df, chunk=chunk, overlap=overlap)).collect()
    plain = lambda i, t: (repr(i), library.encode_ordinary(t or ""), (t or "").encode())
    assert sorted((repr(r["doc_id"]), list(r["ids"]), bytes(r["data"])) for r in out) == sorted(plain(r[0], r[1]) for r in rows)


def test_rows_that_a_join_has_multiplied_stay_apart(spark, library, tmp_dir):
    path = f"{tmp_dir}/docs"
    spark.createDataFrame([(1, "one two " * 20), (2, None)], "doc_id BIGINT, text STRING").write.parquet(path)
    twice = spark.read.parquet(path).crossJoin(spark.range(3).select("id"))
    out = bpe.encode(twice, chunk=16, overlap=8).collect()
    want = library.encode_ordinary("one two " * 20)
    assert sorted((r["doc_id"], list(r["ids"])) for r in out) == [(1, want)] * 3 + [(2, [])] * 3


def test_no_documents(no_docs):
    assert bpe.decode(bpe.encode(no_docs)).count() == 0


def test_decoding_keeps_other_columns_and_takes_null_ids(spark):
    rows = [("a", [64, 65], "old"), ("b", [], "old"), ("c", None, "old")]
    got = bpe.decode(spark.createDataFrame(rows, "name STRING, ids ARRAY<INT>, data STRING")).collect()
    tokens = {v: k for k, v in bpe.read_ranks(bpe.default_path()).items()}
    assert {r["name"]: bytes(r["data"]) for r in got} == {"a": tokens[64] + tokens[65], "b": b"", "c": b""}
