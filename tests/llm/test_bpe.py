import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from starloom.llm import bpe
from starloom.llm.bpe import Encoder, Tokenizer, pair_table, read_ranks

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def tokens():
    return read_ranks(PATH)


@pytest.fixture(scope="module")
def reference(tokens):
    ranks = {token: rank for rank, token in enumerate(tokens)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    rng = random.Random(1)
    mixed = ["".join(rng.choice("ab 'st\n!é1日\t") for _ in range(300)) for _ in range(200)]
    runs = ["a" * 2000, "ab" * 900, " " * 500 + "x", "!" * 333 + "?" * 50, "".join(rng.choice("thesaurion") for _ in range(3000))]
    return [None, "", "''s 's\n's don't 'RE I'll", "<|endoftext|>", "日本語" * 200, "\x00\x01﻿", *runs, *mixed]


def test_same_ids_as_the_library(tokens, reference, monkeypatch):
    table = pair_table(tokens)
    expected = [reference.encode_ordinary(t or "") for t in texts()]
    for words, chars, cells in ((600_000, 1 << 21, 1 << 20), (50, 40, 64)):
        monkeypatch.setattr(bpe, "POOL_WORDS", words)
        monkeypatch.setattr(bpe, "GROUP_CHARS", chars)
        monkeypatch.setattr(bpe, "CELLS", cells)
        encoder = Encoder(tokens, table, public_tokenizers.PATTERN)
        got = [ids.tolist() for ids in encoder.encode(texts())]
        assert got == expected
        assert all(encoder.decode(bpe.np.array(ids, dtype="i4")) == (t or "").encode() for ids, t in zip(got, texts()))


def test_white_space_between_pieces(tokens, reference, monkeypatch):
    rng = random.Random(6)
    parts = ["a", "b", " ", "  ", "\n", "\n\n", "\t", "\r\n", "é", "日本", "'s", "I'll", "'", "9", "…", "\x85", "\xa0", "\u3000",
             "\x1c", " the", "word", ".", "'", "\n'", " \n", "🙂"]
    mixed = ["".join(rng.choice(parts) for _ in range(rng.randrange(14))) for _ in range(5000)]
    expected = [reference.encode_ordinary(t) for t in mixed]
    for pieces, held, chars in ((1 << 19, 1 << 24, 1 << 21), (50, 1 << 24, 300), (1 << 19, 90, 300)):
        monkeypatch.setattr(bpe, "POOL_PIECES", pieces)
        monkeypatch.setattr(bpe, "POOL_CHARS", held)
        monkeypatch.setattr(bpe, "GROUP_CHARS", chars)
        encoder = Encoder(tokens, pair_table(tokens), public_tokenizers.PATTERN)
        assert [ids.tolist() for ids in encoder.encode(mixed)] == expected
    assert [ids.tolist() for ids in encoder.encode(["a b", "\ud800 b"])] == [reference.encode_ordinary(t) for t in ("a b", "? b")]


def test_the_pattern_runs_on_a_piece_once(tokens, reference):
    encoder = Encoder(tokens, pair_table(tokens), public_tokenizers.PATTERN)
    heard, split = [], encoder.split

    class Heard:
        def findall(self, text):
            heard.append(text)
            return split.findall(text)

    encoder.split = Heard()
    text = "One text,\nof several pieces; said again: one text"
    for _ in range(2):
        assert [ids.tolist() for ids in encoder.encode([text] * 30)] == [reference.encode_ordinary(text)] * 30
    assert sum(map(len, heard)) <= len(text) + 1


def test_other_patterns_may_join_newlines_to_words(tokens):
    pattern = r"""[^\s]+[\r\n]*|\s+"""
    own = tiktoken.Encoding("o", pat_str=pattern, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    text = "one.\ntwo\nthree four"
    assert [ids.tolist() for ids in Encoder(tokens, pair_table(tokens), pattern).encode([text])] == [own.encode_ordinary(text)]


def test_columns(spark, reference, odd_documents, no_documents):
    tokenizer = Tokenizer(spark, PATH, public_tokenizers.PATTERN)
    ids = tokenizer.encode(F.col("text"))
    for row in odd_documents.select("text", ids.alias("i"), tokenizer.digest(ids).alias("d"), tokenizer.decode(ids).alias("b")).collect():
        text = row["text"] or ""
        assert row["i"] == reference.encode_ordinary(text) and bytes(row["b"]) == text.encode()
        packed = b"".join(i.to_bytes(4, "little") for i in row["i"])
        assert tuple(row["d"]) == (len(row["i"]), hashlib.sha256(packed).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    assert no_documents.select(ids).count() == 0


def test_one_pass_gives_ids_and_digests(spark, odd_documents, no_documents):
    tokenizer = Tokenizer(spark, PATH, public_tokenizers.PATTERN)
    ids = tokenizer.encode(F.col("text"))
    both = odd_documents.select("text", tokenizer.encode_and_digest(F.col("text")).alias("b"), ids.alias("i"), tokenizer.digest(ids).alias("d"))
    for row in both.collect():
        assert tuple(row["b"]) == (row["i"], *row["d"])
    assert no_documents.select(tokenizer.encode_and_digest(F.col("text"))).count() == 0


def test_ranks_must_be_dense(tmp_path):
    (tmp_path / "r").write_text("YQ== 0\nYg== 2\n")
    with pytest.raises(ValueError):
        read_ranks(str(tmp_path / "r"))
