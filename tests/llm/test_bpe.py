"""The tree encoder gives what the public tokenizer library gives, and decodes it again."""

from __future__ import annotations

import random

import public_tokenizers
import pytest
import tiktoken

from shoptide.llm import tree_bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def raw():
    return tree_bpe.read_ranks(PATH)


@pytest.fixture(scope="module")
def library(raw):
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=tree_bpe.parse_ranks(raw), special_tokens={}
    )


def test_random_texts(raw, library):
    own, rnd = tree_bpe.codec(raw, public_tokenizers.PATTERN), random.Random(1)
    alphabets = ["ab", "a", "abcdefghij ", "aeéÉñ .,\n\t", "01 23=", "中文字 ", "thein ", " \n\r\t ", "'s'll"]
    for _ in range(800):
        letters = rnd.choice(alphabets)
        text = "".join(rnd.choice(letters) for _ in range(rnd.choice([0, 5, 40, 400])))
        ids = own.encode(text)
        assert ids == library.encode_ordinary(text)
        assert own.decode_ids(ids) == text.encode()


def test_halves_join_to_the_whole(raw):
    own, rnd = tree_bpe.codec(raw, public_tokenizers.PATTERN), random.Random(2)
    for _ in range(300):
        data = bytes(rnd.choice(b"athe in") for _ in range(rnd.randrange(2, 300)))
        cut = rnd.randrange(1, len(data))
        assert own.join(own.merge(data[:cut]), own.merge(data[cut:])) == own.merge(data)


def test_long_pieces(raw, library):
    own = tree_bpe.codec(raw, public_tokenizers.PATTERN)
    for text in ("a" * 20_000, "=-" * 5_000, " " * 3_000):
        assert own.encode(text) == library.encode_ordinary(text)


def test_a_join_looks_up_its_two_neighbours_only(library):
    """Over 32 bytes 31 pairs and two for each join, not all pairs again after each."""

    class Counted(dict):
        asked = 0

        def get(self, *args):
            self.asked += 1
            return super().get(*args)

    data = b"representationalinternationalise"
    ranks = Counted(library._mergeable_ranks)
    ids = tree_bpe.TreeBpe(ranks, public_tokenizers.PATTERN).merge(data)
    assert data not in ranks and ids == library.encode(data.decode())
    assert len(data) == 32 and ranks.asked <= 31 + 2 * (32 - len(ids))


def test_frames(spark, library):
    texts = [None, "", "Hello  wörld's 123\n\n", "x" * 5000, "Hello  wörld's 123\n\n", "<|endoftext|>"]
    rows = [(i, t, "clash", 3.5) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, token_ids string, extra double")
    coded = tree_bpe.encode(docs, PATH, public_tokenizers.PATTERN)
    back = tree_bpe.decode(coded, PATH, public_tokenizers.PATTERN)
    assert back.columns == ["doc_id", "text", "extra", "token_ids", "decoded"]
    for row in back.collect():
        assert row.token_ids == library.encode_ordinary(row.text or "")
        assert bytes(row.decoded) == (row.text or "").encode() and row.extra == 3.5
    assert tree_bpe.digests(docs.limit(0), PATH, public_tokenizers.PATTERN).collect() == []
