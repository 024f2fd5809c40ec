"""Counts against the model's own library: given texts, random ones, very long pre-tokens."""

import random

import pytest
import sentencepiece

from pricebasket.llm import token_counts
from pricebasket.llm.queries import QUERIES

ODD = ["  ", "\n", "\t", " " * 17, "==", "-" * 5, "x" * 33, "é", "漢", "字", "\U0001f600", "<s>", "</s>", "<unk>", "<0x0A>", "▁", "▁▁", "12", "\x00", "́", " ▁"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=token_counts.default_path())


@pytest.fixture(scope="module")
def merger():
    return token_counts.Merger(token_counts.default_path())


def of_library(library, texts):
    return [len(ids) for ids in library.encode(texts, num_threads=1)]


def test_random_texts_count_as_the_library_does(library, merger):
    draw = random.Random(5)
    pieces = [library.id_to_piece(i).replace("▁", " ") for i in range(259, library.get_piece_size())]
    texts = ["".join(draw.choice(pieces if draw.random() < 0.6 else ODD) for _ in range(draw.randrange(12))) for _ in range(4000)]
    texts += ["".join(draw.choice("abcdeaaa  ernst=-") for _ in range(draw.randrange(80))) for _ in range(2000)]
    assert merger.count(texts).tolist() == of_library(library, texts)
    # Again, from what it remembers.
    assert merger.count(texts[::-1]).tolist() == of_library(library, texts)[::-1]


def test_very_long_pretokens(library, merger):
    letters = random.Random(6).choices("ernstiaolx", k=60_000)
    texts = ["x" * 20_000, " " * 30_000, "ab" * 30_000, "".join(letters), "=-" * 3000 + "ernst" * 6000]
    assert merger.count(texts).tolist() == of_library(library, texts)


def test_rounds_and_heap_agree(library, merger, monkeypatch):
    texts = [" ".join("".join(random.Random(i).choices("estnra", k=40)) for _ in range(5)) for i in range(200)]
    expected = merger.count(texts).tolist()
    monkeypatch.setattr(token_counts, "LONG", 3)
    other = token_counts.Merger(token_counts.default_path())
    assert other.count(texts).tolist() == expected == of_library(library, texts)


def test_equal_first_hashes_do_no_harm(library, merger, monkeypatch):
    other = token_counts.Merger(token_counts.default_path())
    other._codes[0] = 1
    texts = ["the eth teh over rove", "a the b het"]
    assert other.count(texts).tolist() == of_library(library, texts)


def test_query_over_the_whole_table(spark, sf_dir, plain, library):
    got = sorted(map(tuple, QUERIES["op11_token_counts"](spark, sf_dir).collect()))
    tokens = of_library(library, [text or "" for _, text in plain])
    assert got == [(doc_id, len((text or "").encode()), n, n > 4096) for (doc_id, text), n in zip(plain, tokens)]


def test_odd_rows(spark, odd, library):
    got = [tuple(row) for row in token_counts.counts(odd).collect()]
    rows = [(row["doc_id"], row["text"] or "") for row in odd.select("doc_id", "text").collect()]
    expected = [(doc_id, len(text.encode()), n, n > 4096) for (doc_id, text), n in zip(rows, of_library(library, [text for _, text in rows]))]
    assert sorted(got, key=str) == sorted(expected, key=str)
    kept = token_counts.with_counts(odd, limit=5)
    assert set(odd.columns) < set(kept.columns) and kept.count() == odd.count()
    assert token_counts.counts(odd.limit(0)).collect() == []
