"""Searches against a plain score of every document, with ties, bounds at work and odd rows."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricebasket.llm import ranked_search
from pricebasket.llm.queries import QUERIES

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
AZ = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(AZ))


def plain_search(docs, items, k=50):
    held = [(doc_id, Counter(terms(text))) for doc_id, text in docs if terms(text)]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(term for _, c in held for term in c)
    found = []
    for item_id, text in set(items):
        scores = []
        for doc_id, c in held:
            m = 100 - 50 + (50 * sum(c.values()) * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m))
                        for t in set(terms(text)) if t in c)
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        found += [(item_id, rank + 1, each[3], -each[0]) for rank, each in enumerate(sorted(scores)[:k])]
    return sorted(found, key=str)


def rows(df):
    return sorted((tuple(row) for row in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


@pytest.fixture(scope="module")
def corpus():
    """Documents of few words, so that scores tie; copies; texts of very different length."""
    draw = random.Random(2)
    words = [f"w{int(draw.paretovariate(0.7))}" for _ in range(400)] + ["Größe", "ÉTÉ", "été", "漢字", "x1"]
    texts = [" ".join(draw.choices(words, k=draw.choice([1, 3, 8, 30, 200]))) for _ in range(700)]
    docs = [(i, text) for i, text in enumerate(texts)] + [(1000 + i, texts[5]) for i in range(120)] + [(2000 + i, "w1 w1, W1!") for i in range(80)]
    items = [(i, " ".join(draw.choices(words, k=draw.choice([1, 2, 5, 40])))) for i in range(25)] + [(99, "unheard of")]
    return docs, items


def test_against_plain_scores(spark, corpus):
    docs, items = corpus
    df, asked = spark.createDataFrame(docs, "doc_id long, text string").repartition(5), spark.createDataFrame(items, "item_id long, text string")
    expected = plain_search(docs, items)
    # Whatever is searched first, the results are the same.
    for first in (1, 60, 10_000):
        assert rows(ranked_search.search(df, asked, first=first)) == expected
    assert rows(ranked_search.search(df, asked, k=3)) == plain_search(docs, items, 3)


def test_blocks_of_queries_and_small_buckets(spark, corpus, monkeypatch):
    docs, items = corpus
    df, asked = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(ranked_search, "BLOCK_TERMS", 60)
    assert rows(ranked_search.search(df, asked, k=10)) == plain_search(docs, items, 10)


def test_bounds_pass_over_what_cannot_win(tmp_path):
    """Buckets and pairs below the score to reach are not scored, and nothing above it is lost."""
    draw = np.random.default_rng(1)
    vocabulary, count = 60, 400
    query = [np.sort(draw.choice(vocabulary, 8, replace=False)) for _ in range(12)]
    of = type("Block", (), {})()
    of.bounds = np.concatenate([[0], np.cumsum([q.size for q in query])])
    of.places, of.count = np.concatenate(query), len(query)
    of.owner = np.repeat(np.arange(of.count), 8)
    of.length = np.sqrt(np.diff(of.bounds))
    of.vocabulary = type("Keys", (), {"keys": np.arange(vocabulary)})()
    vectors = []
    for i in range(count):
        terms_ = np.sort(draw.choice(vocabulary, draw.integers(1, 20), replace=False))
        impacts = draw.integers(1, 10 ** draw.integers(1, 6), terms_.size)
        vectors.append((i, float(np.sqrt((impacts.astype(float) ** 2).sum())), terms_, impacts))
    vectors.sort(key=lambda v: -v[1])
    search, scored = ranked_search.Search(of, 5, np.zeros(of.count)), []
    inner = search._rescore
    search._rescore = lambda q, *rest: (scored.append(q.size), inner(q, *rest))
    for low in range(0, count, 16):
        part = vectors[low : low + 16]
        search.bucket(np.array([v[0] for v in part]), np.zeros(len(part), bool), np.array([v[1] for v in part]),
                      np.concatenate([v[2] for v in part]), np.array([v[2].size for v in part]), np.concatenate([v[3] for v in part]))
    every = defaultdict(list)
    for i, _, terms_, impacts in vectors:
        for q, wanted in enumerate(query):
            score = int(impacts[np.isin(terms_, wanted)].sum())
            if score:
                every[q].append((-score, i))
    expected = [(q, -s, i) for q in range(of.count) for s, i in sorted(every[q])[:5]]
    assert list(zip(search.query.tolist(), search.score.tolist(), search.id.tolist())) == expected
    assert sum(scored) < 0.5 * sum(map(len, every.values()))


def test_query_over_the_whole_table(spark, sf_dir, plain):
    items = [tuple(row) for row in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    assert rows(QUERIES["op13_ranked_search"](spark, sf_dir)) == plain_search(plain, items)


def test_odd_rows(spark, odd):
    docs = [tuple(row) for row in odd.select("doc_id", "text").collect()]
    items = [(1, "same text, lost KEY"), (2, None), (3, ""), (None, "word"), (4, "id same"), (4, "x café"), (1, "same text, lost KEY")]
    asked = spark.createDataFrame(items, "item_id long, text string").withColumns({n: F.lit("clash") for n in ("terms", "query", "rank", "doc_id", "text_key")})
    assert rows(ranked_search.search(odd, asked)) == plain_search(docs, [item for item in items if item[1]])
    assert ranked_search.search(odd, asked.limit(0)).collect() == []
    assert ranked_search.search(odd.limit(0), asked).collect() == []
    assert ranked_search.search(odd.filter("text is null"), asked).collect() == []
