"""The bigram model against formulas written over plain dictionaries."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pricebasket.llm import kneser_ney, lm_scoring, words


def tokens(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lowered), None]


def brute(rows):
    held = lambda k: k is not None and zlib.crc32(str(k).encode()) % 10 == 0
    bigrams, uni = Counter(), Counter()
    for key, text in rows:
        if not held(key):
            seq = tokens(text)
            uni.update(seq)
            bigrams.update(zip(["<s>", *seq[:-1]], seq))
    classes = lambda counts: [sum(c == k for c in counts) for k in (1, 2, 3, 4)]
    upper = kneser_ney.discounts(classes(bigrams.values()))
    cont, totals, passed = Counter(), Counter(), defaultdict(float)
    for (a, b), n in bigrams.items():
        cont[b] += 1
        totals[a] += n
        passed[a] += upper[min(n, 3) - 1]
    lower = kneser_ney.discounts(classes(cont.values()))
    every = sum(cont.values())
    spare = sum(lower[min(n, 3) - 1] for n in cont.values()) / every if every else 1
    N, V = sum(uni.values()), len(uni)

    def p(a, b):
        low = (cont[b] - lower[min(cont[b], 3) - 1] if cont[b] else 0) / max(every, 1) + spare / (len(cont) + 1)
        if not totals[a]:
            return low
        n = bigrams[(a, b)]
        return (n - upper[min(n, 3) - 1] if n else 0) / totals[a] + passed[a] / totals[a] * low

    out = []
    for key, text in rows:
        seq = tokens(text)
        out.append((key, held(key), len(seq), sum(uni[t] > 0 for t in seq), N,
                    sum(math.log10((uni[t] + 0.1) / (N + 0.1 * (V + 1))) for t in seq),
                    sum(math.log10(p(a, b)) for a, b in zip(["<s>", *seq[:-1]], seq))))
    return out, p, [*cont, "never seen"]


def order(row):
    return (row[0] is not None, row[0] or 0, row[2], row[5])


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_scores_equal_brute_force(request, which):
    docs = request.getfixturevalue(which)
    expected, p, known = brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    got = [tuple(r) for r in lm_scoring.score(docs).collect()]
    assert len(got) == len(expected)
    for a, b in zip(sorted(got, key=order), sorted(expected, key=order)):
        assert a[:5] == b[:5]
        assert a[5] == pytest.approx(b[5], rel=1e-9) and a[6] == pytest.approx(b[6], rel=1e-5)
    if which == "odd":
        for context in ("<s>", "the", "same", "never met"):
            assert sum(p(context, word) for word in known) == pytest.approx(1, abs=1e-6)


def test_partitions_do_not_matter(docs):
    whole = sorted(tuple(r) for r in lm_scoring.score(docs).collect())
    again = sorted(tuple(r) for r in lm_scoring.score(docs.repartition(7)).collect())
    assert [r[:5] for r in whole] == [r[:5] for r in again]
    assert np.allclose([r[5:] for r in whole], [r[5:] for r in again])


def test_nothing_to_learn_from(docs):
    assert lm_scoring.score(docs.limit(0)).collect() == []
    held = docs.filter("crc32(encode(cast(doc_id as string), 'UTF-8')) % 10 = 0")
    row = lm_scoring.score(held).first()
    assert row["train_tokens"] == 0 and row["n_known"] == 0 and math.isfinite(row["score"])


def test_frequent_bigrams_keep_their_counts(spark):
    docs = spark.createDataFrame([(i, "a b " * 200 + "c") for i in range(30)], "doc_id long, text string")
    expected, _, _ = brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    got = sorted(tuple(r) for r in lm_scoring.score(docs).collect())
    assert [g[:5] for g in got] == [e[:5] for e in expected]
    assert np.allclose([g[6] for g in got], [e[6] for e in expected], rtol=1e-5)


def test_word_hashes(monkeypatch):
    texts = ["Hello, World  hello,", "", None, " \t x\ny ", "a", "naïve é", "x" * 70_000 + " y x", "\x1c\x85 \xa0"]
    for step in (1 << 22, 8):
        monkeypatch.setattr(words, "_STEP", step)
        found = words.Words(texts)
        flat = [word for text in texts for word in tokens(text)[:-1]]
        assert np.diff(found.bounds).tolist() == [len(tokens(text)) - 1 for text in texts]
        seen = {}
        assert all(seen.setdefault(word, h) == h for word, h in zip(flat, found.hashes.tolist()))
        assert len(set(seen.values())) == len(seen)
