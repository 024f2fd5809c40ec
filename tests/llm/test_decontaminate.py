"""Benchmark items in documents: all windows by brute force, edits, recall and clean documents."""

import numpy as np
import pytest
from pricebasket.llm import decontaminate as dec


def distance(a, b):
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(last[j - 1] + (x != y), last[j] + 1, now[-1] + 1))
        last = now
    return last[-1]


def words(text):
    return (text or "").lower().replace("\t", " ").replace("\n", " ").split(" ")


def brute(text, items, percent=80, least=8):
    have, found = [w for w in words(text) if w], []
    for number, item in items:
        own = [w for w in words(item) if w]
        n, most = len(own), len(own) * (100 - percent) // 100 if len(own) >= least else 0
        if not n:
            continue
        windows = [have[i : i + n] for i in range(len(have) - n + 1)] if len(have) >= n else [have]
        vocabulary = set(own)
        if any(sum(w in vocabulary for w in window) >= n - most and distance(window, own) <= most for window in windows):
            found.append(number)
    return sorted(found)


def search(items, tables=dec.TABLES, samples=dec.SAMPLES, least=8):
    return dec.Items(dec.compiled(items, 80, least, tables, samples), tables, samples)


@pytest.fixture(scope="module")
def items(spark, sf_dir):
    return [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]


def test_documents(spark, sf_dir, docs, plain, items):
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    got = {r["doc_id"]: r for r in dec.decontaminate(docs, benchmark).collect()}
    expected = {key: brute(text, items) for key, text in plain}
    assert {key: r["item_ids"] for key, r in got.items()} == expected
    assert any(expected.values())
    assert all(r["n_items"] == len(r["item_ids"]) and r["kept"] == (not r["item_ids"]) == (not r["contaminated"]) for r in got.values())
    again = dec.decontaminate(docs, benchmark, items=15)
    assert {r["doc_id"]: r["item_ids"] for r in again.collect()} == expected


def test_edited_items_are_found(items):
    rng = np.random.default_rng(4)
    texts, numbers = [], []
    for number, item in items:
        own = item.lower().split()
        for edits in (0, 1, len(own) // 10, len(own) // 5):
            now = list(own)
            for _ in range(edits):
                now[int(rng.integers(0, len(now)))] = f"new{rng.integers(10**6)}"
            texts.append(" ".join(["lead", "in", *now, "and", "out"]))
            numbers.append(number)
    found = search(items).found(texts)
    assert np.mean([n in f for n, f in zip(numbers, found)]) > 0.99
    assert [bool(set(f) - {n}) for n, f in zip(numbers, found)].count(True) == 0


def test_left_out_and_put_in_words(items):
    """Deletions and insertions up to n / 5, and beyond, against all windows of all lengths."""
    rng = np.random.default_rng(11)
    items = [(number, text) for number, text in items if len(text.split()) <= 30][:20]
    texts, expected = [], []
    for number, item in items:
        own = item.lower().split()
        most = len(own) // 5
        for left_out, put_in in ((most, 0), (0, most), (most // 2, most - most // 2), (most + 1, 0), (0, most + 2)):
            now = [own[i] for i in sorted(rng.choice(len(own), len(own) - left_out, replace=False))]
            for _ in range(put_in):
                now.insert(int(rng.integers(1, len(now))), f"new{rng.integers(10**6)}")
            now = ["lead", "in", *now, "and", "out"]
            windows = (now[i : i + n] for n in range(len(own) - most, len(own) + most + 1) for i in range(len(now) - n + 1))
            texts.append(" ".join(now))
            expected.append(any(distance(window, own) <= most for window in windows))
    found = search(items).found(texts)
    assert [items[i // 5][0] in f for i, f in enumerate(found)] == expected
    assert all(any(expected[i : i + 3]) for i in range(0, len(expected), 5)) and not all(expected)


def test_the_tables_decide(items, monkeypatch):
    """Recall of the embedding's keys alone, for each kind of edit, at n / 5 edits; without equal keys nothing is found."""
    rng = np.random.default_rng(23)
    texts = {"replaced": [], "left out": [], "put in": []}
    for _, item in items:
        own = item.lower().split()
        most = len(own) // 5
        for kind, into in texts.items():
            now = list(own)
            for _ in range(most):
                at = int(rng.integers(1, len(now) - 1))
                new = [f"new{rng.integers(10**6)}"]
                now[at : at + (kind != "put in")] = [] if kind == "left out" else new
            into.append(" ".join(["lead", "in"] * 30 + now + ["and", "out"] * 30))
    for kind, some in texts.items():
        assert np.mean([n in f for (n, _), f in zip(items, search(items).found(some))]) > 0.98, kind
    fewer = search(items, tables=1, samples=12).found(texts["left out"])
    assert np.mean([n in f for (n, _), f in zip(items, fewer)]) < 0.9
    whole = search(items, tables=1, samples=12).found([f"a {text} b" for _, text in items])
    assert all(n in f for (n, _), f in zip(items, whole))
    monkeypatch.setattr(dec.Items, "_alike", lambda *_: iter(()))
    assert not any(search(items).found(texts["replaced"]))


def test_short_items_word_for_word():
    items = [(1, "one Two three"), (2, "four"), (3, "five six seven eight nine ten"), (4, " "), (5, "one two three four")]
    texts = ["ONE two three", "one two  three\tfour", "one twothree", "three one two", "five six seven eight nine", "x five six seven eight nine ten", None, ""]
    assert search(items).found(texts) == [brute(text, items) for text in texts] == [[1], [1, 2, 5], [], [], [], [3], [], []]


def test_items_that_share_all_their_segments(monkeypatch):
    """Equal and much repeated items in small runs: no pair is lost where many share a key."""
    whole = dec.runs
    monkeypatch.setattr(dec, "runs", lambda number: whole(number, 50))
    rng = np.random.default_rng(3)
    start = " ".join(f"w{k}" for k in range(9))
    items = [(k, f"{start} end{k // 2}") for k in range(60)] + [(100, "again " * 12)]
    texts = [f"{start} end{k}" for k in rng.integers(0, 40, 12)] + ["again " * 300, f"{start} {start}", "again and " * 9]
    assert search(items).found(texts) == [brute(text, items) for text in texts]


def test_runs():
    rng = np.random.default_rng(2)
    for number in (rng.integers(1, 9, 50), rng.integers(1, 500, 20), np.zeros(0, np.int64)):
        parts = [np.arange(number.size)[some] for some in dec.runs(number, 20)]
        assert [k for part in parts for k in part.tolist()] == list(range(number.size))
        assert all(part.size == 1 or number[part].sum() <= 20 + number[part].max() for part in parts)


def test_odd_rows(spark, odd):
    benchmark = spark.createDataFrame(
        [(1, "same text twice"), (2, None), (None, "one two three four five six seven eight"), (4, ""), (4, "word " * 10)],
        "item_id long, text string")
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    got = [(r["doc_id"], r["item_ids"]) for r in dec.decontaminate(odd, benchmark).collect()]
    assert sorted(map(str, got)) == sorted(
        str((key, [4] if text and text.startswith("word ") else [1] if text == "same text twice" else [])) for key, text in rows)
    short = spark.createDataFrame([(1, "one two three FOUR five six seven")], "doc_id long, text string")
    assert dec.decontaminate(short, benchmark).first()["item_ids"] == [-1]
    assert dec.decontaminate(odd.limit(0), benchmark).collect() == []
    assert dec.decontaminate(short, benchmark.limit(0)).first()["kept"]
