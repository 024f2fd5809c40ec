"""Quality rules: base counts by brute force, the model by its sums, the verdict on labelled documents."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pricebasket.llm import quality
from pricebasket.session import new_dir


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


@pytest.fixture(scope="module")
def judged(spark, docs, sf_dir):
    return quality.judge(docs, quality.good_sample(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")), least=5).collect()


def test_base_counts(judged, plain):
    expected = {key: brute(text) for key, text in plain}
    assert len(judged) == len(expected)
    for r in judged:
        assert tuple(r)[1:6] == expected[r["doc_id"]]
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        inside = r["low"] is None or r["low"] <= r["score"] <= r["high"]
        assert r["kept"] == (not r["base_failed"] and inside)


def test_labelled_documents(spark, judged, docs):
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    bad = lambda t: t.count("&&&") > 3 or t.count("!! ") > 3 or t.count(" | ") > 3
    rejected = {r["doc_id"]: not r["kept"] for r in judged if not r["base_failed"]}
    junk = [rejected[key] for key in rejected if bad(text[key])]
    clean = [rejected[key] for key in rejected if not bad(text[key])]
    assert len(junk) > 5 and np.mean(junk) == 1 and np.mean(clean) < 0.04


@pytest.mark.parametrize("share", [3, 2])
def test_copies_do_not_move_the_band(spark, docs, sf_dir, share):
    """One text as a third and as half of a language: as copies, and as texts that differ in blanks alone."""
    reference = quality.good_sample(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    one = docs.filter("lang = 'en'").select("doc_id", "text", "lang")
    before = {r["doc_id"]: r for r in quality.judge(one, reference, least=5).collect()}
    scores = sorted((r["score"], key) for key, r in before.items() if not r["base_failed"])
    text = {r["doc_id"]: r["text"] for r in one.collect()}[scores[len(scores) * 6 // 10][1]]
    extra = len(scores) // (share - 1)
    copies = spark.createDataFrame([(-1 - i, text, "en") for i in range(extra)], "doc_id long, text string, lang string")
    blanks = spark.createDataFrame([(-1 - i, text + " " * i, "en") for i in range(extra)], "doc_id long, text string, lang string")
    after = {r["doc_id"]: r for r in quality.judge(one.unionByName(copies), reference, least=5).collect()}
    assert all(tuple(after[key]) == tuple(r) for key, r in before.items()) and after[-1]["kept"]
    near = {r["doc_id"]: r for r in quality.judge(one.unionByName(blanks), reference, least=5).collect()}
    lost = [key for key, r in before.items() if r["kept"] and not near[key]["kept"]]
    assert len(lost) < 0.05 * len(scores) and near[-1]["high"] - near[-1]["low"] > 0.19


def test_halves_have_models_of_their_own(spark):
    """A language's model counts both halves, each half's model only its own."""
    folders = [new_dir(spark, "quality") for _ in range(3)]
    halves = [["abc abd", "bca"], ["xyz", "abz zz a"]]
    keyed = [(f"xx{quality.HALF}{h}", t) for h in (0, 1) for t in halves[h]]
    quality.train(spark.createDataFrame(keyed, "lang string, text string"), folders[0], least=4)
    for folder, texts in zip(folders[1:], (halves[1], sum(halves, []))):
        quality.train(spark.createDataFrame([("xx", t) for t in texts], "lang string, text string"), folder)
    some = ["abc", "zz", "q"]
    both, second, whole = map(quality.Model, folders)
    assert both.means("xx", some).tolist() == whole.means("xx", some).tolist()
    assert both.means(f"xx{quality.HALF}1", some).tolist() == pytest.approx(second.means("xx", some).tolist()) != both.means("xx", some).tolist()


def few_words(words):
    """Every order of three of the words once, so that no window of three repeats."""
    k, seq, a = len(words), [], [0] * len(words) * 3

    def extend(t, p):
        if t > 3:
            seq.extend(a[1 : p + 1] if 3 % p == 0 else [])
            return
        a[t] = a[t - p]
        extend(t + 1, p)
        for j in range(a[t - p] + 1, k):
            a[t] = j
            extend(t + 1, t)

    extend(1, 1)
    return " ".join(words[i] for i in seq)


def test_both_ends_of_the_band(spark):
    """Symbols are too improbable, a few frequent words over and over too probable; the base rules pass both."""
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang")
    good = quality.good_sample(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    planted, rng = [], np.random.default_rng(8)
    for lang in ("en", "de", "fr", "es"):
        times = Counter(w for r in good.filter(f"lang = '{lang}'").collect() for w in r["text"].lower().split())
        planted.append((few_words([w for w, _ in times.most_common(4)]), lang, "high"))
        planted.append((" ".join("".join(rng.choice(list("#*$%&|<>x"), 6)) for _ in range(90)), lang, "low"))
        planted.append((" ".join("".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 7)) for _ in range(90)), lang, "low"))
    rows = spark.createDataFrame([(-1 - i, text, lang) for i, (text, lang, _) in enumerate(planted)], docs.schema)
    got = {r["doc_id"]: r for r in quality.judge(docs.unionByName(rows), good).collect()}
    for i, (_, _, end) in enumerate(planted):
        r = got[-1 - i]
        assert not r["base_failed"] and not r["kept"] and (r["score"] > r["high"] if end == "high" else r["score"] < r["low"])
    clean = [got[r["doc_id"]]["kept"] for r in good.collect() if not got[r["doc_id"]]["base_failed"]]
    assert len(clean) > 50 and np.mean(clean) > 0.97


def plain_model(texts):
    """Modified Kneser-Ney over trigrams of code points, from its formulas."""
    whole = Counter(tuple(g) for t in texts for g in zip(*(([None, None, *" ".join(t.split()), 0])[k:] for k in range(3))))
    counts = {3: whole}
    for order in (2, 1):
        counts[order] = Counter(g[1:] for g in counts[order + 1])
    less = {}
    for order, grams in counts.items():
        n = Counter(grams.values())
        y = n[1] / (n[1] + 2 * n[2]) if n[1] + 2 * n[2] else 0
        known = all(n[k] for k in (1, 2, 3, 4))
        less[order] = [0, *(min(max(k - (k + 1) * y * n[k + 1] / n[k], 0.05), k) if known else 0.5 * k for k in (1, 2, 3))]

    def p(gram):
        if not gram:
            return 1 / (len(counts[1]) + 1)
        order = len(gram)
        after = {g: n for g, n in counts[order].items() if g[:-1] == gram[:-1]}
        if not after:
            return p(gram[1:])
        total = sum(after.values())
        n = after.get(gram, 0)
        rest = sum(less[order][min(k, 3)] for k in after.values()) / total
        return max(n - less[order][min(n, 3)], 0) / total + rest * p(gram[1:])

    return lambda text: np.mean([math.log10(p(g)) for g in zip(*(([None, None, *" ".join(text.split()), 0])[k:] for k in range(3)))])


def test_model_against_its_formulas(spark, plain):
    texts = [text[:300] for _, text in plain if text][:25]
    folder = new_dir(spark, "quality")
    quality.train(spark.createDataFrame([("xx", t) for t in texts], "lang string, text string"), folder)
    model, expected = quality.Model(folder), plain_model(texts)
    some = [*texts[:3], "", "zzz \u4e2d qq", "the the the", *[text[300:400] for _, text in plain if text and len(text) > 400][:4]]
    assert model.means("xx", some) == pytest.approx([expected(t) for t in some], abs=1e-5)


def test_rare_languages_keep_their_good_documents(spark):
    """40 good documents of a language beside 60,000 of another are all counted."""
    docs = spark.range(60_080).selectExpr("id as doc_id", "'t' as text", "if(id < 60000, 'aa', 'bb') as lang")
    labels = docs.selectExpr("doc_id", "if(doc_id < 60040, 1, 0) as quality")
    counted = quality.good_sample(docs, labels).groupBy("lang").count().collect()
    assert {r["lang"]: r["count"] for r in counted} == {"aa": 60_000, "bb": 40}


def test_odd_rows(spark, odd):
    rows = quality.judge(odd, odd.filter("lang = 'en'"), least=2).collect()
    assert Counter((r["doc_id"], *tuple(r)[1:6]) for r in rows) == Counter((r["doc_id"], *brute(r["text"])) for r in odd.collect())
    assert all((r["score"] is None) == (r["low"] is None) or r["base_failed"] for r in rows)
    carried = quality.with_verdict(odd.drop("words", "score", "h", "n"), odd.limit(0))
    assert carried.count() == odd.count() and set(odd.drop("words", "score", "h", "n").columns) < set(carried.columns)


def test_empty(docs):
    assert quality.judge(docs.limit(0), docs.limit(0)).collect() == []


def test_probabilities_sum_to_one(spark):
    folder = new_dir(spark, "quality")
    texts = ["abracadabra banana", "cab bad dab a", "bananas", "", "a b c d"]
    quality.train(spark.createDataFrame([("xx", t) for t in texts] + [("yy", "zz")], "lang string, text string"), folder)
    model = quality.Model(folder)
    alphabet = [*sorted({ord(c) for c in "".join(texts)}), quality.END]
    for context in ((quality.BEGIN, quality.BEGIN), (ord("a"), ord("b")), (ord("q"), ord("n")), (ord("q"), ord("q"))):
        grams = np.array([(context[0] << 42) | (context[1] << 21) | c for c in [*alphabet, ord("q")]], np.uint64)
        assert (10 ** model.log10("xx", grams)).sum() == pytest.approx(1, abs=1e-5)
    assert math.isnan(model.log10("other", grams)[0])


def test_ids_in_hash_arrays(spark, monkeypatch):
    """Every id is found and no other, in one shard or many, negative and null ids included."""
    from pricebasket.llm import hash_arrays

    ids = [*range(-50, 2000, 3), 2**63 - 1, -(2**63)]
    for keys in (2_000_000, 100):
        monkeypatch.setattr(hash_arrays, "SET_KEYS", keys)
        found = hash_arrays.save_ids(spark.createDataFrame([(i,) for i in [*ids, *ids, None]], "id long"), f"{new_dir(spark, 'ids')}/ids")
        probe = np.array([*range(-100, 2100), 2**63 - 1, -(2**63)], np.int64)
        assert (found.has(probe) == np.isin(probe, np.array(ids, np.int64))).all()
    none = hash_arrays.save_ids(spark.createDataFrame([], "id long"), f"{new_dir(spark, 'ids')}/ids")
    assert not none.has(probe).any()


def test_no_text_is_shuffled_for_the_model(spark, docs, sf_dir, monkeypatch):
    """With broadcasts off, as for tables of any size: the good texts reach the counting tasks by a scan alone."""
    monkeypatch.setattr(quality, "broadcast_if_small", lambda rows, *_: rows)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        good = quality.good_sample(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
        assert "Exchange" not in good._jdf.queryExecution().executedPlan().toString()
        assert good.count() > 50
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rare_languages_have_no_model(spark):
    folder = new_dir(spark, "quality")
    rows = [("xx", f"text {i}") for i in range(9)] + [("yy", "few")]
    quality.train(spark.createDataFrame(rows, "lang string, text string"), folder, least=5)
    model = quality.Model(folder)
    assert np.isfinite(model.means("xx", ["text"])).all() and np.isnan(model.means("yy", ["few"])).all()


def test_languages_of_few_good_documents_are_judged(spark):
    """A language of 2, 3, 6 or 12 good documents has a band: junk goes, clean documents and the good ones themselves stay."""
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abdeiklmnorstu"), rng.integers(2, 9))) for _ in range(300)]
    clean = lambda: " ".join(rng.choice(words, 300))
    rows, good, junk = [], [], []
    for lang, n in (("b2", 2), ("c3", 3), ("f6", 6), (None, 12)):
        good += [(clean(), lang) for _ in range(n)]
        junk += [(" ".join("".join(rng.choice(list("#*$%&|<>x"), 6)) for _ in range(90)), lang)]
        rows += [(clean(), lang) for _ in range(10)]
    one, none = (clean(), "a1"), (clean(), "zz")
    docs = [(i, *row) for i, row in enumerate([*good, *rows, *junk, one, none])]
    schema = "text string, lang string"
    got = {r["doc_id"]: r for r in quality.judge(
        spark.createDataFrame(docs, f"doc_id long, {schema}"), spark.createDataFrame([*good, one, good[0]], schema)).collect()}
    held = [got[i] for i in range(len(good) + len(rows))]
    assert all(r["score"] is not None and r["low"] is not None for r in held) and all(r["kept"] for r in held[: len(good)])
    assert np.mean([r["kept"] for r in held]) > 0.9
    rejected = [got[i] for i in range(len(held), len(docs) - 2)]
    assert not any(r["base_failed"] or r["kept"] for r in rejected) and all(r["score"] < r["low"] for r in rejected)
    assert [(got[i]["score"], got[i]["low"], got[i]["kept"]) for i in (len(docs) - 2, len(docs) - 1)] == [(None, None, True)] * 2
