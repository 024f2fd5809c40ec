"""Near-duplicates against all pairs, large groups, and the table walk across batch borders."""

import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pricebasket.llm import components, near_dup


def sets_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def sets(text):
    words = sets_words(text)
    return set(zip(words, words[1:])) if len(words) > 1 else {tuple(words)} if words else set()


def brute(rows, percent=80):
    found = [(key, sets(text)) for key, text in rows]
    parent = list(range(len(found)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, a) in enumerate(found):
        for j in range(i):
            b = found[j][1]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[root(i)] = root(j)
    least = {}
    for i, (key, _) in enumerate(found):
        if key is not None:
            least[root(i)] = min(key, least.get(root(i), key))
    out = Counter()
    for i, (key, s) in enumerate(found):
        component = least.get(root(i))
        out[(key, len(s), component, key == component)] += 1
    return out


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_equals_all_pairs(request, which):
    docs = request.getfixturevalue(which)
    got = Counter(tuple(r) for r in near_dup.near_duplicates(docs).collect())
    assert got == brute([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_groups_of_copies_and_chains(spark):
    """Copies, a chain of slow change, families below the threshold, and a frequent beginning."""
    rng = np.random.default_rng(5)
    word = lambda: f"w{rng.integers(0, 5000)}"
    base = [word() for _ in range(120)]
    rows = [" ".join(base)] * 30
    now = list(base)
    for _ in range(40):
        now[int(rng.integers(0, 120))] = word()
        rows.append(" ".join(now))
    for _ in range(30):
        changed = list(base)
        for place in rng.choice(120, 9, replace=False):
            changed[place] = word()
        rows.append(" ".join(changed))
    rows += ["same start of all " + " ".join(word() for _ in range(20)) for _ in range(50)]
    docs = [(i * 3, text) for i, text in enumerate(rows)]
    got = Counter(tuple(r) for r in near_dup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect())
    assert got == brute(docs)


def test_large_entries_are_gone_through_again(spark):
    rng = np.random.default_rng(6)
    common = [f"c{i}" for i in range(60)]
    docs = []
    for family in range(12):
        own = [f"f{family}x{rng.integers(0, 10**6)}" for _ in range(25)]
        for member in range(4):
            docs.append((len(docs), " ".join([*common, *own, f"m{member}"])))
    got = Counter(tuple(r) for r in near_dup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), rounds=12, heads=1).collect())
    assert got == brute(docs)


def test_pairs_in_a_family_below_the_threshold(spark):
    """2,000 documents of Jaccard 0.793 to one another, 40 pairs of them at 0.817, with the production heads."""
    common = [f"c{i}" for i in range(300)]
    tails = [[f"t{doc}x{i}" for i in range(39)] for doc in range(2000)]
    for planted in range(40):
        tails[1999 - planted][-5:] = tails[planted * 3][-5:]
        tails[1999 - planted][-6] = tails[planted * 3][-6]
    docs = [(doc, " ".join(common + tail)) for doc, tail in enumerate(tails)]
    rare = [(doc, frozenset(sets(" ".join(common[-1:] + tail)))) for doc, tail in enumerate(tails)]
    holders = {}
    for doc, own in rare:
        for shingle in own:
            holders.setdefault(shingle, []).append(doc)
    near = {tuple(each) for each in holders.values() if len(each) == 2}
    linked = {(a, b) for a, b in near if 100 * (299 + len(rare[a][1] & rare[b][1])) >= 80 * (299 + len(rare[a][1] | rare[b][1]))}
    assert linked == {(planted * 3, 1999 - planted) for planted in range(40)} and 299 / (299 + 78) < 0.8
    expected = {doc: doc for doc, _ in docs} | {b: a for a, b in linked}
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert {r["doc_id"]: r["component_id"] for r in near_dup.near_duplicates(frame).collect()} == expected


def test_a_group_of_near_copies_makes_few_pairs(spark, monkeypatch):
    """Of 600 near copies of one text, a class comes into some fifteen pairs to confirm."""
    rng = np.random.default_rng(9)
    base = [f"w{i}" for i in range(150)]
    docs = []
    for doc in range(600):
        changed = list(base)
        for place in rng.choice(150, 4, replace=False):
            changed[place] = f"d{doc}x{place}"
        docs.append((doc, " ".join(changed)))
    seen, inner = [], near_dup.Verifier.linked
    monkeypatch.setattr(near_dup.Verifier, "linked", lambda self, pairs: (seen.append(pairs.count()), inner(self, pairs))[1])
    got = near_dup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).collect()
    assert {r["component_id"] for r in got} == {0} and sum(seen) < 16 * 600


def test_runs_across_batches():
    rows = sorted((k, n) for k, size in ((1, 40), (2, 2), (3, 1), (4, 12)) for n in range(k * 100, k * 100 + size))
    whole = pd.DataFrame({"key": [k for k, _ in rows], "x": [n for _, n in rows], "y": pd.array([None] * len(rows), "Int64")})
    heads = 8
    # All pairs of an entry's first nine, and its first with those up to NEAR.
    expected = {(a, b) for k, a in rows for j, b in rows if k == j and a < b < k * 100 + (near_dup.NEAR if a == k * 100 else heads + 1)}
    for step in (1, 3, 7, 100):
        parts = [whole.iloc[i : i + step].reset_index(drop=True) for i in range(0, len(whole), step)]
        out = pd.concat(list(near_dup._candidates(iter(parts), heads)))
        pairs = out[out["key"].isna()]
        assert set(zip(pairs["x"], pairs["y"])) == expected and len(pairs) == len(expected)
        large = out[out["y"].isna()]
        assert sorted(zip(large["key"], large["x"])) == [r for r in rows if r[0] in (1, 4)]


def test_components(spark):
    path = [(i, i + 1) for i in range(200)]
    links = path + [(1000, i) for i in range(1001, 1100)] + [(5, 5), (2000, 2001)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(links, "x long, y long")).collect()}
    groups = [range(201), range(1000, 1100), (2000, 2001)]
    first = components.components(spark.createDataFrame(links[::2], "x long, y long"))
    later = {r["node"]: r["root"] for r in components.joined(first, spark.createDataFrame(links[1::2], "x long, y long")).collect()}
    assert set(later) == set(got)
    assert [len({later[n] for n in g}) for g in groups] == [1, 1, 1] and len(set(later.values())) == 3
    assert set(got) == {n for g in groups for n in g}
    assert [len({got[n] for n in g}) for g in groups] == [1, 1, 1] and len(set(got.values())) == 3


def test_empty(docs):
    assert near_dup.near_duplicates(docs.limit(0)).collect() == []
