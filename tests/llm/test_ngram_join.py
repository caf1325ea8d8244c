"""The n-gram join on large groups, shared passages and its prefixes, against brute force."""

import numpy as np
import pytest

from carlot.llm import ngram_join as join


def sets_of(texts, k):
    out = []
    for text in texts:
        words = (text or "").lower().split()
        out.append({tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else {tuple(words)} if words else set())
    return out


def links_of(sets, percent):
    return {
        (i, j) for j in range(len(sets)) for i in range(j)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])
    }


def groups_of(n, links):
    group = list(range(n))
    for a, b in links:
        low, high = sorted((group[a], group[b]))
        group = [low if g == high else g for g in group]
    return group


@pytest.fixture(scope="module")
def texts():
    """A large group of near copies, outliers of it, a passage in many texts, and equal texts."""
    rng = np.random.default_rng(9)
    word = lambda: f"w{rng.integers(0, 3000)}"
    base = [word() for _ in range(60)]
    out = []
    for i in range(150):
        copy = list(base)
        for _ in range(int(rng.integers(0, 3 if i < 110 else 9))):
            copy[int(rng.integers(len(copy)))] = word()
        out.append(" ".join(copy))
    passage = " ".join(word() for _ in range(50))
    out += [" ".join(word() for _ in range(int(rng.integers(1, 90)))) + " " + passage for _ in range(60)]
    return out + [out[0], out[0].upper(), None, "", "one", "one two", "one two"]


@pytest.mark.parametrize("listed", [0, 1000])
def test_large_groups(spark, monkeypatch, texts, listed):
    """With pivots and without, and in small packs and buckets."""
    monkeypatch.setattr(join, "LISTED", listed)
    monkeypatch.setattr(join, "PER_BUCKET", 50)
    sets = sets_of(texts, 3)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = {r.doc_id: r for r in join.similar_groups(docs, 3, 90).collect()}
    assert [found[i].n_shingles for i in range(len(texts))] == [len(s) for s in sets]
    assert [found[i].component_id for i in range(len(texts))] == groups_of(len(texts), links_of(sets, 90))


def test_pairs(spark, texts):
    sets = sets_of(texts, 3)
    links = links_of(sets, 80)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    pairs, rows = join.similar_pairs(docs, 3, 80)
    rows = {r.doc_id: r for r in rows.collect()}
    degree = [sum(i in pair for pair in links) for i in range(len(texts))]
    assert [rows[i].n_links for i in range(len(texts))] == degree
    members = {}
    for i, r in rows.items():
        members.setdefault(r.cls, []).append(i)
    listed = {tuple(sorted((i, j))) for r in pairs.collect() for i in members[r.a] for j in members[r.b]}
    assert listed == {(i, j) for i, j in links if rows[i].cls != rows[j].cls}


def test_prefix_choice():
    # too few shared tokens: no partner
    assert join.choose_prefix(100, np.full(89, 2), 90) == (0, 0)
    # short lists: the shortest prefix
    assert join.choose_prefix(100, np.full(90, 2), 90)[0] >= 1
    # long lists at the front: more matches are worth it
    few, many = join.choose_prefix(100, np.full(100, 3), 90)[0], join.choose_prefix(100, np.full(100, 3000), 90)[0]
    assert 1 <= few <= 90 and 1 <= many <= 90
    ell, size = join.choose_prefix(100, np.sort(np.arange(2, 102)), 90)
    assert size == 10 + ell
    # lists that get long behind the first ones end the prefix
    assert join.choose_prefix(100, np.array([2] * 12 + [10**6] * 88), 90) == (2, 12)


def test_clashing_columns_come_back(spark):
    rows = [(1, "a b c d e f g", "kept", "t", 5), (2, "A b c d e f g", "kept", "t", 6), (None, None, "x", None, None), (3, "", "", "", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __row string, cls string, n long")
    assert sorted(map(str, join.drop_near_copies(docs, 5, 80).collect())) == sorted(str(r) for r in docs.collect() if r.doc_id != 2)
