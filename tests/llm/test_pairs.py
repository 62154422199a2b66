"""Jaccard join and substring dedup against brute force."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pvscan.llm import jaccard, substrings, textgrams

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def shingles(text):
    w = words("".join(c.lower() if c.isascii() else c for c in text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_components(rows):
    sets = [shingles(t) for _, t, *_ in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]) and label[i] != label[j]:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    out = []
    for i, r in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if label[j] == label[i] and rows[j][0] is not None]
        out.append((r[0], len(sets[i]), min(ids) if ids else None))
    return out


def key(r):
    return tuple((x is None, x) for x in r)


@pytest.mark.parametrize("how", [{}, {"most": 200, "block": 2, "least_hot": 2}, {"block": 2, "least_hot": 2, "held": 16}])
def test_near_duplicates_like_brute_force(docs, rows, how):
    got = [tuple(r) for r in jaccard.near_duplicates(docs, **how).select("doc_id", "n_shingles", "component_id").collect()]
    assert sorted(got, key=key) == sorted(brute_components(rows), key=key)


def test_near_duplicates_of_nothing_and_clashing_columns(spark, no_docs, docs):
    assert jaccard.near_duplicates(no_docs).count() == 0
    clash = docs.selectExpr("doc_id", "text", "'a' as cls", "'b' as component_id", "'c' as key")
    assert jaccard.near_duplicates(clash).count() == docs.count()


def test_keep_one(spark, docs, rows):
    kept = jaccard.keep_one(docs).collect()
    ids = [r.doc_id for r in kept if r.doc_id is not None]
    assert len(ids) == len(set(ids))
    assert set(ids) == {c for i, _, c in brute_components(rows) if i == c and c is not None}
    assert kept[0].__fields__ == docs.columns


def test_tree_finds_all_links():
    rng = np.random.default_rng(3)
    sets = []
    for _ in range(150):
        base = np.unique(rng.integers(0, 1 << 63, rng.integers(1, 200)).astype(np.uint64))
        sets += [base, np.unique(np.concatenate([base[len(base) // 8 :], rng.integers(0, 1 << 63, len(base) // 8).astype(np.uint64)]))]
    sets.append(np.empty(0, np.uint64))
    label = jaccard.connected(sets)
    for i in range(len(sets)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if len(sets[i]) and len(sets[j]) and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                assert label[i] == label[j]
    assert (label == label[-1]).sum() == 1


def test_bound_never_under_the_overlap():
    rng = np.random.default_rng(4)
    for _ in range(50):
        a, b = (np.unique(rng.integers(0, 3000, rng.integers(1, 2000)).astype(np.uint64)) for _ in range(2))
        packed = [jaccard._packed(jaccard.point(x, jaccard.groups_for(len(x)))) for x in (a, b)]
        assert jaccard.bound(*packed) >= len(np.intersect1d(a, b))


def thue_morse(letters, n):
    """Two complementary words on which polynomial hashes modulo a power of two agree."""
    out = []
    for flip in (0, 1):
        out.append("".join(letters[bin(i).count("1") % 2 ^ flip] for i in range(n)))
    return out


def test_words_that_defeat_polynomials(spark):
    x, y = thue_morse("ab", 2048)
    assert len(set(textgrams.words(pa.array([f"{x} {y} {x[:48]} {y[:48]}"])).hash.tolist())) == 4
    rest = " ".join(f"w{i}" for i in range(30))
    rows = [(1, f"{x} {rest}"), (2, f"{y} {rest}"), (3, x), (4, y)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard.near_duplicates(docs).collect()}
    assert got == {i: c for i, _, c in brute_components(rows)} and got[4] == 4
    out = {r.doc_id: r.n_removed for r in substrings.remove_repeats(docs).collect()}
    assert out == {r[0]: r[2] for r in brute_repeats(rows)}


def test_very_many_equal_texts_are_one_class(spark, tmp_path):
    """The pass over shingles sees one row of the copies, whatever their number."""
    seen = []
    text = " ".join(f"w{i}" for i in range(40))
    docs = spark.range(100_000).selectExpr("id as doc_id", f"'{text}' as text").union(spark.createDataFrame([(-5, text + " end"), (-4, "else " * 9)], "doc_id long, text string"))
    write = jaccard.written
    try:
        jaccard.written = lambda df, name: (seen.append((name, write(df, name).count())), write(df, name))[1]
        out = jaccard.near_duplicates(docs).groupBy("component_id").count().collect()
    finally:
        jaccard.written = write
    assert {r[0]: r[1] for r in out} == {-5: 100_001, -4: 1}
    assert dict(seen)["classes"] == 3 and dict(seen)["met"] < 100


def halves(seed, groups=30):
    """Groups of texts whose likeness lies around the threshold: some link, most only share many shingles."""
    rnd = random.Random(seed)
    rows = []
    for g in range(groups):
        base = [f"g{g}w{i}" for i in range(rnd.choice([8, 60, 200]))]
        for k in range(6):
            own = list(base)
            for i in rnd.sample(range(len(own)), len(own) * k // 150):
                own[i] = f"x{rnd.randrange(10**9)}"
            rows.append((10 * g + k, " ".join(own + [f"y{rnd.randrange(10**9)}" for _ in range(rnd.randrange(len(base) // 10 + 1))])))
    return rows


def test_pairs_around_the_threshold_and_what_is_written(spark, monkeypatch):
    """No link is lost by the positional filter, which drops most pairs that only share shingles; tokens are in one table alone, gone when they were dealt."""
    rows = halves(5)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    seen, gone, write, discard = [], [], jaccard.written, jaccard.discard

    def watched(df, name):
        table = write(df, name)
        seen.append((name, table, table.where("kind = 0").select("a", "b").distinct().count() if name == "met" else 0))
        return table

    monkeypatch.setattr(jaccard, "written", watched)
    monkeypatch.setattr(jaccard, "discard", lambda *x: (gone.extend((y, len(seen)) for y in x), discard(*x)))
    # nothing is listed as frequent, and no group is a star
    got = [tuple(r) for r in jaccard.near_duplicates(docs, least_hot=1000).select("doc_id", "n_shingles", "component_id").collect()]
    assert sorted(got, key=key) == sorted(brute_components(rows), key=key)
    sets = [shingles(t) for _, t in rows]
    alike = sum(100 * len(a & b) >= 75 * len(a | b) for i, a in enumerate(sets) for b in sets[:i])
    # without the filter: pairs of compatible size that share a shingle of their prefixes
    order = lambda x: sorted(x, key=lambda g: hashlib.md5(repr(g).encode()).digest())
    front = [set(order(x)[: len(x) - -(-75 * len(x) // 100) + 1]) for x in sets]
    met = sum(bool(a & b) and 100 * min(len(x), len(y)) >= 75 * max(len(x), len(y)) for i, (a, x) in enumerate(zip(front, sets)) for b, y in zip(front[:i], sets))
    pairs = next(n for name, _, n in seen if name == "met")
    assert alike > 20 and alike <= pairs < 0.8 * met
    assert [name for name, table, _ in seen if "tokens" in table.columns] == ["sketch"]
    at = [name for name, *_ in seen].index("met") + 2
    assert any("tokens" in table.columns and when <= at for table, when in gone)


def brute_repeats(rows):
    starts = {}
    for i, t, *_ in rows:
        w = words(t)
        for s in range(len(w) - 12):
            if i is not None:
                g = tuple(w[s : s + 13])
                starts[g] = min(starts.get(g, i), i)
    out = []
    for i, t, *_ in rows:
        w = words(t)
        cut = set()
        for s in range(len(w) - 12):
            if i is not None and starts[tuple(w[s : s + 13])] < i:
                cut |= set(range(s, s + 13))
        kept = " ".join(x for k, x in enumerate(w) if k not in cut)
        out.append((i, len(w), len(cut), hashlib.sha256(kept.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("how", [{"least": 2}, {"least": 32}, {"least": 10_000, "held": 8}, {"least": 2, "most": 60}])
def test_repeats_like_brute_force(docs, rows, how):
    out = substrings.remove_repeats(docs, **how).collect()
    got = [(r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept_text.encode()).hexdigest()) for r in out]
    assert sorted(got, key=key) == sorted(brute_repeats(rows), key=key)
    for r in out:
        assert sum(s.end - s.start for s in r.repeats) == r.n_removed
        assert all(s.end - s.start >= 13 for s in r.repeats)


@pytest.mark.parametrize("how", [{"least": 2}, {"least": 10_000}, {"least": 10_000, "held": 4}])
def test_repeats_of_periodic_texts(spark, how):
    """An anchor occurs several times in one window; matches must lie alike around it."""
    rnd = random.Random(5)
    rows = []
    for i in range(60):
        unit = [rnd.choice("abc") for _ in range(rnd.randrange(1, 7))]
        text = unit * rnd.randrange(3, 14)
        rows.append((i % 50, " ".join(text[: rnd.randrange(10, 45)] + [rnd.choice("abcd") for _ in range(rnd.randrange(6))])))
    out = substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), **how).collect()
    got = [(r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept_text.encode()).hexdigest()) for r in out]
    assert sorted(got) == sorted(brute_repeats(rows))


def test_repeats_keep_columns(docs, no_docs):
    assert substrings.remove_repeats(no_docs).count() == 0
    clash = docs.selectExpr("*", "'x' as kept_text", "1 as doc", "'y' as hash", "2 as __key", "3 as id", "4 as row")
    out = substrings.remove_repeats(clash)
    assert {(r.lang, r.doc, r.hash, r["__key"], r.id, r.row) for r in out.collect()} == {(x, 1, "y", 2, 3, 4) for x in ("en", "de", None)}
    assert out.columns == ["doc_id", "text", "lang", "source", "doc", "hash", "__key", "id", "row", "n_words", "n_removed", "repeats", "kept_text"]
    assert out.count() == docs.count()


@pytest.mark.parametrize("k", [1, 5, 13])
def test_grams_of_few_words(k):
    w = textgrams.words(pa.array([" ".join(f"w{i}" for i in range(30))]))
    whole = textgrams.gram_hashes(w, k)
    for n in range(15):
        got = textgrams.gram_hashes(textgrams.words(pa.array([" ".join(f"w{i}" for i in range(n))])), k)
        fit = max(0, n - k + 1)
        assert len(got) == n and (got[:fit] == whole[:fit]).all()


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 11, 12, 13])
def test_tables_of_one_short_text(spark, n):
    rows = [(7, " ".join(f"w{i}" for i in range(n)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    near = [tuple(r) for r in jaccard.near_duplicates(docs).select("doc_id", "n_shingles", "component_id").collect()]
    assert near == brute_components(rows)
    assert [tuple(r) for r in jaccard.keep_one(docs).select("doc_id", "text").collect()] == rows
    out = substrings.remove_repeats(docs).collect()
    assert [(r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in out] == [(7, n, 0, rows[0][1])]
