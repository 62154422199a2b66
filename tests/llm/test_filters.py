"""URL filter, decontamination and toxicity."""

import math
import random
import re

import numpy as np
import pytest
from pvscan.llm import decontaminate, toxicity, url_filter
from pyspark.sql import functions as F

URLS = [None, "", "no scheme", "http://", "http://ORG", "http://a.org/", "https://www.Example.org/es/1?x#y", "https://example.org/en/19", "https://example.org/en/2", "x://com/fr/", "x://a.b.com/de/9", "x://notcom/de/", "http://u@h.com:80/de/", "http://com?/de/", "a://b://c.org/z", "http://xexample.org/es/", "http://example.org", "http://example.org/es/" + "a" * 50_000, "http://" + "a." * 2000 + "com/de/"]


def brute_url(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = "".join(c.lower() if c.isascii() else c for c in host)
    fit = [(len(h + p), h + p, v) for h, p, v in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fit)[1] if fit else None, max(fit)[2] if fit else "allow"


@pytest.mark.parametrize("most", [100, 1])
def test_urls_like_brute_force(spark, most):
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate([*URLS, URLS[6]])], "page_id int, url string, host string")
    rules = spark.createDataFrame([*url_filter.RULES, (None, "/", "block"), ("", "/", "block"), url_filter.RULES[0]], "host string, path string, verdict string")
    out = url_filter.filter_urls(pages, rules, broadcast_rules=most).orderBy("page_id").collect()
    assert [(r.host, r.path, r.rule, r.verdict) for r in out] == [brute_url(u) for u in [*URLS, URLS[6]]]


def test_urls_without_rows_or_rules(spark):
    none = spark.createDataFrame([], "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, "http://a.org/")], "page_id int, url string")
    assert url_filter.filter_urls(pages, none).first().verdict == "allow"
    rules = spark.createDataFrame(url_filter.RULES, "host string, path string, verdict string")
    assert url_filter.filter_urls(pages.limit(0), rules).count() == 0


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def bench_words(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def brute_hits(text, items):
    w, hit, found = bench_words(text), set(), set()
    for item, own in items:
        b = bench_words(own)
        n = min(13, len(b))
        grams = {tuple(b[i : i + n]) for i in range(len(b) - n + 1)} if n else set()
        for s in range(len(w) - n + 1) if n else ():
            if tuple(w[s : s + n]) in grams:
                hit |= set(range(s, s + n))
                found.add(str(item))
    return len(w), len(hit), sorted(found)


@pytest.fixture(scope="module")
def bench(rows):
    rnd = random.Random(5)
    items = [(i, " ".join((r[1] or "").split()[2:40])) for i, r in enumerate(rnd.sample(rows, 12))]
    return [*items, (90, None), (91, ""), (92, "Kara"), (93, "kara NO-lo"), (94, items[0][1])]


@pytest.mark.parametrize(("most", "few"), [(10_000, 10**6), (1, 10**6), (10_000, 0)])
def test_decontamination_like_brute_force(spark, docs, rows, bench, most, few):
    items = spark.createDataFrame(bench, "item_id long, text string")
    clash = docs.selectExpr("*", "1 as key", "2 as ws", "3 as g4", "4 as row", "5 as __c4")
    out = decontaminate.scan(clash, items, max_windows=most, few=few)
    assert out.columns == [*clash.columns, "n_words", "hits", "n_hit", "items"]
    out = out.where("key = 1 and ws = 2 and g4 = 3 and row = 4 and __c4 = 5").select("doc_id", "text", "n_words", "n_hit", "items").collect()
    want = [(r[0], r[1], *brute_hits(r[1], bench)) for r in rows]
    order = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    assert [(*r[:4], list(r[4])) for r in sorted(out, key=order)] == [(*w[:4], w[4]) for w in sorted(want, key=order)]


def test_removal(spark, docs, rows, bench, no_docs):
    items = spark.createDataFrame(bench, "item_id long, text string")
    kept = decontaminate.remove_documents(docs.withColumn("hits", F.lit("mine")), items)
    assert kept.columns == [*docs.columns, "hits"] and kept.first().hits == "mine"
    clean = [r for r in rows if not (lambda n, h, _: h > 0 and 20 * h >= n)(*brute_hits(r[1], bench))]
    assert kept.count() == len(clean) == decontaminate.remove_documents(docs, items, max_windows=1, few=0).count()
    spans = decontaminate.remove_spans(docs, items)
    for r in spans.collect():
        assert r.clean_text == r.text if r.n_hit == 0 else len(bench_words(r.clean_text)) == r.n_words - r.n_hit
    assert decontaminate.scan(no_docs, items).count() == 0
    assert decontaminate.scan(docs, items.limit(0)).where("n_hit > 0").count() == 0


def graded(n, seed):
    rnd = random.Random(seed)
    rows, grades = [], []
    for i in range(n):
        g = rnd.choice([0, 0, 0, 1, 2])
        words = [f"w{rnd.randrange(300)}" for _ in range(rnd.randrange(5, 60))] + {0: [], 1: ["mild"], 2: ["mild", "vile"]}[g]
        rnd.shuffle(words)
        rows.append((i, " ".join(words)))
        grades.append((i, g))
    return rows, grades


def test_ordinal_grades_on_held_out_rows(spark):
    rows, grades = graded(1500, 1)
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(grades[:1000], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    assert model.grades == 3 and (np.diff(model.thresholds) > 0).all()
    out = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    held = [(out[i].grade, out[i].severity, g) for i, g in grades[1000:]]
    assert np.mean([a == g for a, _, g in held]) > 0.95
    assert np.mean([abs(s - g) for _, s, g in held]) < 0.15


def loss(p, x, grade, grades, l2=0.3):
    """Penalised negative log likelihood of cumulative links: p holds the weights, then the thresholds."""
    w, theta = p[: x.shape[1]], p[x.shape[1] :]
    if (np.diff(theta) <= 0).any():
        return np.inf
    total = l2 / 2 * float(w @ w)
    for row, g in zip(x, grade, strict=True):
        s = float(row @ w)
        below = [1 / (1 + math.exp(s - t)) for t in theta]
        prob = (below[g] if g < grades - 1 else 1.0) - (below[g - 1] if g else 0.0)
        total -= math.log(max(prob, 1e-300))
    return total


def descended(x, grade, grades, steps=400):
    """The least loss by numeric gradients and a line search."""
    p = np.concatenate([np.zeros(x.shape[1]), np.arange(grades - 1) - 0.5])
    rate = 0.05
    for _ in range(steps):
        slope = np.array([(loss(p + d, x, grade, grades) - loss(p - d, x, grade, grades)) / 2e-5 for d in np.eye(len(p)) * 1e-5])
        while rate > 1e-9 and loss(p - rate * slope, x, grade, grades) > loss(p, x, grade, grades):
            rate /= 2
        p, rate = p - rate * slope, rate * 1.5
    return p


@pytest.mark.parametrize("grades", [2, 4])
def test_ordinal_fit_is_the_likelihood_optimum(grades):
    rng = np.random.default_rng(grades)
    x = (rng.random((80, 4)) < 0.4).astype(float)
    grade = np.clip((x @ np.array([1.5, -1.0, 0.5, 0.0]) + rng.normal(0, 1, 80) + 1).astype(int), 0, grades - 1)
    doc, feature = np.nonzero(x)
    model = toxicity.fit_ordinal(doc, feature.astype(np.uint64) + 10, grade, grades, steps=4000, rate=0.02)
    assert model.features.tolist() == [10, 11, 12, 13] and (np.diff(model.thresholds) > 0).all()
    own, best = np.concatenate([model.weights, model.thresholds]), descended(x, grade, grades)
    assert loss(own, x, grade, grades) <= loss(best, x, grade, grades) + 1e-3
    assert np.allclose(own, best, atol=0.02)


def test_expected_severity_like_brute_force():
    import pyarrow as pa
    from pvscan.llm import textgrams

    def named(word):
        raw = np.frombuffer(word.encode(), np.uint8)
        own = {int(textgrams.span_hashes(raw, np.array([0]), np.array([len(raw)]))[0])}
        for size in toxicity.BEGINNINGS:
            if len(raw) > size:
                h = textgrams.span_hashes(raw, np.array([0]), np.array([size])) + np.uint64(size)
                own.add(int(textgrams.mix(h)[0]))
        return own

    texts = ["Vile, vile HORRIBLE things", "", None, "nice ÉTÉ", "horribly horrible" * 40, "x " * 3000 + "vile"]
    weights = {}
    for k, word in enumerate(("vile", "horrible", "nice", "things")):
        weights |= {f: 0.7 * k - 0.5 for f in named(word)}
    features = np.array(sorted(weights), np.uint64)
    model = toxicity.Model(features, np.array([weights[int(f)] for f in features]), np.array([-0.4, 0.3, 1.1]), 4)
    severity, most = toxicity.severities(model, pa.array(texts))
    for k, text in enumerate(texts):
        found = re.findall(r"[0-9a-z\x80-\U0010FFFF]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
        score = sum(weights.get(f, 0.0) for f in set().union(*map(named, found)))
        below = [0.0, *(1 / (1 + math.exp(score - t)) for t in model.thresholds), 1.0]
        prob = np.diff(below)
        assert severity[k] == pytest.approx(sum(g * p for g, p in enumerate(prob))) and most[k] == prob.argmax()


def test_repeated_documents_of_a_label_count_once(spark):
    rows, grades = graded(300, 2)
    labels = spark.createDataFrame(grades, "doc_id long, toxic int")
    one, many = (toxicity.fit(spark.createDataFrame(rows + rows[:1] * n, "doc_id long, text string"), labels) for n in (0, 50))
    assert np.array_equal(one.features, many.features) and np.allclose(one.weights, many.weights) and np.allclose(one.thresholds, many.thresholds)


def test_toxicity_on_given_labels(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{sf}/labels.parquet")
    train, test = labels.where("doc_id % 5 > 0"), labels.where("doc_id % 5 = 0")
    model = toxicity.fit(docs, train)
    got = toxicity.score(docs, model).join(test, "doc_id").select((F.col("severity") >= 0.5).alias("p"), (F.col("toxic") > 0).alias("t")).toPandas()
    assert (got.p & got.t).sum() / got.t.sum() > 0.9  # some labels are wrong by design
    assert (got.p & ~got.t).sum() / (~got.t).sum() < 0.03


def test_toxicity_edge_cases(spark, docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.score(docs, toxicity.fit(docs, none)).where("severity = 0").count() == docs.count()
    odd = spark.createDataFrame([(None, 1), (503, None), (504, -1), (503, 1), (503, 0), (504, 0)], "doc_id long, toxic int")
    model = toxicity.fit(docs, odd)
    assert model.grades == 2
    scored = toxicity.score(docs.withColumn("severity", F.lit("x")), model)
    assert scored.columns == [*docs.columns, "severity", "grade"] and scored.where("severity is null").count() == 0
    assert toxicity.score(no_docs, model).count() == 0
