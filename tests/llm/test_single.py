"""Winnowing, chat, mixing, shards and the quality model."""

import hashlib
import io
import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import regex
import xxhash
from pvscan.llm import chat, kneser_ney, mixing, sstable, winnow
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def brute_winnow(text, k=winnow.K, w=winnow.W):
    raw = (text or "").encode()
    if not raw:
        return []
    runs = [signed(xxhash.xxh64_intdigest(raw[i : i + k], 42)) for i in range(max(1, len(raw) - k + 1))]
    kept = []
    for s in range(max(1, len(runs) - w + 1)):
        own = range(s, min(s + w, len(runs)))
        at = max(own, key=lambda i: (-runs[i], i))
        if not kept or kept[-1][1] != at:
            kept.append((runs[at], at))
    return kept


def periodic_texts():
    rnd = random.Random(3)
    units = ["a", "ab", "abc", "é中", "x" * 17, "the cat ", "0123456789" * 5]
    return [rnd.choice(units) * rnd.randrange(1, 60) + "z" * rnd.randrange(40) + rnd.choice(units) * rnd.randrange(1, 30) for _ in range(60)]


@pytest.mark.parametrize("segment", [winnow.SEGMENT, 7])
def test_winnowing_like_brute_force(spark, docs, no_docs, segment):
    texts = docs.select("text").union(spark.createDataFrame([(t,) for t in periodic_texts()], "text string"))
    for k, w in ((winnow.K, winnow.W), (3, 4), (2, 5), (1, 1)):
        out = winnow.with_fingerprint(texts, "text", "fp", k, w, segment).select("text", winnow.positions(F.col("fp")).alias("at"), F.transform("fp", lambda x: x["hash"]).alias("h")).collect()
        for r in out:
            assert list(zip(r.h, r.at, strict=True)) == brute_winnow(r.text, k, w)
        texts = texts.where("length(text) < 3000")
    assert winnow.with_fingerprint(no_docs, "text", "fp").count() == 0


def test_shared_runs_share_a_fingerprint(spark):
    rnd = random.Random(2)
    some = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    shared = some(winnow.K + winnow.W - 1)
    rows = [(i, some(rnd.randrange(400)) + shared + some(rnd.randrange(400))) for i in range(20)]
    out = winnow.with_fingerprint(spark.createDataFrame(rows, "i int, text string"), "text", "fp").select(winnow.hash_set(F.col("fp"))).collect()
    assert set.intersection(*[set(r[0]) for r in out])


def test_one_more_character_in_front_of_unspaced_text(spark):
    rnd = random.Random(6)
    for alphabet in ([chr(0x4E00 + i) for i in range(3000)], [*"abcdefghijklmnopqrstuvwxyz0123456789"]):
        text = "".join(rnd.choice(alphabet) for _ in range(3000))
        df = spark.createDataFrame([(text, alphabet[5] + text)], "a string, b string")
        df = winnow.with_fingerprint(winnow.with_fingerprint(df, "a", "x"), "b", "y")
        assert df.select(winnow.likeness(winnow.hash_set(F.col("x")), winnow.hash_set(F.col("y")))).first()[0] > 0.9


@pytest.mark.parametrize("ids", [[5], [0, 1, 2, 300, 301, 10**12, -7], list(range(600))])
def test_successors(spark, ids):
    got = {r[0]: r[1] for r in winnow.successors(spark.createDataFrame([(i,) for i in ids], "k long"), "k", 16).collect()}
    own = sorted(ids)
    assert got == dict(zip(own, [*own[1:], None], strict=True))


@pytest.mark.parametrize("ids", [[3, 9, 11, 700, 5000], [None, 4], [8], [-3, -1, 2**40]])
def test_edited_texts(spark, tmp_path, ids):
    texts = ["añb cd" * (7 * i + 1) + "x" * 3 * i for i in range(len(ids))]
    spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in winnow.op5_winnowing(spark, str(tmp_path)).collect()}
    for k, i in enumerate(ids):
        text, following = texts[k], texts[(k + 1) % len(ids)]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        assert got[i].n_chars == len(text) and got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        prints = [brute_winnow(x) for x in (text, edited, following)]
        as_text = lambda p: " ".join(f"{h & (1 << 64) - 1:x}@{at}" for h, at in p)
        assert (got[i].fingerprint, got[i].edited_fingerprint) == (as_text(prints[0]), as_text(prints[1]))
        sets = [{h for h, _ in p} for p in prints]
        near = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
        assert got[i].near_edited == pytest.approx(near(sets[0], sets[1])) and got[i].near_next == pytest.approx(near(sets[0], sets[2]))


def test_joined_fingerprints_like_brute_force(spark):
    rnd = random.Random(11)
    texts = [*periodic_texts(), *("".join(rnd.choice("abcdé 中") for _ in range(rnd.randrange(400))) for _ in range(60)), "", "a", "a" * 300]
    rows = [(None, 0, "abc", "abc", "kept")]
    for _ in range(400):
        a, b = rnd.choice(texts), rnd.choice(texts)
        first, second = (t[: rnd.choice([0, 1, len(t) // 2, len(t), rnd.randrange(len(t) + 1)])] for t in (a, b))
        rows.append((first + second, len(first.encode()), a, b, "kept"))
    pairs = spark.createDataFrame(rows, "text string, at int, a string, b string, j_seam0 string")
    for k, w in ((winnow.K, winnow.W), (3, 4), (2, 5), (1, 1)):
        both = winnow.with_fingerprint(winnow.with_fingerprint(pairs, "a", "x", k, w), "b", "y", k, w)
        out = winnow.with_joined_fingerprint(both, "text", "at", "x", "y", "j", k, w)
        assert out.columns == [*both.columns, "j"]
        out = out.select("text", "j_seam0", winnow.positions(F.col("j")).alias("at"), F.transform("j", lambda x: x["hash"]).alias("h")).collect()
        assert len(out) == len(rows)
        for r in out:
            assert r.j_seam0 == "kept" and list(zip(r.h, r.at, strict=True)) == brute_winnow(r.text, k, w)


def test_edited_texts_are_hashed_at_their_seams_only(spark, tmp_path, monkeypatch):
    rnd = random.Random(12)
    texts = ["".join(rnd.choice("abcdé ") for _ in range(4000)) for _ in range(20)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    hashed, plain = [], winnow.with_fingerprint

    def counted(df, text, *a):
        hashed.append(df.agg(F.sum(F.octet_length(text))).first()[0])
        return plain(df, text, *a)

    monkeypatch.setattr(winnow, "with_fingerprint", counted)
    assert winnow.op5_winnowing(spark, str(tmp_path)).count() == 20
    sizes = [len(t.encode()) for t in texts]
    assert sum(hashed) <= sum(sizes) + sizes[0] + 20 * 3 * (winnow.K + winnow.W - 1)  # texts, the block's first one, seams and ends


def test_winnowing_query_on_no_documents(spark, tmp_path, no_docs):
    no_docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert winnow.op5_winnowing(spark, str(tmp_path)).count() == 0


def test_chat_collapses_snapshots(spark):
    rows = [(1, 0, "user", "a"), (2, 0, "user", "a"), (2, 1, "assistant", "b"), (3, 0, "user", "a"), (3, 1, "assistant", "b"), (4, 0, "user", "c"), (4, 0, "user", "c"), (5, 0, None, None), (6, 1, "user", "z"), (6, None, "system", "y"), (None, 0, "user", "a"), (7, 0, "user", "a"), (7, 1, "assistant", "B")]
    turns = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn int, role string, text string, pos string")
    out = {r.conv_id: r for r in chat.collapse_and_render(turns).collect()}
    assert sorted(out) == [2, 4, 5, 6, 7]
    assert out[2].n_turns == 2 and out[2].rendered == "<|im_start|>user\na<|im_end|>\n<|im_start|>assistant\nb<|im_end|>\n"
    assert out[4].n_turns == 1 and out[6].rendered.startswith("<|im_start|>system")
    assert chat.collapse_and_render(turns.limit(0)).count() == 0


def brute_share(amount, wanted, most):
    """Gives a little at a time, by weight, to whoever has room; weightless ones wait."""
    got = [0.0] * len(most)
    left = min(amount, sum(most))
    while left > 1e-9:
        room = [i for i in range(len(most)) if most[i] - got[i] > 1e-9]
        turn = [i for i in room if wanted[i] > 0]
        by = [wanted[i] for i in turn] if turn else [most[i] - got[i] for i in room]
        turn = turn or room
        # the largest round in which nobody gets too much
        step = min(left, min((most[i] - got[i]) * sum(by) / w for i, w in zip(turn, by, strict=True)))
        for i, w in zip(turn, by, strict=True):
            got[i] += step * w / sum(by)
        left -= step
    return got


def brute_budgets(supply, weights, budget, epochs, at=()):
    """Tokens of each leaf, top down."""
    depth = len(at)
    if supply and len(next(iter(supply))) == depth:
        return {at: budget}
    below = sorted({leaf[: depth + 1] for leaf in supply if leaf[:depth] == at})
    most = [epochs * sum(n for leaf, n in supply.items() if leaf[: depth + 1] == c) for c in below]
    out = {}
    for c, part in zip(below, brute_share(budget, [max(0.0, weights.get(c, 1.0)) for c in below], most), strict=True):
        out |= brute_budgets(supply, weights, part, epochs, c)
    return out


def given_budgets(spark, supply, weights, budget, epochs):
    table = spark.createDataFrame([(*leaf, n) for leaf, n in supply.items()], "a string, b string, n long")
    return {(r.a, r.b): r.asked for r in mixing.budgets(table, ["a", "b"], weights, budget, epochs).collect()}


def test_budgets(spark):
    supply = {("a", "x"): 10, ("a", "y"): 1000, ("b", "z"): 1000}
    # x falls short: its sibling y makes up for it before b does
    assert given_budgets(spark, supply, {}, 1000, 1) == {("a", "x"): 10, ("a", "y"): 490, ("b", "z"): 500}
    assert given_budgets(spark, {}, {}, 10, 1) == {}
    assert given_budgets(spark, supply, {("a",): 0.0}, 600, 1) == {("a", "x"): 0, ("a", "y"): 0, ("b", "z"): 600}
    assert given_budgets(spark, supply, {("a",): 0.0, ("a", "x"): 0, ("a", "y"): -1}, 1505, 1) == {("a", "x"): 5, ("a", "y"): 500, ("b", "z"): 1000}


@pytest.mark.parametrize("seed", [0, 1])
def test_budgets_like_brute_force(spark, seed):
    rnd = random.Random(seed)
    for fraction in (0.3, 0.9, 1.4):
        supply = {(f"d{rnd.randrange(5)}", f"s{k}"): rnd.choice([0, 1, 7, 100, 100, 5000]) for k in range(25)}
        weights = {(f"d{k}",): rnd.choice([0.0, 1.0, 2.5, 4.0]) for k in range(4)} | {leaf: rnd.choice([0.0, 1.0, 3.0]) for leaf in list(supply)[::2]}
        budget = fraction * sum(supply.values())
        got = given_budgets(spark, supply, weights, budget, 2)
        want = brute_budgets(supply, weights, budget, 2)
        assert set(got) == set(want) and all(abs(got[k] - want[k]) <= 0.5 + 1e-6 for k in want)


def brute_mix(rows, asked, supply, epochs, seed):
    """(id, text, epoch) of what a leaf's budget reads: whole epochs, then the front of the next one's order."""
    out = []
    for leaf, budget in asked.items():
        own = [r for r in rows if (r[2] or "", r[3] or "") == leaf]
        whole = min(budget // supply[leaf], epochs) if supply[leaf] else 0
        out += [(r[0], r[1], e) for r in own for e in range(whole)]
        rest = budget - whole * supply[leaf] if supply[leaf] and whole < epochs else 0
        name = lambda r: hashlib.md5(f"{seed}|{whole}|{'' if r[0] is None else r[0]}|{signed(xxhash.xxh64_intdigest((r[1] or '').encode(), 42))}".encode()).hexdigest()  # noqa: B023, E731
        before = 0
        for h in sorted({name(r) for r in own}):
            if before >= rest:
                break
            twins = [r for r in own if name(r) == h]
            out += [(r[0], r[1], whole) for r in twins]
            before += sum(len((r[1] or "").split()) for r in twins)
    return out


@pytest.mark.parametrize(("fraction", "epochs", "few"), [(0.5, 1, 100), (1.7, 3, 100), (1.0, 1, 0), (0.0, 2, 0), (0.6, 2, 0)])
def test_mixing_like_brute_force(docs, rows, fraction, epochs, few):
    levels, weights = ["lang", "source"], {("en",): 3.0, ("en", "s1"): 2.0}
    clash = docs.withColumn("epoch", F.lit("mine")).withColumn("leaf", F.lit(1)).withColumn("l0", F.lit(2)).withColumn("row", F.lit(3))
    out = mixing.mix(clash, levels, weights, fraction, epochs, seed=9, few=few)
    assert out.columns == [*docs.columns, "leaf", "l0", "row", "n_tokens", "epoch"]
    supply = Counter()
    for _, t, lang, source in rows:
        supply[(lang or "", source or "")] += len((t or "").split())
    asked = {k: math.floor(v + 0.5) for k, v in brute_budgets(dict(supply), weights, fraction * sum(supply.values()), epochs).items()}
    got = out.collect()
    order = lambda r: tuple((x is None, x) for x in r)
    assert sorted(((r.doc_id, r.text, r.epoch) for r in got), key=order) == sorted(brute_mix(rows, asked, supply, epochs, 9), key=order)
    assert all(r.n_tokens == len((r.text or "").split()) and (r.leaf, r.l0, r["row"]) == (1, 2, 3) for r in got)


def test_mixing_is_a_prefix_of_a_fixed_order(docs, no_docs):
    ids = lambda f: {(r.doc_id, r.text) for r in mixing.mix(docs, ["source"], {}, f, 1, seed=1).collect()}
    assert ids(0.2) <= ids(0.6) <= ids(1.0)
    assert mixing.mix(no_docs, ["source"], {}, 0.5).count() == 0


PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_encoder_is_exact(rows):
    from tokenizers import Tokenizer

    rnd = random.Random(1)
    alphabet = [*"ab'., \n\té× 5!　中 s", "<|endoftext|>", "  "]
    texts = [r[1] for r in rows] + ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(40))) for _ in range(2000)]
    want = [[*x.ids, 0] for x in Tokenizer.from_file(PATH).encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert [x.tolist() for x in sstable.Encoder(PATH, 0)(pa.array(texts))] == want


def test_other_tokenizers_are_encoded_whole():
    path = public_tokenizers.path("word_bpe_49k.json")
    from tokenizers import Tokenizer

    texts = ["Hello  wörld, hello", "", "<|endoftext|> a"]
    want = [[*x.ids, 7] for x in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in sstable.Encoder(path, 7)(pa.array(texts))] == want


def test_shard_round_trip_and_lookup():
    rng = np.random.default_rng(0)
    entries = [(i, rng.integers(0, 60000, rng.integers(1, 400)).astype("<u2")) for i in [None, None, -5, *range(0, 3000, 3), 3000, 3000]]
    file = io.BytesIO()
    writer = sstable.Writer(file, 2)
    for i, v in entries:
        writer.add(sstable.key_of(i), v)
    writer.close()
    with pytest.raises(ValueError):
        writer.add(sstable.key_of(1), entries[0][1])
    reader = sstable.Reader(file)
    assert [(sstable.identifier_of(k), v.tolist()) for k, v in reader] == [(i, v.tolist()) for i, v in entries]
    assert reader.n == len(entries) and len(reader.place) > 3
    for i in (None, -5, 0, 1500, 3000, 1, 9999, -6):
        assert [v.tolist() for v in reader.get(i)] == [v.tolist() for j, v in entries if j == i]
    assert sorted([b"\2b", sstable.key_of("a"), sstable.key_of(-1), sstable.key_of(None)])[0] == b"\0"
    with pytest.raises(ValueError):
        sstable.Reader(io.BytesIO(b"x" * 100))


def test_shards_of_documents(spark, docs, rows, no_docs, tmp_path):
    from tokenizers import Tokenizer

    out = sstable.read_documents(sstable.write_shards(docs, f"file://{tmp_path}/a", PATH)).collect()
    tokenizer, start, want = Tokenizer.from_file(PATH), 0, []
    for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 0]
        want.append((r[0], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted((tuple(r) for r in out), key=lambda r: r[1]) == want
    empty = sstable.write_shards(no_docs, f"file://{tmp_path}/b", PATH)
    assert empty.count() == 0 and sstable.read_documents(empty).count() == 0


START = "\0" * (kneser_ney.ORDER - 1)


def brute_kneser_ney(trusted):
    """log p(last | those before) by the textbook recursion."""
    size = kneser_ney.ORDER
    grams = Counter()
    for t in trusted:
        p = START + t
        grams.update(p[i : i + size] for i in range(len(t)))
    levels = [grams]
    for _ in range(size - 1):
        levels.append(Counter(g[1:] for g in levels[-1]))
    cut = [kneser_ney.discounts([sum(v == k for v in level.values()) for k in (1, 2, 3, 4)]) for level in levels]
    by = [{} for _ in levels]
    for k, level in enumerate(levels):
        for g, n in level.items():
            by[k].setdefault(g[:-1], []).append(n)

    def p(g, k=0):
        lower = p(g[1:], k + 1) if k < size - 1 else 1 / (len(levels[-1]) + 1)
        own = by[k].get(g[:-1])
        if not own:
            return lower
        n, d = levels[k].get(g, 0), cut[k]
        off = 0 if n == 0 else d[min(n, 3) - 1]
        back = sum(d[min(x, 3) - 1] for x in own)
        return (n - off) / sum(own) + back / sum(own) * lower

    return lambda t: sum(math.log(p((START + t)[i : i + size])) for i in range(len(t)))


def test_perplexities_like_brute_force(spark, docs, rows):
    trusted = [r for r in rows if r[0] is not None and r[0] % 3 == 0]
    ids = spark.createDataFrame([(r[0],) for r in trusted] + [(None,), (trusted[0][0],)], "doc_id long")
    score = brute_kneser_ney([r[1] or "" for r in trusted])
    out = sorted(kneser_ney.perplexities(docs, ids).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0, r.n_chars))
    want = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, len(r[1] or "")))
    for r, w in zip(out, want, strict=True):
        text = w[1] or ""
        assert (r.doc_id, r.n_chars) == (w[0], len(text))
        if text:
            assert r.logp == pytest.approx(score(text), rel=1e-5) and r.perplexity == pytest.approx(math.exp(-score(text) / len(text)), rel=1e-5)
        else:
            assert r.perplexity is None


def test_probabilities_sum_to_one(spark):
    texts = ["abracadabra", "abba cab", "dada"]
    size = kneser_ney.ORDER
    counts = Counter((START + t)[i : i + size] for t in texts for i in range(len(t)))
    packed = lambda g: sum(ord(c) << kneser_ney.BITS * (size - 1 - i) for i, c in enumerate(g))
    table = spark.createDataFrame([(packed(g), n) for g, n in counts.items()], "gram long, n long")
    letters = sorted({c for t in texts for c in t}) + ["?"]
    for context in ("cabr", START, "zzzz"):
        asked = spark.createDataFrame([(packed(context + c),) for c in letters], "gram long")
        assert sum(math.exp(r.logp) for r in kneser_ney.probabilities(asked, table).collect()) == pytest.approx(1, abs=1e-5)


@pytest.mark.parametrize(("chunk", "least"), [(kneser_ney.CHUNK, 3), (100, 1), (kneser_ney.CHUNK, 100)])
def test_quality_thresholds_like_brute_force(spark, monkeypatch, chunk, least):
    monkeypatch.setattr(kneser_ney, "CHUNK", chunk)
    rnd = random.Random(11)
    some = lambda: " ".join(rnd.choice(["le", "chat", "dort", "là", "bas", "中"]) for _ in range(rnd.randrange(1, 30)))
    rows = [(i, some(), rnd.choice(["fr", "fr", None, "x"])) for i in range(120)] + [(300, "zqx" * 30, "fr"), (301, "", "fr")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    good = list(range(0, 120, 2))
    labels = spark.createDataFrame([(i, 1) for i in good], "doc_id long, quality int")
    held = {r[0] for r in docs.where(kneser_ney.held_out(F.col("doc_id"))).collect()} & set(good)
    assert 0 < len(held) < 20
    score = brute_kneser_ney([t for i, t, _ in rows if i in set(good) - held])
    own = {i: math.exp(-score(t) / len(t)) for i, t, _ in rows if t}

    def threshold(chosen, quantile=0.5):
        values = sorted(own[i] for i in chosen)
        return values[max(0, math.ceil(quantile * len(values)) - 1)]

    for r in kneser_ney.classify(docs, labels, quantile=0.5, least=least).collect():
        peers = [i for i, _, lang in rows if i in held and lang == r.lang]
        want = threshold(next(x for x in (peers, held, good) if len(x) >= least or x is good))
        assert r.threshold == pytest.approx(want, rel=1e-5)
        assert r.keep == (r.doc_id in own and own[r.doc_id] <= want * (1 + 1e-6))
    assert spark.catalog.listTables() == []


def test_rare_characters_share_a_number(spark):
    texts = spark.createDataFrame([("".join(chr(0x4E00 + i) for i in range(5000)) + "ab" * 9,), (None,)], "text string")
    table = kneser_ney.vocabulary(texts)
    assert {int(table[ord("a")]), int(table[ord("b")])} == {1, 2} and len(set(table.tolist())) == kneser_ney.KNOWN + 1
    assert table[ord("z")] == kneser_ney.KNOWN + 1


def test_quality_keeps_language_and_drops_noise(spark, no_docs):
    rnd = random.Random(4)
    clean = lambda: " ".join(rnd.choice(["the", "cat", "sat", "on", "mat", "and", "dog", "ran"]) for _ in range(60))
    noise = lambda: "".join(rnd.choice("#$%&*QXZ!?") for _ in range(200))
    rows = [(i, clean(), "en" if i % 2 else None) for i in range(80)] + [(100 + i, noise(), "en") for i in range(10)] + [(200, None, "en"), (201, clean(), "xx")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("keep", F.lit("mine"))
    labels = spark.createDataFrame([(i, 1) for i in range(40)] + [(100, 0), (None, 1), (101, None)], "doc_id long, quality int")
    out = {r.doc_id: r for r in kneser_ney.classify(docs, labels, quantile=1.0).collect()}
    assert not any(out[100 + i].keep for i in range(10)) and not out[200].keep
    assert sum(out[i].keep for i in range(80)) > 70
    assert kneser_ney.classify(no_docs, labels).count() == 0
    assert all(r.keep for r in kneser_ney.classify(docs.where("text is not null"), labels.limit(0)).collect())
