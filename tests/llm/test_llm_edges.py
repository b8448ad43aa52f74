"""Brute-force versions of the models, recall of the approximate searches, and edge tables for every operator."""

import itertools
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from broadloom.llm import bpe, common, components, embedding_dedup, exact_dedup, language_id, packing, quality, secrets, simhash, substring_dedup, warc
from broadloom.llm.common import shared_folder, stored

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

# language models


def plain_kneser_ney(texts, order=language_id.ORDER, discount=language_id.DISCOUNT):
    """Interpolated Kneser-Ney with dictionaries: a function from a context and a character to a probability, and the counts."""
    grams = [Counter() for _ in range(order + 1)]
    for text in texts:
        for i, word in enumerate(language_id.words_of(text)):
            padded = "\0" * (order - 1) + " " + word + " "
            for k in range(order, len(padded)):
                grams[order][padded[k - order + 1 : k + 1]] += 1
    for n in range(order - 1, 0, -1):  # how many characters stand before
        for g in grams[n + 1]:
            grams[n][g[1:]] += 1
    floor = 1 / (1 + 1 + len({g[-1] for g in grams[order]}))
    above = [defaultdict(list) for _ in range(order + 1)]
    for n in range(1, order + 1):
        for g, c in grams[n].items():
            above[n][g[:-1]].append(c)

    def probability(context, c, n=order):
        if n == 0:
            return floor
        context = context[len(context) - n + 1 :]
        lower = probability(context[1:] if n > 1 else "", c, n - 1)
        seen = above[n].get(context)
        if not seen:
            return lower
        return max(grams[n].get(context + c, 0) - discount, 0) / sum(seen) + discount * len(seen) / sum(seen) * lower

    return probability, grams


def fitted(texts_by_lang):
    counts = {}
    for lang, texts in texts_by_lang.items():
        words = [w for t in texts for w in language_id.words_of(t)]
        counts[lang] = np.unique(language_id._grams(words, language_id.ORDER), axis=0, return_counts=True)
    return language_id.LanguageModels(counts)


def test_kneser_ney_equals_dictionaries():
    texts = {"xx": ["the then these he she", "then he saw the sheep"], "yy": ["le les elle été", "la belle été"]}
    models = fitted(texts)
    for lang, some in texts.items():
        probability, _ = plain_kneser_ney(some)
        words = [w for t in texts.values() for x in t for w in language_id.words_of(x)] + ["zebra", "q", "shele"]
        got = models.word_scores(words)[:, models.langs.index(lang)]
        # the floor of a model is that of the largest alphabet of all
        size = 1 + max(len({g[-1] for g in plain_kneser_ney(t)[1][language_id.ORDER]}) for t in texts.values())
        own = 1 + len({g[-1] for g in plain_kneser_ney(some)[1][language_id.ORDER]})
        for word, score in zip(words, got, strict=True):
            padded = "\0" * (language_id.ORDER - 1) + " " + word + " "
            want = 0.0
            for k in range(language_id.ORDER, len(padded)):
                want += math.log(probability(padded[k - language_id.ORDER + 1 : k], padded[k]))
            if size == own:
                assert score == pytest.approx(want, rel=1e-4)


def test_letters_are_letters(spark):
    assert language_id.words_of("½ ² Ⅷ ٣ 12_a é_中 x²") == ["a", "é", "中", "x"]
    rows = [(i, "the sheep see the sea" if i % 2 else "la belle été et le sel", "ab"[i % 2]) for i in range(40)] + [(100, "½ ² Ⅷ 12", None), (101, "x" * 300_000, None), (None, "the sea", None), (None, None, None)]
    got = {r.doc_id: r for r in language_id.language_id(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect() if r.doc_id is not None}
    assert got[100].lang_pred == "und" and got[100].score == 0 and got[101].lang_pred in "ab" and len(got) == 42


# ordinal regression


def plain_ordinal(weights, thresholds, feature_rows, grades):
    """Log-likelihood of the cumulative-link model and the probabilities, row by row."""
    total, table = 0.0, []
    for f, y in zip(feature_rows, grades, strict=True):
        score = sum(weights[k] for k in f) / math.sqrt(max(len(f), 1))
        below = [1 / (1 + math.exp(-(t - score))) for t in thresholds]
        edges = [0.0, *below, 1.0]
        p = [b - a for a, b in itertools.pairwise(edges)]
        table.append(p)
        total += math.log(p[y])
    return total, table


def test_ordinal_probabilities_and_steps_follow_the_likelihood():
    rng = np.random.default_rng(3)
    rows = [np.unique(rng.integers(0, 12, n)).astype(np.int32) for n in (0, 1, 3, 5, 8, 8, 2)]
    y = np.array([0, 1, 2, 0, 1, 2, 1])
    weights, thresholds = rng.standard_normal(1 << quality.BITS) * 0.3, np.array([-0.4, 0.7])
    model = quality.Ordinal(weights.copy(), thresholds.copy(), [0, 1, 2])
    _, want = plain_ordinal(weights, thresholds, rows, y)
    assert np.allclose(model.probabilities(model.scores(rows)), want)
    # the first step of every weight goes against the slope of the loss, which a finite difference tells
    loss = lambda w, t: -plain_ordinal(w, t, rows, y)[0] / len(y)
    epochs, decay = quality.EPOCHS, quality.DECAY
    quality.EPOCHS, quality.DECAY = 1, 0.0
    try:
        squares = np.full(1 << quality.BITS, 1e30)  # so large that a step is the slope times a known number
        after = quality.Ordinal(weights.copy(), thresholds.copy(), [0, 1, 2])
        assert quality._descend(after, squares, rows, y, 1) == len(rows)
    finally:
        quality.EPOCHS, quality.DECAY = epochs, decay
    for k in range(12):
        up, down = weights.copy(), weights.copy()
        up[k] += 1e-5
        down[k] -= 1e-5
        slope = (loss(up, thresholds) - loss(down, thresholds)) / 2e-5
        assert (weights[k] - after.weights[k]) / quality.RATE * 1e15 == pytest.approx(slope, rel=1e-3, abs=1e-3) or abs(slope) < 1e-6 or abs(weights[k] - after.weights[k]) < 1e-16
    for k in range(2):
        up, down = thresholds.copy(), thresholds.copy()
        up[k] += 1e-5
        down[k] -= 1e-5
        slope = (loss(weights, up) - loss(weights, down)) / 2e-5
        assert np.sign(thresholds[k] - after.thresholds[k]) == np.sign(slope)


def test_quality_gives_held_out_grades(spark):
    rng = random.Random(6)
    vocab = {0: ["bad", "vile", "rude"], 1: ["meh", "spam", "junk"], 2: ["fine", "good", "kind"]}
    texts = [(i, " ".join(rng.choices([f"n{k}" for k in range(300)], k=40) + rng.choices(vocab[i % 3], k=6))) for i in range(3000)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 2), int(i % 3 == 0)) for i in range(2400)], "doc_id long, quality int, toxic int")
    held = [r for r in quality.quality(docs, labels).collect() if r.doc_id >= 2400]
    assert np.mean([r.grade == r.doc_id % 3 for r in held]) > 0.9
    assert np.mean([abs(r.expected_grade - r.doc_id % 3) for r in held]) < 0.35


# recall


@pytest.mark.parametrize("dim", [8, 64, 384, 768])
def test_embedding_recall_at_the_threshold(spark, dim):
    rng = np.random.default_rng([11, dim])
    n, cos = 400, 0.932
    a = rng.standard_normal((n, dim))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b = rng.standard_normal((n, dim))
    b -= (a * b).sum(axis=1)[:, None] * a
    b = cos * a + math.sqrt(1 - cos * cos) * b / np.linalg.norm(b, axis=1)[:, None]
    rows = [(2 * i + k, x[i].tolist(), 1) for i in range(n) for k, x in enumerate((a, b))]
    got = embedding_dedup.embedding_dedup(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    part = {r.vec_id: r.component_id for r in got}
    assert np.mean([part[2 * i] == part[2 * i + 1] for i in range(n)]) >= 0.9
    every = np.concatenate([a, b])
    close = (every @ every.T >= 0.93).sum() - 2 * n
    assert 0.9 * close <= sum(r.n_links for r in got) <= close


def test_embedding_ids_on_several_vectors(spark):
    rows = [(1, [1.0, 0.0], 1), (1, [0.0, 1.0], 1), (1, [0.0, 1.0], 1), (2, [0.0, 1.0001], 1), (None, [0.0, 1.0], 1), (3, [1.0, 0.0], 2)]
    got = sorted((r.vec_id is None, r.vec_id or 0, r.n_links, r.component_id or 0) for r in embedding_dedup.embedding_dedup(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect())
    assert got == [(False, 1, 0, 1), (False, 1, 2, 1), (False, 1, 2, 1), (False, 2, 2, 1), (False, 3, 0, 3), (True, 0, 0, 0)]


def test_substring_recall_of_edited_passages(spark):
    rng = random.Random(13)
    fresh = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    cases = [(100, (20, 60)), (200, (40, 80, 120, 160)), (110, (35, 75)), (60, (30,)), (280, (40, 80, 120, 160, 200, 240)), (50, (25,)), (300, (50, 100, 150, 200, 250))]
    texts, want = {}, set()
    for k in range(105):
        n, edits = cases[k % len(cases)]
        one = fresh(n)
        two = [w if i not in edits else f"e{rng.randrange(10**9)}" for i, w in enumerate(one)]
        x, y = ({tuple(w[i : i + 5]) for i in range(n - 4)} for w in (one, two))
        if len(x & y) / len(x | y) >= 0.8:
            want.add((10 * k + 1, 10 * k))
        texts[10 * k], texts[10 * k + 1] = fresh(rng.randrange(40)) + one + fresh(30), fresh(rng.randrange(40)) + two + fresh(50)
    got = substring_dedup.substring_dedup(spark.createDataFrame([(i, " ".join(w)) for i, w in texts.items()], "doc_id long, text string")).collect()
    assert len(want & {(r.doc_id, r.rep_id) for r in got}) >= 0.9 * len(want) and len(want) >= 80


def test_substring_of_one_word_said_over_and_over(spark):
    rng = random.Random(14)
    fresh = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    end = fresh(40)
    texts = {1: fresh(30) + ["no"] * 60, 2: ["no"] * 55 + fresh(30), 3: fresh(20) + ["so"] * 30 + fresh(20), 4: fresh(30) + ["so"] * 30 + fresh(20), 5: fresh(20) + ["if"] * 30 + end + fresh(9), 6: fresh(50) + ["if"] * 30 + end}
    got = substring_dedup.substring_dedup(spark.createDataFrame([(i, " ".join(w)) for i, w in texts.items()], "doc_id long, text string")).collect()
    assert {(r.doc_id, r.rep_id) for r in got} == {(2, 1), (6, 5)}


# edge tables


def test_pem_of_any_length_and_with_headers():
    body = "\n".join("A1b/+" * 12 for _ in range(2000))
    long = f"x -----BEGIN RSA PRIVATE KEY-----\n{body}\n-----END RSA PRIVATE KEY----- y"
    headed = f"-----BEGIN EC PRIVATE KEY-----\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0A1B\n\n{body[:300]}==\n-----END EC PRIVATE KEY-----"
    spans = lambda t: [(s["start"], s["end"]) for s in secrets.find_secrets(t) if s["kind"] == "pem"]
    assert spans(long) == [(2, len(long) - 2)] and spans(headed) == [(0, len(headed))]
    assert spans("-----BEGIN PRIVATE KEY-----\n" * 20_000 + "a: -----END") == []


def test_filters_keep_columns_of_clashing_names(spark):
    rows = [(1, "the sheep see token=abcdef99", 7, 7, 7, 7, 7, 7), (1, "the sheep see token=abcdef99", 7, 7, 7, 7, 7, 7), (None, "the sheep see token=abcdef99", 8, 8, 8, 8, 8, 8), (2, None, 9, 9, 9, 9, 9, 9), (None, None, 9, 9, 9, 9, 9, 9), (3, "the sea is here and the sheep", 5, 5, 5, 5, 5, 5)]
    names = ["row_key", "blob", "spans", "made", "kept", "key"]
    docs = stored(spark.createDataFrame([(a, b, "en", *c) for a, b, *c in rows], "doc_id long, text string, lang string, " + ", ".join(f"{n} long" for n in names)))
    marks = lambda df: sorted((r.doc_id or 0, r.text or "", *[r[n] for n in names]) for r in df.collect())
    first = exact_dedup.keep_first(docs)
    assert first.columns == docs.columns and marks(first) == sorted([(1, rows[0][1], *[7] * 6), (2, "", *[9] * 6), (3, rows[5][1], *[5] * 6)])
    one = simhash.keep_one(docs)
    assert one.columns == docs.columns and marks(one) == marks(first)
    only_null = stored(docs.filter("doc_id IS NULL"))
    assert simhash.keep_one(only_null).count() == 2 and exact_dedup.keep_first(only_null).count() == 2
    clean = secrets.redact(docs)
    assert clean.columns == docs.columns and marks(clean) == sorted((a or 0, (b or "").replace("token=abcdef99", "[SECRET]"), *c) for a, b, *c in rows)
    known = language_id.keep_identified(docs)
    assert known.columns == docs.columns and all(r.text for r in known.collect())
    for keep in (exact_dedup.keep_first, simhash.keep_one, secrets.redact, language_id.keep_identified):
        assert keep(docs.limit(0)).count() == 0


def test_empty_tables_and_clashing_columns(spark):
    none = spark.createDataFrame([], DOCS)
    assert bpe.bpe_digests(none).count() == simhash.simhash_dedup(none).count() == secrets.secret_scan(none)[0].count() == substring_dedup.substring_dedup(none).count() == 0
    assert embedding_dedup.embedding_dedup(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0
    folder = shared_folder(spark)
    warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), folder)
    assert warc.captures(spark, folder).count() == 0
    text = "the quick brown fox " * 30
    some = spark.createDataFrame([(1, text, "en", "s", 3), (2, text, "en", "s", 3)], DOCS)
    more = some.withColumns({n: F.lit(1) for n in ("hash", "pack", "ids", "n_tokens", "fp", "key", "blob", "spans", "lang_pred", "score", "held_out", "rep_id", "length", "rank", "part", "row_id")})
    for run in (substring_dedup.substring_dedup, bpe.bpe_digests, simhash.simhash_dedup, lambda d: secrets.secret_scan(d)[0].select("doc_id", F.size("spans")), packing.pack_documents, language_id.language_id, exact_dedup.exact_dedup):
        assert sorted(map(str, run(more).drop("sequence_id").collect())) == sorted(map(str, run(some).drop("sequence_id").collect()))
    pages = spark.createDataFrame([(1, "http://a/", "x" * 200, 5, 5), (2, None, "x" * 200, 5, 5)], "page_id long, url string, html string, digest long, first_id long")
    folder = shared_folder(spark)
    warc.write_archives(pages, folder)
    assert sorted((r.page_id, r.record_type) for r in warc.captures(spark, folder).collect()) == [(1, "response"), (2, "revisit")]


def test_archives_are_cut_by_bytes(spark):
    small = spark.createDataFrame([(i, "h" * 1000) for i in range(10)], "page_id long, html string")
    big = spark.createDataFrame([(1, "h" * 5_000_000)], "page_id long, html string")
    assert warc.file_records(small) > 30_000 and warc.file_records(big) < 60 and warc.file_records(small.limit(0)) > 0


def test_very_long_texts(spark):
    rng = random.Random(5)
    long = " ".join(rng.choices(["alpha", "beta", "gamma", "delta", "eps"], k=250_000))
    docs = spark.createDataFrame([(1, long), (2, "x " + long), (3, "short")], "doc_id long, text string")
    held = {r.doc_id for r in substring_dedup.substring_dedup(docs).collect()}
    assert held == {2}
    labels = spark.createDataFrame([(1, 1, 0), (3, 0, 0)], "doc_id long, quality int, toxic int")
    assert quality.quality(docs, labels).count() == 3


def test_broadcasts_are_bounded_by_bytes(spark):
    left = stored(spark.range(100).select("id", F.col("id").alias("k")))
    wide = stored(spark.range(50).select(F.col("id").alias("k"), F.array_repeat(F.lit("x" * 100), 100).alias("v")))
    plan = lambda size: common.sized_join(left, wide, ["k"], "left", size=size)._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan(1 << 30) and "strategy=broadcast" not in plan(10_000)


def test_long_lists_and_hubs_join_over_shuffles_of_their_own(spark):
    postings = stored(spark.range(200).select((F.col("id") % 3).alias("k"), "id"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = components.block_pairs(postings, ["k"], "id", 16)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 2 and "HashAggregate" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
