"""Substring dedup and the quality classifier, and the pipeline stage by stage."""

import random
import re

import numpy as np
import pytest

from broadloom.llm import quality, secrets, simhash, substring_dedup
from broadloom.llm.common import stored
from tests.llm.test_llm_operators import DOCS, norm, table


def words_of(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())


def test_compact_windows_equal_brute_force():
    rng = np.random.default_rng(0)
    h, of = rng.integers(0, 1 << 60, 400).astype(np.uint64), np.repeat([0, 1, 2, 3], [150, 10, 0, 240])
    how = substring_dedup.Hashing(1, 20, 9)
    _, left, c, right = substring_dedup.compact_windows(h, of, how)
    key = substring_dedup._mix(h ^ np.uint64(how.seed * 0x632BE59BD9B4E019 % (1 << 64)))
    want = set()
    for i in range(len(h)):
        a = b = i
        while a > 0 and of[a - 1] == of[i] and key[a - 1] > key[i]:
            a -= 1
        while b + 1 < len(h) and of[b + 1] == of[i] and key[b + 1] > key[i]:
            b += 1
        if b - a + 1 >= how.span:
            want.add((a, i, b))
    assert set(zip(left.tolist(), c.tolist(), right.tolist(), strict=True)) == want and len(want) > 10


@pytest.mark.parametrize(("words", "edits"), [(50, 1), (80, 1), (88, 1), (100, 2), (150, 3), (200, 4), (300, 6)])
@pytest.mark.parametrize("kind", ["change", "insert", "delete"])
def test_verify_holds_edited_passages_against_brute_force(words, edits, kind):
    rng = np.random.default_rng([words, edits])
    fresh = lambda n: rng.integers(0, 1 << 60, n).astype(np.uint64).tolist()
    one = fresh(words)
    two, step = list(one), words // (edits + 1)
    for k in range(edits, 0, -1):
        two[k * step : k * step + (kind != "insert")] = fresh(int(kind != "delete"))
    shingled = lambda w: substring_dedup._shingled(np.array(w, np.uint64))[: len(w) - 4]
    a, b = shingled(fresh(60) + one + fresh(40)), shingled(fresh(7) + two + fresh(80))
    x, y = set(shingled(one).tolist()), set(shingled(two).tolist())
    whole = len(x & y) / len(x | y)
    got = substring_dedup.verify(a, b)
    if whole >= 0.8 and min(len(x), len(y)) >= 46:
        start, end, s, e, similarity = got
        assert similarity >= 0.8 and min(end - start, e - s) >= 46
        assert end - start + e - s >= len(x) + len(y)  # no shorter than the planted passage
    if got is not None:
        start, end, s, e, similarity = got
        x, y = set(a[start:end].tolist()), set(b[s:e].tolist())
        assert len(x & y) / len(x | y) == pytest.approx(similarity)


def test_substring_dedup(spark):
    rng = random.Random(4)
    fresh = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    hot, edited, half = fresh(55), fresh(120), fresh(40)
    changed = list(edited)
    changed[60] = "other"
    texts = {i: fresh(80) + hot + fresh(70) for i in range(10, 40)}
    texts |= {100: fresh(30) + edited + fresh(9), 101: changed + fresh(90), 102: fresh(300), 103: half + fresh(60), 104: fresh(60) + half, 105: hot[:30], 106: fresh(49), 107: []}
    shared = fresh(60)
    # 35 words of the passage stand in an earlier document too
    texts |= {200: shared[:44] + fresh(60), 201: fresh(50) + shared, 202: shared + fresh(50)}
    rows = [(i, " ".join(w)) for i, w in texts.items()] + [(300, None), (None, " ".join(hot)), (102, " ".join(texts[102]))]
    got = substring_dedup.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    pairs = {(r.doc_id, r.rep_id) for r in got}
    assert {d for d, _ in pairs} == {*range(11, 40), 101, 202} | ({201} if any(d == 201 for d, _ in pairs) else set())
    assert all((i, 10) in pairs for i in range(11, 40)) and (101, 100) in pairs and (202, 201) in pairs
    for r in got:
        a, b = texts[r.doc_id][r.start_word : r.end_word], texts[r.rep_id][r.rep_start : r.rep_end]
        x, y = ({tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (a, b))
        assert len(x & y) / len(x | y) == pytest.approx(r.similarity) and r.similarity >= 0.8
    assert substring_dedup.substring_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def ties(spark, texts):
    """(doc_id, rep_id) and the rows of the passages of some word lists."""
    rows = spark.createDataFrame([(i, " ".join(w)) for i, w in texts.items()], "doc_id long, text string")
    got = substring_dedup.substring_dedup(rows).collect()
    for r in got:
        a, b = texts[r.doc_id][r.start_word : r.end_word], texts[r.rep_id][r.rep_start : r.rep_end]
        x, y = ({tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (a, b))
        assert len(x & y) / len(x | y) == pytest.approx(r.similarity) and r.similarity >= 0.8 and min(len(a), len(b)) >= 50
    return {(r.doc_id, r.rep_id) for r in got}, got


def test_substring_dedup_compares_copies_behind_a_common_line(spark):
    rng = random.Random(6)
    fresh = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    phrases = [fresh(30) for _ in range(20)]
    texts = {k: fresh(60) + phrases[k] + fresh(60) for k in range(20)}  # the lines stand in earlier, unrelated texts
    for k in range(20):
        one = fresh(15) + phrases[k] + fresh(11)
        two = list(one)
        two[12] = "other"  # no 45 words on end are equal
        texts |= {100 + k: fresh(50) + one + fresh(50), 200 + k: fresh(70) + two + fresh(30)}
    assert ties(spark, texts)[0] == {(200 + k, 100 + k) for k in range(20)}


def covered(got, doc_id, texts):
    held = np.zeros(len(texts[doc_id]), bool)
    for r in got:
        if r.doc_id == doc_id:
            held[r.start_word : r.end_word] = True
    return held


def test_substring_dedup_reports_repeated_stretches_whole(spark):
    rng = random.Random(7)
    fresh = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    texts = {}
    for k, n in enumerate((45, 60, 90)):
        line = fresh(n)
        texts |= {10 * k: fresh(30) + line * 100 + fresh(30), 10 * k + 1: fresh(80) + line * 100 + fresh(10)}
    pairs, got = ties(spark, texts)
    assert pairs == {(1, 0), (11, 10), (21, 20)}
    for k, n in enumerate((45, 60, 90)):
        held = covered(got, 10 * k + 1, texts)
        assert held.sum() >= n * 100 and held[80 : 80 + n * 100].all()


def test_substring_dedup_finds_passages_behind_a_repeated_line(spark):
    rng = random.Random(8)
    fresh = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    texts, want = {}, set()
    for k in range(30):
        line, end = fresh(35 + k % 15), fresh(16)
        twice, once = fresh(40) + line + fresh((20, 40, 300)[k % 3]) + line + end + fresh(40), fresh(60) + line + end + fresh(60)
        texts |= dict(zip((100 * k, 100 * k + 1), (twice, once) if k % 2 else (once, twice), strict=True))
        want.add((100 * k + 1, 100 * k))
    assert ties(spark, texts)[0] == want


def test_substring_dedup_finds_further_passages_of_a_pair(spark):
    rng = random.Random(9)
    fresh = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    texts = {}
    for k, gap in enumerate((12, 30, 400)):
        footer, edited, third = fresh(60), fresh(100), fresh(90)
        other, last = list(edited), list(third)
        other[50], last[45] = "other", "another"
        texts |= {10 * k: fresh(20) + edited + fresh(gap) + third + fresh(gap) + footer, 10 * k + 1: fresh(40) + other + fresh(gap) + last + fresh(gap) + footer}
    got = ties(spark, texts)[1]
    for k, gap in enumerate((12, 30, 400)):
        held = covered(got, 10 * k + 1, texts)
        for start, n in ((40, 100), (140 + gap, 90), (230 + 2 * gap, 60)):
            assert held[start : start + n].sum() > 0.6 * n


def test_substring_dedup_finds_every_exact_passage(spark, sf_dir):
    path = f"{sf_dir.replace('sf0.001', 'sf0.01')}/documents.parquet"
    texts = {r["doc_id"]: words_of(r["text"]) for r in table(path)}
    seen, need = {}, set()
    for i in sorted(texts):
        w = texts[i]
        for k in range(len(w) - 49):
            first = seen.setdefault(hash(tuple(w[k : k + 50])), i)
            if first != i:
                need.add(i)
    got = {r.doc_id for r in substring_dedup.substring_dedup(spark.read.parquet(path)).collect()}
    assert need <= got and len(got - need) <= 0.02 * len(texts)


def test_quality(spark):
    rng = random.Random(5)
    vocab = {0: ["bad", "vile"], 1: ["meh", "spam"], 2: ["fine", "good"]}
    texts = [(i, " ".join(rng.choices([f"n{k}" for k in range(300)], k=60) + rng.choices(vocab[i % 3], k=3))) for i in range(900)]
    docs = spark.createDataFrame([*texts, (1000, None), (1001, ""), (5, texts[5][1])], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 2), int(i % 3 == 0)) for i in range(600)] + [(None, 1, 0), (601, None, 0), (602, 1, None)], "doc_id long, quality int, toxic int")
    got = quality.quality(docs.withColumn("grade", docs.doc_id), labels).collect()
    assert len(got) == 903 and all(0 <= r.p_top <= 1 and 0 <= r.expected_grade <= 2 for r in got)
    held = [r for r in got if 600 <= r.doc_id < 900]
    by = [[r.expected_grade for r in held if r.doc_id % 3 == g] for g in range(3)]
    above = lambda x, y: np.mean([a > b for a in x for b in y])
    assert above(by[1], by[0]) > 0.85 and above(by[2], by[1]) > 0.85 and above(by[2], by[0]) > 0.97
    assert np.mean([r.kept for r in held if r.doc_id % 3 == 2]) > 0.9 and np.mean([r.kept for r in held if r.doc_id % 3 == 0]) < 0.25
    assert quality.quality(docs.limit(0), labels.limit(0)).count() == 0 and quality.quality(docs, labels.limit(0)).count() == 903


def test_pipeline_stages(spark, sf_dir):
    import corpus_pipeline

    rows = [tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")) for r in table(f"{sf_dir}/documents.parquet")]
    rows += [(9000, None, "en", "s", 0), (9001, "12 34", "en", "s", 5), (9002, rows[1][1] + " ", "en", "s", 1), (9003, rows[2][1], None, None, None)]
    docs = stored(spark.createDataFrame(rows, DOCS))
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, sf_dir))
        kept[name] = docs.collect()
        if name != "packing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    ids = lambda name: [r.doc_id for r in kept[name]]
    assert 9000 not in ids("language_id") and 9001 not in ids("language_id")
    first = {}
    for r in sorted(kept["language_id"], key=lambda r: r.doc_id):
        first.setdefault(norm(r.text), r.doc_id)
    assert sorted(ids("exact_dedup")) == sorted(first.values())
    fps = {r.doc_id: simhash.fingerprint(r.text) for r in kept["exact_dedup"]}
    left = sorted(fps)
    part = {i: i for i in left}
    for _ in range(10):
        for a in left:
            for b in left:
                if a < b and (fps[a] ^ fps[b]).bit_count() <= 4:
                    part[a] = part[b] = min(part[a], part[b])
    assert sorted(ids("simhash_dedup")) == [i for i in left if part[i] == i]
    before = {r.doc_id: r.text for r in kept["simhash_dedup"]}
    for r in kept["secret_redaction"]:
        out, at = "", 0
        for s in secrets.find_secrets(before[r.doc_id]):
            if s["start"] >= at:
                out += before[r.doc_id][at : s["start"]] + "[SECRET]"
            at = max(at, s["end"])
        assert r.text == out + before[r.doc_id][at:]
    assert {r.doc_id for r in kept["packing"]} == set(before)
    assert corpus_pipeline.run(spark, sf_dir).count() > 0
