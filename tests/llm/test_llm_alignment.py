"""Token alignment against plain sets of ends and overlaps, on the tables and on random texts."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from broadloom.llm import alignment as A

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def plain_groups(ends_a, ends_b):
    both = sorted(set(ends_a) & set(ends_b))
    return [(np.searchsorted(ends_a, e, "right"), np.searchsorted(ends_b, e, "right")) for e in both]


@pytest.mark.parametrize("seed", range(6))
def test_walk_equals_set_of_common_ends(seed):
    rng = random.Random(seed)
    for _ in range(200):
        size = rng.choice([1, 2, 5, 40, 400])
        share = rng.choice([0.02, 0.3, 0.9, 1.0])
        a = sorted({size} | {x for x in range(1, size) if rng.random() < share})
        b = sorted({size} | {x for x in a if rng.random() < 0.9} | {x for x in range(1, size) if rng.random() < 0.1 * share})
        got = A.align_ends(a, b)
        assert list(zip(got.group_a, got.group_b)) == plain_groups(a, b)
        starts_a, starts_b = [0, *a[:-1]], [0, *b[:-1]]
        overlaps = [(i, j) for i in range(len(a)) for j in range(len(b)) if starts_a[i] < b[j] and starts_b[j] < a[i]]
        assert list(zip(got.link_a, got.link_b)) == overlaps


def whole_texts(texts):
    """Ids of whole texts, without a cut, as the contract has them."""
    a, b = A.open_tokens(PATHS[0]), A.open_tokens(PATHS[1])
    ids_a = [e.ids for e in a.model.encode_batch([" " + t for t in texts], add_special_tokens=False)]
    ids_b = b.model.encode(texts, num_threads=1)
    out = []
    for t, x, y in zip(texts, ids_a, ids_b):
        data = (" " + t).encode()
        out.append((x, y) if t and b"".join(a.tokens[i] for i in x) == data == b"".join(b.tokens[i] for i in y) else None)
    return out, a, b


def brute(rows):
    tokens, a, b = whole_texts([t or "" for _, t in rows])
    links, docs = Counter(), []
    for (doc_id, _), got in zip(rows, tokens):
        if got is None:
            docs.append((doc_id, 0, 0, 0, [], ""))
            continue
        x, y = got
        ends_a, ends_b = np.cumsum([len(a.tokens[i]) for i in x]), np.cumsum([len(b.tokens[i]) for i in y])
        u = np.union1d(ends_a, ends_b)
        pairs = [(x[i], y[j]) for i, j in zip(np.searchsorted(ends_a, u), np.searchsorted(ends_b, u))]
        groups, i, j = [], 0, 0
        for p, q in plain_groups(ends_a, ends_b):
            groups.append(",".join(map(str, x[i:p])) + "|" + ",".join(map(str, y[j:q])))
            i, j = p, q
        links.update(pairs)
        docs.append((doc_id, len(x), len(y), len(groups), pairs, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    most = defaultdict(int)
    for (_, j), c in links.items():
        most[j] = max(most[j], c)
    return [(d, na, nb, g, len(p), sum(links[x] == most[x[1]] for x in p), sum(links[x] for x in p), sha) for d, na, nb, g, p, sha in docs]


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_query_against_brute_force(spark, sf_dir):
    from broadloom.llm.registry import QUERIES

    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert result(QUERIES["op11_alignment"](spark, sf_dir)) == sorted(brute(rows), key=repr)


def test_cut_words_equal_whole_texts(monkeypatch):
    rng = random.Random(3)
    alphabet = [" ", " ", " ", "\n", "\t", "\x1c", "\xa0", "　", "▁", "a", "the", "é", "é", "'s", "1", "23", "...", "<s>", "<unk>", "<0x41>", "<|endoftext|>", "\0", "語", "😀", "ﬁ", "don't", "\r\n", "​", "I'", "ll"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(12))) for _ in range(20_000)]
    monkeypatch.setattr(A, "SLICE", 700)
    aligner, want = A.Aligner(*PATHS), whole_texts(texts)[0]
    split = [A.words_of(t) for t in texts]
    assert all("".join(" " + w for w in words) == (" " + t if t else "") for words, t in zip(split, texts))
    listed = sorted({w for words in split for w in words})
    aligned = aligner.align_words(listed)
    place = dict(zip(listed, aligned.place.tolist()))
    for t, words, ids in zip(texts, split, want):
        at = [place[w] for w in words]
        assert (not at or min(at) < 0) == (ids is None), t
        if ids is not None:
            assert ";".join(aligned.groups[k] for k in at) == ";".join(aligner._groups(*ids, aligner.align(*ids))), t
            assert [aligned.n_a[at].sum(), aligned.n_b[at].sum()] == [len(ids[0]), len(ids[1])], t
    assert sum(x is None for x in want) > 100 and sum(x is not None for x in want) > 5000


def test_blocks_change_nothing(spark, monkeypatch):
    rng = random.Random(5)
    words = ["alpha", "beta", "gammadelta", "thing", "naïve", "42nd", "x", "a▁"]
    rows = [(k, " ".join(rng.choice(words) + str(rng.randrange(3)) for _ in range(rng.randrange(12)))) for k in range(60)]
    aligner, tables = A.Aligner(*PATHS), [[], []]
    for chars, out in zip((1, 10**9), tables):
        block = A._Block(0)
        for k, text in rows:
            block.add(k, text)
            if block.chars >= chars:
                out += [r for b in block.close(aligner) for r in b.to_pylist()]
                block = A._Block(block.number + 1)
        out += [r for b in block.close(aligner) for r in b.to_pylist()]
    pairs = [Counter() for _ in tables]
    for out, total in zip(tables, pairs):
        for r in out:
            if r["kind"] == A._PAIRS:
                total.update(dict(zip(r["codes"], r["times"])))
    assert pairs[0] == pairs[1] and sum(pairs[0].values()) == sum(r["n_links"] for r in tables[0] if r["kind"] == A._DOC) > 0
    facts = [[tuple(r[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")) for r in out if r["kind"] == A._DOC] for out in tables]
    assert facts[0] == facts[1]


def test_edges(spark):
    long = "word " * 50_000 + "pneumonoultramicroscopicsilicovolcanoconiosis" * 500
    rows = [(1, None), (2, ""), (None, "null id"), (3, "the same"), (3, "the same"), (4, "a▁b"), (5, long), (6, " "), (7, "ends "), (8, "the other")]
    df = spark.createDataFrame([(d, t, None, None, None) for d, t in rows], DOCS).selectExpr("*", "1 AS block", "2 AS codes", "3 AS is_doc", "4 AS n_a")
    assert result(A.alignment_digests(df)) == sorted(brute(rows), key=repr)
    assert A.alignment_digests(spark.createDataFrame([], DOCS)).collect() == []
    spans = {r.doc_id: r for r in A.token_alignment(df).collect() if r.doc_id}
    assert spans[1].ids_a == [] == spans[4].groups and spans[8].groups[-1] == (len(spans[8].ids_a), len(spans[8].ids_b))
