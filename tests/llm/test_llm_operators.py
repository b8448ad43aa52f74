"""Each operator against a brute-force version, on edge cases and on the small tables."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest
import xxhash

from broadloom.llm import bpe, components, embedding_dedup, exact_dedup, language_id, packing, secrets, simhash, warc
from broadloom.llm.common import shared_folder, stored

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def table(path):
    import pyarrow.dataset as ds

    return ds.dataset(path).to_table().to_pylist()


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    """The small documents table with edge rows: nulls, empty, white space, very long, repeated, ties."""
    rows = [tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")) for r in table(f"{sf_dir}/documents.parquet")]
    long = " ".join(random.Random(3).choices(["alpha", "beta", "gamma", "delta,", "token=abcdef99"], k=60_000))
    rows += [(9000, None, None, None, None), (9001, "", "en", None, 0), (9002, " \t\n ", "en", "s", 4), (9003, long, "en", "s", len(long)), (9004, long + " x", None, "s", 1)]
    rows += [(9005, "One two\tthree", "en", "s", 13), (9006, "One  two three", "en", "s", 14), (9006, "One  two three", "en", "s", 14), (9007, "ΣΑΣ İ é!", "xx", "s", 9)]
    return spark.createDataFrame(rows, DOCS), rows


def components_of(nodes, links):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_connected_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1100)] + [(2000, i) for i in range(2001, 2300)]
    got = components.connected_components(spark.createDataFrame([*edges, (7, 7)], "src long, dst long")).collect()
    edges = [(a, b) for a, b in edges if a != b]
    want = components_of({n for e in edges for n in e}, edges)
    assert {r["node"]: r["component"] for r in got} == want and len(got) == len(want)
    assert components.connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


# exact dedup


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_exact_dedup(docs):
    df, rows = docs
    got = exact_dedup.exact_dedup(df.withColumn("kept", df.doc_id)).toPandas()
    groups = defaultdict(list)
    for r in rows:
        groups[norm(r[1])].append(r[0])
    want = sorted((r[0], min(groups[norm(r[1])]), len(groups[norm(r[1])]), hashlib.sha256(norm(r[1]).encode()).hexdigest()) for r in rows)
    assert sorted(got[["doc_id", "keep_id", "group_size", "text_sha256"]].itertuples(index=False, name=None)) == want
    assert got.kept.sum() == len(groups) and (got[got.kept].doc_id == got[got.kept].keep_id).all()


def test_exact_dedup_keeps_rows(spark, docs):
    df, rows = docs
    kept = exact_dedup.keep_first(df).collect()
    assert len(kept) == len({norm(r[1]) for r in rows}) and kept[0].__fields__ == df.columns
    nulls = spark.createDataFrame([(None, "a", 1), (None, "a", 2), (3, "b", 3)], "doc_id long, text string, group_size int")
    assert sorted((r.doc_id is None, r.group_size, r.kept) for r in exact_dedup.exact_dedup(nulls).collect()) == [(False, 1, True), (True, 2, False), (True, 2, True)]
    assert exact_dedup.exact_dedup(df.limit(0)).count() == 0


def test_chunks_follow_content():
    data = np.random.default_rng(1).integers(0, 256, 200_000, dtype=np.uint8).tobytes()
    cuts = lambda d: {d[a:b] for a, b in zip([0, *exact_dedup.chunk_bounds(d)], exact_dedup.chunk_bounds(d), strict=False)}
    assert len(cuts(data) & cuts(b"inserted" + data)) > 0.8 * len(cuts(data))
    assert exact_dedup.chunk_bounds(b"") == [] and exact_dedup.chunk_bounds(b"a" * 50_000)[-1] == 50_000


# SimHash


def plain_fingerprint(text, k=4):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash(docs):
    df, rows = docs
    got = simhash.simhash_dedup(df).collect()
    fps = {r[0]: plain_fingerprint(r[1]) for r in rows}
    ids = sorted(fps)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if (fps[a] ^ fps[b]).bit_count() <= 4]
    want = components_of(ids, links)
    assert len(got) == len(rows)
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {i: (f"{fps[i]:016x}", want[i]) for i in ids}


def test_simhash_links_in_cut_lists(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK_ROWS", 16)
    rng = random.Random(2)
    base = [rng.getrandbits(64) for _ in range(3)]
    fps = {b ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(5))) & (2**64 - 1) for b in base for _ in range(80)}
    links = [(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 4]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    df = stored(spark.createDataFrame([(signed(x),) for x in fps], "fp long"))
    got = {r.node: r.component for r in components.connected_components(simhash.fingerprint_links(df)).collect()}
    want = components_of([signed(x) for x in fps], [(signed(a), signed(b)) for a, b in links])
    assert {n: got.get(n, n) for n in want} == want


def test_covering_triples():
    from itertools import combinations

    triples = simhash.covering_triples()
    assert len(triples) == 20 and all(any(set(t) <= set(q) for t in triples) for q in combinations(range(8), 4))


# secrets

PLAIN = {
    "assign": (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 6),
    "access": (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
    "hex": (r"[0-9a-f]+", lambda m: len(m[0]) >= 24),
}


def test_secrets(spark, docs):
    df, rows = docs
    text = "é ApiKey: 'abc' token=secret=abcdefgh AKIA" + "A1" * 8 + " AKIAX " + "0f" * 12 + " passwd=\"deadbeefdeadbeefdeadbeef\" Bearer abcdefghijklmnopqrstuv"
    df = df.unionByName(spark.createDataFrame([(9100, text, "en", "s", 1), (9101, text, "en", "s", 1)], DOCS))
    found, ledger = secrets.secret_scan(df)
    got = {r.doc_id: [(s.start, s.kind, s.end) for s in r.spans] for r in found.collect()}
    for doc_id, body, *_ in [*rows, (9100, text), (9101, text)]:
        want = [(m.start(), i, k, m.end()) for i, (k, (p, keep)) in enumerate(PLAIN.items()) for m in re.finditer(p, body or "", re.ASCII) if keep(m)]
        assert [s for s in got[doc_id] if s[1] in secrets.BASE] == [(a, k, b) for a, _, k, b in sorted(want)]
    assert any(k == "bearer" for _, k, _ in got[9100])
    blobs = {hashlib.sha256((r[1] or "").encode()).hexdigest() for r in rows} | {hashlib.sha256(text.encode()).hexdigest()}
    assert ledger.count() == len(blobs)
    more = df.unionByName(spark.createDataFrame([(9200, text + "!", "en", "s", 1)], DOCS))
    assert secrets.scan_unseen(more, ledger).count() == 1
    again, _ = secrets.secret_scan(more, ledger)
    assert again.count() == len(rows) + 3 and next(r for r in again.collect() if r.doc_id == 9200).spans


def test_redaction(spark):
    df = spark.createDataFrame([(1, "a token=abcdef99 b", "x", 18), (2, None, "x", None), (3, "clean", "x", 5), (3, "clean", "x", 5)], "doc_id long, text string, blob string, n_chars long")
    got = {(r.doc_id, r.text, r.n_chars) for r in secrets.redact(df).collect()}
    assert got == {(1, "a [SECRET] b", 12), (2, None, None), (3, "clean", 5)} and secrets.redact(df).count() == 4


# packing


def test_packing(spark, docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    df, rows = docs
    odd = ["hello <|endoftext|> world", "<|ENDOFTEXT|>.", "a\x01b \x01", "x.,!y. z'''s. it's, we've... 3.5%, ½,", "ΑΣ. \x1c İ", "e\u0301, n\u0303."]
    rows = rows + [(9500 + i, t, "en", "s", len(t)) for i, t in enumerate(odd)]
    df = spark.createDataFrame(rows, DOCS)
    got = packing.pack_documents(df.withColumn("length", df.doc_id).withColumn("rank", df.doc_id)).toPandas()
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for r in rows:
        ids = [*tok.encode(r[1] or "", add_special_tokens=False).ids, 0]
        want += [(r[0], i, s, len(ids[s : s + 2048]), zlib.crc32(np.array(ids[s : s + 2048], "<u4").tobytes())) for i, s in enumerate(range(0, len(ids), 2048))]
    assert sorted(got[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False, name=None)) == sorted(want)
    for _, seq in got.groupby("sequence_id"):
        seq = seq.sort_values("offset")
        assert seq.offset.tolist() == [0, *seq.length.cumsum().tolist()[:-1]] and seq.length.sum() <= 2048
    assert got.sequence_id.nunique() <= -(-got.length.sum() // 2048) + 1
    assert packing.pack_documents(df.limit(0)).count() == 0


def test_word_tokens_equal_the_tokenizer():
    import public_tokenizers

    tokens, rng = packing.WordTokens(public_tokenizers.path("word_bpe_49k.json")), random.Random(1)
    texts = ["".join(rng.choices("aé中'sStTlL .,!?#&*\x01Σİ \n\t12½ß\u0301ñ\x1c-_’s", k=rng.randrange(60))) for _ in range(3000)]
    for some in (texts[:1500], texts[1500:], texts[:1500]):
        for text, got in zip(some, tokens(some), strict=True):
            assert np.frombuffer(got, "<u4").tolist() == tokens.tokenizer.encode(text, add_special_tokens=False).ids


def test_word_tokens_of_code_points_newer_than_python():
    import public_tokenizers

    tokens = packing.WordTokens(public_tokenizers.path("word_bpe_49k.json"))
    newer = [0x1C89, 0xA7CB, 0xA7CC, 0xA7CE, 0xA7D2, 0xA7D4, 0xA7DA, 0xA7DC, *range(0x10D50, 0x10D66), *range(0x16EA0, 0x16EB9)]
    texts = [f"a word {chr(i)} and x{chr(i)}y" for i in newer] + [f"Ünï {chr(i)} {chr(i)}b" for i in range(0x250, 0x3000, 7)]
    for text, got in zip(texts, tokens(texts), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == tokens.tokenizer.encode(text, add_special_tokens=False).ids, text


def packed_right(lengths, demand, got):
    held = np.zeros(len(lengths), np.int64)
    for counts, times in got.plans:
        assert times > 0 and sum(int(lengths[k]) * n for k, n in counts) <= packing.CAPACITY
        for k, n in counts:
            held[k] += n * times
    return (held == demand).all()


def lengths_of_documents(sf_dir):
    import public_tokenizers

    tokens = packing.WordTokens(public_tokenizers.path("word_bpe_49k.json"))
    sizes = np.array([len(x) // 4 + 1 for x in tokens([r["text"] or "" for r in table(f"{sf_dir.replace('sf0.001', 'sf0.01')}/documents.parquet")])])
    return np.unique(sizes[sizes % packing.CAPACITY > 0] % packing.CAPACITY, return_counts=True)


@pytest.mark.parametrize("times", [1, 100])
def test_packing_comes_from_the_program(sf_dir, times):
    lengths, demand = lengths_of_documents(sf_dir)
    got = packing.solve(lengths, demand * times)
    bound = -(-int((lengths * demand * times).sum()) // packing.CAPACITY)
    assert packed_right(lengths, demand * times, got)
    assert got.sequences <= bound * 1.0001 + 1 and got.by_program >= 0.98 * got.sequences


def test_packing_solver():
    rng = np.random.default_rng(4)
    lengths, demand = np.unique(rng.integers(1, 2048, 5000), return_counts=True)
    assert packed_right(lengths, demand, packing.solve(lengths, demand))
    best = packing.knapsack(np.array([2.0, 5.0]), np.array([3, 5]), 11)
    assert best.tolist() == [0, 0, 0, 2, 2, 5, 5, 5, 7, 7, 10, 10]
    assert packing.solve(np.empty(0, np.int64), np.empty(0, np.int64)).sequences == 0


@pytest.mark.parametrize("n", [100, 1000, 100_000])
def test_packing_solver_without_full_sequences(n):
    lengths, demand = np.array([500, 520, 1000]), np.array([n, n, n])
    got = packing.solve(lengths, demand)
    assert packed_right(lengths, demand, got) and got.by_program >= 0.98 * n
    assert n <= got.sequences <= n + 1  # weights 1/4, 1/4, 1/2 fill no sequence beyond 1, so n is the least


def configurations(lengths, capacity):
    """Every multiset that fits and to which no piece can be added."""
    found = []

    def grow(first, room, held):
        if room < lengths[0]:
            found.append(held)
        for k in range(first, len(lengths)):
            if lengths[k] <= room:
                grow(k, room - int(lengths[k]), held + (k,))
        if room >= lengths[0] and held and room < lengths[held[-1]]:
            found.append(held)

    grow(0, capacity, ())
    return found


def least_sequences(lengths, demand, capacity):
    """The fewest sequences, by trying all configurations around the longest piece left."""
    best = {}

    def least(left):
        if not any(left):
            return 0
        if left not in best:
            longest = max(k for k, n in enumerate(left) if n)
            options = set()

            def grow(k, room, now):
                options.add(now)
                for j in range(k, -1, -1):
                    if now[j] and lengths[j] <= room:
                        grow(j, room - int(lengths[j]), now[:j] + (now[j] - 1,) + now[j + 1 :])

            grow(longest, capacity - int(lengths[longest]), left[:longest] + (left[longest] - 1,) + left[longest + 1 :])
            best[left] = 1 + min(map(least, options))
        return best[left]

    return least(tuple(int(d) for d in demand))


def test_packing_solver_against_an_exact_program():
    rng = np.random.default_rng(8)
    for _ in range(40):
        lengths = np.sort(rng.choice(np.arange(8, 60), 4, replace=False))
        demand = rng.integers(1, 5, 4)
        got, least = packing.solve(lengths, demand, 100), least_sequences(lengths, demand, 100)
        assert got.bound <= least <= got.sequences <= least + 1


def test_packing_bound_holds_for_every_configuration():
    lengths, demand = np.array([13, 19, 27, 34, 41, 52]), np.array([5, 90, 11, 40, 60, 33])
    prices, bound = packing.weights(lengths, demand, 100)
    assert max(sum(prices[k] for k in held) for held in configurations(lengths, 100)) <= 1 + 1e-9
    assert abs(bound - (prices * demand).sum()) < 1e-9 and packing.solve(lengths, demand, 100).bound >= bound - 1e-6


@pytest.mark.parametrize("step, count, most", [(1, 100, 22_300), (5, 500, 22_400)])
def test_packing_where_weights_must_move_prices(step, count, most):
    lengths = np.arange(600, 1100, step)
    demand = np.full(len(lengths), count)
    got = packing.solve(lengths, demand)
    assert packed_right(lengths, demand, got)
    assert got.bound > 22_100 and got.bound <= got.sequences <= most and got.by_program >= 0.98 * got.sequences


# language ID


def test_language_id(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.01')}/documents.parquet")
    got = language_id.language_id(df).toPandas()
    truth = df.select("doc_id", "lang").toPandas()
    both = got.merge(truth, on="doc_id")
    assert len(got) == len(truth) and got.score.between(0, 1).all()
    assert (both.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in both.doc_id]).all()
    held = both[both.held_out & (both.lang_pred != "und")]
    assert (held.lang_pred == held.lang).mean() > 0.97
    assert both.rejected.mean() < 0.02


def test_language_id_rejects_foreign_and_random_texts(spark):
    rng = random.Random(12)

    def words(n):
        parts = ["".join(rng.choices("bdfgklmnprstvz", k=1) + rng.choices("aeiou", k=1) + rng.choices(["", "n", "r", "s"], k=1)) for _ in range(25)]
        return ["".join(rng.choices(parts, k=rng.randrange(1, 4))) for _ in range(n)]

    one, two, foreign = words(300), words(300), words(300)
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = [(i, " ".join(rng.choices((one, two)[i % 2], k=rng.randrange(8, 60))), "ab"[i % 2]) for i in range(1600)]
    odd = [(2000 + i, "".join(rng.choices("qxjwy", k=rng.randrange(2, 12))), "ab"[i % 2]) for i in range(24)]  # short and odd, of both languages
    bad = [(3000 + i, " ".join(rng.choices(foreign, k=40)), None) for i in range(100)]
    bad += [(4000 + i, " ".join("".join(rng.choices(letters, k=6)) for _ in range(30)), None) for i in range(100)]
    got = language_id.language_id(spark.createDataFrame(rows + odd + bad, "doc_id long, text string, lang string")).collect()
    rejected = {r.doc_id for r in got if r.rejected}
    assert sum(i < 2000 for i in rejected) <= 16
    assert sum(3000 <= i < 4000 for i in rejected) >= 95 and sum(i >= 4000 for i in rejected) == 100


def test_language_id_edges(docs):
    df, rows = docs
    got = {r.doc_id: r for r in language_id.language_id(df).collect()}
    for i in (9000, 9001, 9002):
        assert got[i].lang_pred == "und" and got[i].rejected and got[i].score == 0
    none = language_id.language_id(df.limit(0))
    assert none.count() == 0
    kept = language_id.keep_identified(df)
    assert kept.columns == df.columns and kept.count() == sum(1 for r in language_id.language_id(df).collect() if not r.rejected)


def test_kneser_ney_sums_to_one():
    words = {"en": ["the", "then", "these", "he", "she"], "fr": ["le", "les", "elle"]}
    counts = {}
    for lang, some in words.items():
        grams, n = np.unique(language_id._grams(some, language_id.ORDER), axis=0, return_counts=True)
        counts[lang] = (grams, n)
    models = language_id.LanguageModels(counts)
    codes = [ord(c) for c in {*"".join(sum(words.values(), []))} | {" "}]
    context = language_id._grams(["the"], language_id.ORDER)[1, 1:]
    mass = np.exp(models._lookup(np.array([[*context, c] for c in codes], np.uint64), language_id.ORDER)).sum(axis=0)
    assert (mass <= 1.0 + 1e-5).all() and mass[models.langs.index("en")] > 0.8


# byte-level BPE


def test_bpe(docs):
    import base64

    import public_tokenizers as P
    import tiktoken

    df, rows = docs
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    ref = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r.doc_id: r for r in bpe.bpe_digests(df).collect()}
    for r in rows:
        ids = ref.encode_ordinary(r[1] or "")
        want = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r[1] or "").encode()).hexdigest())
        assert (got[r[0]].n_tokens, got[r[0]].ids_sha256, got[r[0]].decoded_sha256) == want
    own = bpe.ByteBPE(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    rng = random.Random(8)
    for text in ["a" * 5000, "ab" * 3000, "".join(rng.choices("aeh tion\né中9<|>", k=4000)), "".join(rng.choices("thein", k=6000))]:
        assert own.encode(text).tolist() == ref.encode_ordinary(text)
        assert own.decode(own.encode(text)).decode() == text
    back = bpe.decode_documents(bpe.encode_documents(df)).collect()
    assert sorted((r.doc_id, bytes(r.decoded)) for r in back) == sorted((r[0], (r[1] or "").encode()) for r in rows)


# embeddings


def test_embedding_dedup(spark):
    rng = np.random.default_rng(6)
    base = rng.standard_normal((60, 16))
    vectors = [b + 0.08 * rng.standard_normal(16) for b in base for _ in range(4)] + [base[0]] * 3
    rows = [(i, [float(x) for x in v], int(i % 2)) for i, v in enumerate(vectors)]
    rows += [(900, None, 1), (901, [0.0] * 16, 1), (902, [float("nan")] * 16, 1), (903, [None, 1.0], 1), (904, [1.0, 2.0], 1), (905, [2.0, 4.0], 1), (906, [1.0, 2.0], None), (907, [], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r for r in embedding_dedup.embedding_dedup(df.withColumn("copies", df.vec_id)).collect()}
    sound = [r for r in rows if r[0] < 900 or r[0] in (904, 905)]
    cos = lambda a, b: np.dot(a, b) / np.linalg.norm(a) / np.linalg.norm(b)
    links = [(a[0], b[0]) for a in sound for b in sound if a[0] < b[0] and a[2] == b[2] and len(a[1]) == len(b[1]) and cos(a[1], b[1]) >= 0.93]
    degree = defaultdict(int)
    for a, b in links:
        degree[a] += 1
        degree[b] += 1
    assert len(got) == len(rows) and all(got[r[0]].n_links <= degree[r[0]] for r in rows)
    assert sum(r.n_links for r in got.values()) >= 0.95 * sum(degree.values())
    want = components_of([r[0] for r in rows], links)
    assert np.mean([got[i].component_id == want[i] for i in want]) > 0.97
    assert all(got[i].n_links == 0 and got[i].component_id == i for i in (900, 901, 902, 903, 906, 907))


def test_embedding_counts_in_cut_lists(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK_ROWS", 16)
    rng = np.random.default_rng(7)
    base = rng.standard_normal(16)
    rows = [(i, (base + 0.02 * rng.standard_normal(16)).tolist(), 1) for i in range(150)]
    got = embedding_dedup.embedding_dedup(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert all(r.n_links == 149 and r.component_id == 0 for r in got)


# WARC


def test_warc(spark, sf_dir):
    body = "<p>" + "x" * 200 + "\r\n\r\nWARC/1.1\r\né</p>"
    rows = [(r["page_id"], r["url"], r["html"]) for r in table(f"{sf_dir}/pages.parquet")]
    rows += [(900, "http://a b\r\nc/", body), (901, None, body), (902, "http://x/", body), (902, "http://x/", body), (903, "u", None), (904, "u", ""), (905, "u", "short"), (906, "u", "short"), (None, "u", body), (None, "u", "lone" * 50)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    folder = shared_folder(spark)
    warc.write_archives(df, folder)
    got = warc.captures(spark, folder).collect()
    want = []
    for i, _, html in rows:
        data = (html or "").encode()
        again = html == body and i != 900
        want.append((str(i), len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", 900 if again else None))
    assert sorted(((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == sorted(want, key=str)
    nested = warc.assemble(stored(warc.read_records(spark, folder)))
    assert nested.filter("request is null or metadata is null").count() == 0 and nested.count() == len(rows)
    assert pd.Series([r.n for r in nested.groupBy("response.record_id").count().toDF("id", "n").collect()]).max() == 1
