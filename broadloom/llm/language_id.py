"""Language ID by interpolated Kneser-Ney character models in sorted hash arrays.

One model per language over the characters of words, with word boundaries as
characters. An n-gram's probability in every language is resolved when the
models are built, so that scoring looks up one sorted array of 64-bit n-gram
hashes per order, longest order first. A text gets the language of the lowest
cross-entropy per character; it is rejected if even that lies beyond the limit
calibrated for that language on texts that the models were not fitted on.
"""

from __future__ import annotations

import pickle
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from broadloom.llm.common import keep_rows, row_key, sized_join, stored

LETTERS = re.compile(r"[^\W\d_]+")
ORDER = 5
DISCOUNT = 0.75
#: Bound of the sample that the models are fitted and calibrated on: documents for each language.
MAX_FIT_DOCS = 2000
#: A rejected text lies this many times as far beyond its language's mean cross-entropy as the share REJECT_QUANTILE of
#: calibration texts does; these have LONG_CHARS characters or more, if a language has any such.
REJECT_TIMES, REJECT_QUANTILE, LONG_CHARS = 2.0, 0.98, 32
_CACHE_WORDS = 300_000
_MULT = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[str]:
    """Runs of letters (str.isalpha), lower-cased."""
    found = LETTERS.findall((text or "").lower())
    if all(map(str.isalpha, found)):
        return found
    # fractions, powers and the like are word characters, but no letters
    return [part for word in found for part in "".join(c if c.isalpha() else " " for c in word).split()]


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of `` w1 w2 .. `` with a boundary before and after each word, and each word's first place."""
    joined = " " + " ".join(words) + " "
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    return codes, np.append(0, np.cumsum(lengths)[:-1])


def _hashes(codes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n characters that end at each place; the first n-1 places see fewer."""
    h = np.zeros(len(codes), np.uint64)
    for k in range(n):
        shifted = codes if k == 0 else np.concatenate([np.zeros(k, np.uint64), codes[:-k]])
        x = (shifted + np.uint64(k + 1) * np.uint64(0x632BE59BD9B4E019)) * _MULT
        h += (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _grams(words: list[str], n: int) -> np.ndarray:
    """Per predicted character, the code points of the n-gram that ends there (0 where cut by the word's start)."""
    codes, starts = _codes(words)
    place = np.arange(len(codes))
    first = np.zeros(len(codes), np.int64)
    first[starts] = starts
    first = np.maximum.accumulate(first)
    first[starts[1:]] = starts[:-1]  # the boundary after a word belongs to that word
    out = np.zeros((len(codes) - 1, n), np.uint64)
    for k in range(n):
        at = place[1:] - k
        ok = at >= first[1:]
        out[:, n - 1 - k] = np.where(ok, codes[np.maximum(at, 0)], 0)
    return out


def _key(grams: np.ndarray) -> np.ndarray:
    """64-bit hashes of rows of code points."""
    h = np.full(len(grams), 0x243F6A8885A308D3, np.uint64)
    for k in range(grams.shape[1]):
        h = (h ^ grams[:, k]) * _MULT
        h ^= h >> np.uint64(31)
    return h


def count_ngrams(docs: DataFrame) -> DataFrame:
    """(lang, gram binary, n) over the words of ``docs`` (lang, text): full-order n-grams, summed in each task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Counter] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
                seen.setdefault(lang, Counter()).update(words_of(text.as_py()))
        for lang, words in seen.items():
            if not words:
                continue
            distinct = list(words)
            grams = _grams(distinct, ORDER).astype("<u4")
            weight = np.repeat(np.fromiter(words.values(), np.int64, len(words)), np.fromiter(map(len, distinct), np.int64, len(distinct)) + 1)
            flat = np.ascontiguousarray(grams).view(f"V{4 * ORDER}").ravel()
            kinds, which = np.unique(flat, return_inverse=True)
            n = np.bincount(which, weights=weight).astype(np.int64)
            yield pa.RecordBatch.from_pydict({"lang": [lang] * len(kinds), "gram": [k.tobytes() for k in kinds], "n": n})

    return docs.select("lang", "text").mapInArrow(run, "lang string, gram binary, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class LanguageModels:
    """Resolved log-probabilities: for each order a sorted array of hashes and a row of values per n-gram."""

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]]):
        """``counts``: per language the distinct full-order n-grams (rows of code points) and how often each stands."""
        self.langs = sorted(counts)
        self.limits = np.zeros((len(self.langs), 2))
        if not self.langs:
            return
        tables = [self._smooth(*counts[lang]) for lang in self.langs]
        size = 1 + max((len(np.unique(g[:, -1])) for g, _ in counts.values()), default=1)
        self.floor = floor = np.float32(np.log(1 / (size + 1)))
        self.keys, self.values, self.backoffs, self.back_keys = [], [], [], []
        for n in range(1, ORDER + 1):
            contexts = np.unique(np.concatenate([_key(t[n - 1]["contexts"]) for t in tables]))
            back = np.zeros((len(contexts), len(tables)), np.float32)
            for j, t in enumerate(tables):
                back[np.searchsorted(contexts, _key(t[n - 1]["contexts"])), j] = np.log(t[n - 1]["left"])
            grams = np.unique(np.concatenate([t[n - 1]["grams"] for t in tables]), axis=0)
            hashes = _key(grams)
            order = np.argsort(hashes)
            grams, hashes = grams[order], hashes[order]
            # unseen in a language: its back-off weight times the next lower order
            lower = np.full((len(grams), len(tables)), floor) if n == 1 else self._lookup(grams[:, 1:], n - 1)
            value = lower + self._weights(contexts, back, grams[:, :-1])
            for j, t in enumerate(tables):
                own = np.searchsorted(hashes, _key(t[n - 1]["grams"]))
                value[own, j] = np.log(np.exp(value[own, j], dtype=np.float64) + t[n - 1]["high"])
            self.back_keys.append(contexts)
            self.backoffs.append(back)
            self.keys.append(hashes)
            self.values.append(value.astype(np.float32))

    @staticmethod
    def _smooth(grams: np.ndarray, n: np.ndarray) -> list[dict]:
        """Per order: n-grams, their discounted share, contexts, and the mass left to the lower order.

        The highest order counts occurrences, lower orders count distinct left neighbours.
        """
        tables = []
        weight = n.astype(np.float64)
        for order in range(ORDER, 0, -1):
            if order > 1:
                contexts, of = np.unique(grams[:, :-1], axis=0, return_inverse=True)
            else:
                contexts, of = np.zeros((1, 0), np.uint64), np.zeros(len(grams), np.int64)
            of = of.ravel()
            total = np.bincount(of, weights=weight, minlength=len(contexts))
            kinds = np.bincount(of, minlength=len(contexts))
            tables.append({"grams": grams, "high": (weight - DISCOUNT) / total[of], "contexts": contexts, "left": DISCOUNT * kinds / total})
            if order > 1:
                grams, of = np.unique(grams[:, 1:], axis=0, return_inverse=True)
                weight = np.bincount(of.ravel()).astype(np.float64)
        return tables[::-1]

    @staticmethod
    def _weights(contexts: np.ndarray, back: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Log back-off weights of contexts; 0 (weight one) where a language never saw the context."""
        if not len(contexts):
            return np.zeros((len(wanted), back.shape[1]), np.float32)
        h = _key(wanted)
        at = np.minimum(np.searchsorted(contexts, h), len(contexts) - 1)
        return np.where((contexts[at] == h)[:, None], back[at], np.float32(0))

    def _lookup(self, grams: np.ndarray, n: int) -> np.ndarray:
        """Log-probabilities (n-grams x languages) of rows of n code points."""
        if n == 0:
            return np.full((len(grams), len(self.langs)), self.floor, np.float32)
        h = _key(grams)
        keys = self.keys[n - 1]
        at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
        out = self.values[n - 1][at]
        miss = np.flatnonzero(keys[at] != h)
        if len(miss):
            rest = grams[miss]
            out[miss] = self._weights(self.back_keys[n - 1], self.backoffs[n - 1], rest[:, :-1]) + self._lookup(rest[:, 1:], n - 1)
        return out

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Per word the summed log-probability in each language, and in the last column its characters."""
        if not words:
            return np.zeros((0, len(self.langs) + 1))
        lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
        each = self._lookup(_grams(words, ORDER), ORDER).astype(np.float64)
        sums = np.add.reduceat(each, np.append(0, np.cumsum(lengths)[:-1]), axis=0)
        return np.column_stack([sums, lengths])


class Scorer:
    """Cross-entropies of texts; remembers the scores of a bounded number of words."""

    def __init__(self, models: LanguageModels):
        self.models, self.place, self.rows = models, {}, np.zeros((0, len(models.langs) + 1))

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        """Per text the cross-entropy per character in each language, and the number of characters (0: no letter)."""
        split = [words_of(t) for t in texts]
        if len(self.place) > _CACHE_WORDS:
            self.place, self.rows = {}, self.rows[:0]
        fresh = [w for w in dict.fromkeys(w for words in split for w in words) if w not in self.place]
        if fresh:
            start = len(self.place)
            self.place.update(zip(fresh, range(start, start + len(fresh)), strict=True))
            self.rows = np.concatenate([self.rows, self.models.word_scores(fresh)])
        out = np.zeros((len(texts), self.rows.shape[1]))
        get = self.place.__getitem__
        for i, words in enumerate(split):
            if words:
                out[i] = self.rows[np.fromiter(map(get, words), np.int64, len(words))].sum(axis=0)
        n = np.maximum(out[:, -1:], 1)
        return np.column_stack([-out[:, :-1] / n, out[:, -1]])


def fit(docs: DataFrame, max_fit_docs: int = MAX_FIT_DOCS) -> LanguageModels:
    """Models from (doc_id, lang, text) rows; rows of null lang, text or doc_id are left out.

    A documented, bounded sample is fitted: of each language the ``max_fit_docs``
    documents of smallest id hash, three quarters for counts, one for calibration.
    """
    spark = docs.sparkSession
    usable = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    u = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 31)) / float(1 << 31)
    ids = usable.select("lang", "doc_id", u.alias("u"))
    sizes = stored(ids.groupBy("lang").agg(F.count(F.lit(1)).alias("n")))
    # of a frequent language about four times the sample comes to the ranking, however many rows it has, in parts of
    # about a 16th of the sample each: ranked inside their part and shifted by the parts before it
    part = F.floor(F.col("u") * F.col("n") * 16 / max_fit_docs)
    few = sized_join(ids, sizes, ["lang"], "inner").filter(F.col("u") * F.col("n") < 4 * max_fit_docs).select("lang", "doc_id", "u", part.alias("part"))
    before = Window.partitionBy("lang").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # bounded: 64 parts for each language
    shift = few.groupBy("lang", "part").agg(F.count(F.lit(1)).alias("n")).select("lang", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    inside = F.row_number().over(Window.partitionBy("lang", "part").orderBy("u", "doc_id"))
    ranked = few.withColumn("r", inside).join(F.broadcast(shift), ["lang", "part"])
    picked = ranked.withColumn("r", F.col("r") + F.col("shift")).filter(F.col("r") <= max_fit_docs).select("lang", "doc_id", "r")
    # bounded: max_fit_docs rows for each language
    sample = usable.join(F.broadcast(picked.distinct()), ["lang", "doc_id"]).select("lang", "text", (F.col("r") % 4 == 0).alias("check")).persist()
    counts: dict[str, tuple[list, list]] = {}
    for row in count_ngrams(sample.filter(~F.col("check"))).toArrow().to_batches():
        for lang in set(row.column("lang").to_pylist()):
            mine = row.filter(pa.compute.equal(row.column("lang"), lang))
            grams, ns = counts.setdefault(lang, ([], []))
            grams.append(np.frombuffer(b"".join(mine.column("gram").to_pylist()), "<u4").reshape(-1, ORDER))
            ns.append(mine.column("n").to_numpy())
    merged = {k: (np.concatenate(g).astype(np.uint64), np.concatenate(n)) for k, (g, n) in counts.items()}
    order = {k: np.lexsort(g.T[::-1]) for k, (g, _) in merged.items()}
    models = LanguageModels({k: (g[order[k]], n[order[k]]) for k, (g, n) in merged.items()})
    if models.langs:
        models.limits = _calibrate(spark, models, sample.filter("check"))
    sample.unpersist()
    return models


def _allowance(n: np.ndarray) -> np.ndarray:
    """How many times as far as a long text one of ``n`` characters may lie from the mean."""
    return np.sqrt(1 + LONG_CHARS / np.maximum(n, 1))


def _calibrate(spark: SparkSession, models: LanguageModels, texts: DataFrame) -> np.ndarray:
    """Per language mean of the own-language cross-entropy on unfitted texts, and how far beyond it a long text may lie."""
    shared = spark.sparkContext.broadcast(pickle.dumps(models))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(pickle.loads(shared.value))
        index = {k: i for i, k in enumerate(scorer.models.langs)}
        for batch in batches:
            got = scorer([t.as_py() for t in batch.column("text")])
            langs = batch.column("lang").to_pylist()
            keep = [i for i, k in enumerate(langs) if k in index and got[i, -1] > 0]
            own = np.array([got[i, index[langs[i]]] for i in keep], float)
            yield pa.RecordBatch.from_pydict({"lang": [langs[i] for i in keep], "h": own, "n": got[keep, -1]}, schema=pa.schema({"lang": pa.string(), "h": pa.float64(), "n": pa.float64()}))

    scored = texts.select("lang", "text").mapInArrow(run, "lang string, h double, n double")
    got = scored.toArrow()  # bounded: a quarter of max_fit_docs rows for each language
    of, h, n = np.array(got.column("lang").to_pylist(), object), got.column("h").to_numpy(), got.column("n").to_numpy()
    limits = np.full((len(models.langs), 2), np.inf)
    for i, lang in enumerate(models.langs):
        mine = of == lang
        mine = long if (long := mine & (n >= LONG_CHARS)).any() else mine
        if mine.any():
            mean = np.average(h[mine], weights=n[mine])
            far = np.quantile((h[mine] - mean) / _allowance(n[mine]), REJECT_QUANTILE)
            limits[i] = mean, max(REJECT_TIMES * far, 0.25 * mean)
    shared.unpersist()
    return limits


def _decider(pickled: bytes):
    """A function from a column of texts to languages, scores and whether each is rejected."""
    scorer = Scorer(pickle.loads(pickled))
    langs, limits = scorer.models.langs, scorer.models.limits

    def decide(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        if not langs:
            return ["und"] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        got = scorer([t.as_py() for t in texts])
        h, n = got[:, :-1], got[:, -1]
        best = h.argmin(axis=1)
        least = h[np.arange(len(h)), best]
        share = 1 / np.exp(-(h - least[:, None]) * np.minimum(n, 32)[:, None]).sum(axis=1)
        room = limits[best, 1] * _allowance(n)
        none = n == 0
        names = ["und" if x else langs[i] for x, i in zip(none, best, strict=True)]
        return names, np.where(none, 0.0, share), none | (least - limits[best, 0] > room)

    return decide


def identify(docs: DataFrame, models: LanguageModels, id_type: str = "long") -> DataFrame:
    """(doc_id, lang_pred, score, rejected) for every row of (doc_id, text).

    ``und`` with score 0 and rejected, where the text is null or has no letter, or
    where no language was learned. Else the language of the lowest cross-entropy
    per character (ties: the first by name), even when rejected. score: its share,
    with each language weighted by exp(-cross-entropy) of one character, sharpened
    by at most 32 characters. Rejection: the cross-entropy exceeds the language's
    mean by more than its limit; the shorter a text, the more room it is given.
    """
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(models))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decide = _decider(shared.value)
        for batch in batches:
            for i in range(0, batch.num_rows, 1000):
                part = batch.slice(i, 1000)
                names, score, rejected = decide(part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(names, pa.string()), pa.array(score), pa.array(rejected)], ["doc_id", "lang_pred", "score", "rejected"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, lang_pred string, score double, rejected boolean")


def keep_identified(docs: DataFrame, max_fit_docs: int = MAX_FIT_DOCS) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, lang and any others) whose language is not rejected, unchanged.

    Null, empty and letterless texts are rejected; rows of null ids are decided like
    others, repeated rows each stay or go; nothing is fitted on an empty table, which
    stays empty. Other columns, of whatever names, are kept as they are.
    """
    models = fit(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang").filter(~held_out()), max_fit_docs)
    # rows of one key have one text and so one decision; texts go to Python, only keys of what goes come back
    key = row_key(docs)
    gone = identify(docs.select(key.alias("doc_id"), "text"), models, "binary").filter("rejected")
    return keep_rows(docs, gone.select(F.col("doc_id").alias("key"), F.lit(False).alias("kept")), key, once=False)


def held_out() -> F.Column:
    """Whether crc32 of the id as text is 2 modulo 4; false for a null id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_fit_docs: int = MAX_FIT_DOCS) -> DataFrame:
    """Fits on the rows that are not held out and identifies every row: doc_id, held_out, lang_pred, score, rejected.

    Every row gives one row, repeated rows too; an empty table an empty result. Only
    text enters a prediction. Other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    models = fit(rows.filter(~held_out()), max_fit_docs)
    found = identify(rows, models)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of the whole documents table."""
    return language_id(spark.read.parquet(f"{sf_dir}/documents.parquet"))
