"""Substring dedup by compact windows.

Tokens are runs of 15 words (11 shingles of five words); of every 11 successive
tokens the one of least hash is a window: the nodes of the Cartesian tree of the
hashes that span 11 tokens or more, about 2/12 for each token. Detection needs
these nodes' places only, which a sliding minimum gives; how far each reaches to
the left and right, the tree itself, is computed where ``bounds`` asks for it.
Texts that share 25 words share a window hash. A passage of 50 words or more and
a similarity of 0.8 has an unbroken run of 21 shingles (25 words): a changed,
added or left out word costs nine shingles of both sides together, which 36 equal
ones must pay for; so k edits leave 36 k in k + 1 runs, or 41 in two.

Windows are joined on their hash to the first window of it, joined again as runs
on a diagonal of a pair of texts, and regions around them are verified on
shingles. Windows that share no passage with the first of their hash are compared
with each other, in pairs of blocks of bounded size.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from broadloom.llm.common import drop_stored, sized_join, stored
from broadloom.llm.components import compare_blocks

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
SHINGLE_WORDS = 5
PASSAGE_WORDS = 50
SIMILARITY = 0.8
#: Shingles of the shortest passage.
PASSAGE = PASSAGE_WORDS - SHINGLE_WORDS + 1
#: Shingles of a block that is enough for a passage by itself: 41 of 46 shingles equal is a similarity of 0.804.
BLOCK = 41
#: Regions that are read for verification begin and end at multiples of this.
GRID = 32


@dataclass(frozen=True)
class Hashing:
    """Tokens of ``shingles`` successive shingles, windows of at least ``span`` tokens, and a seed."""

    shingles: int
    span: int
    seed: int


SEED = Hashing(11, 11, 1)
SEED_WORDS = SEED.shingles + SHINGLE_WORDS - 1
#: Shingles to both sides of a window or run that are looked at.
REACH = 2 * PASSAGE
#: Windows of a hash in a block; two blocks meet in one task.
BLOCK_ROWS = 64
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_PLACE_BITS = 28
_CACHE_WORDS = 400_000


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


def _ahead(h: np.ndarray, n: int) -> np.ndarray:
    """Each place's value ``n`` places on; zero past the end."""
    out = np.zeros_like(h)
    if n < len(h):
        out[: len(h) - n] = h[n:]
    return out


def _runs(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` values that begin at each place, by doubling (values past the end count as zero)."""
    total, size, power, width = np.zeros(len(h), np.uint64), 0, h, 1
    while width <= n:
        if n & width:
            total = total * np.uint64(pow(0x9E3779B97F4A7C15, width, 1 << 64)) + _ahead(power, size)
            size += width
        power = power * np.uint64(pow(0x9E3779B97F4A7C15, width, 1 << 64)) + _ahead(power, width)
        width *= 2
    return _mix(total)


def _shingled(words: np.ndarray) -> np.ndarray:
    return _runs(words, SHINGLE_WORDS) >> np.uint64(32)


class Shingler:
    """Shingle hashes of texts; remembers the hashes of a bounded number of words."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def words(self, text: str | None) -> np.ndarray:
        found = WORD.findall((text or "").encode("utf-8", "surrogatepass").lower())
        known = self.known
        try:
            return np.fromiter(map(known.__getitem__, found), np.uint64, len(found))
        except KeyError:
            if len(known) > _CACHE_WORDS:
                known.clear()
            for w in set(found):
                known[w] = xxhash.xxh64_intdigest(w)
            return np.fromiter(map(known.__getitem__, found), np.uint64, len(found))

    def shingles(self, text: str | None) -> np.ndarray:
        """One hash for each run of five words, in 32 bits."""
        words = self.words(text)
        return _shingled(words)[: max(0, len(words) - SHINGLE_WORDS + 1)]


def _window_minima(keys: np.ndarray, span: int) -> np.ndarray:
    """Minimum of the ``span`` keys that begin at each place, by doubling."""
    m, width = keys, 1
    while width * 2 <= span:
        m = np.minimum(m[: len(m) - width], m[width:])
        width *= 2
    rest = span - width
    return np.minimum(m[: len(m) - rest], m[rest:]) if rest else m


def compact_windows(hashes: np.ndarray, text_of: np.ndarray, how: Hashing, bounds: bool = True, last: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, l, c, r) of the compact windows of texts laid end to end.

    ``hashes`` are token hashes, ``text_of`` the text of each token, rising. A node
    of the Cartesian tree spans ``span`` tokens if and only if it is the minimum of
    some run of ``span``, and the nearest smaller tokens on both sides of such a node
    are such nodes themselves or lie outside the text; so the tree is built on the
    run minima alone. Tokens marked ``last`` come after all others in the order of hashes.
    """
    none = np.empty(0, np.int64)
    if len(hashes) < how.span:
        return none.astype(np.uint64), none, none, none
    seeded = _mix(hashes ^ np.uint64(how.seed * 0x632BE59BD9B4E019 % (1 << 64)))
    if last is not None:
        seeded[last] = np.uint64((1 << 64) - 1)
    place = np.arange(len(hashes), dtype=np.uint64)
    low = np.uint64((1 << _PLACE_BITS) - 1)
    minima = _window_minima((seeded & ~low) | place, how.span)
    inside = text_of[: len(minima)] == text_of[how.span - 1 :]
    nodes = np.unique((minima[inside] & low).astype(np.int64))
    if not bounds:
        return hashes[nodes], nodes, nodes, nodes
    first = np.searchsorted(text_of, text_of[nodes], side="left")
    last = np.searchsorted(text_of, text_of[nodes], side="right") - 1
    left, right = first.tolist(), last.tolist()
    keys, texts, at = ((seeded[nodes] & ~low) | nodes.astype(np.uint64)).tolist(), text_of[nodes].tolist(), nodes.tolist()
    stack: list[int] = []
    for i, key in enumerate(keys):
        while stack and texts[stack[-1]] != texts[i]:
            stack.pop()
        while stack and keys[stack[-1]] > key:
            right[stack.pop()] = at[i] - 1
        if stack:
            left[i] = at[stack[-1]] + 1
        stack.append(i)
    return hashes[nodes], np.array(left), nodes, np.array(right)


def _stretched(own: np.ndarray, h: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows (rising numbers) that stand for all, and how much farther on each was last repeated.

    Of windows of one hash and text that each begin less than two passages after the
    one before, the first stands for the stretch that they reach over.
    """
    order = np.lexsort((place, h, own))
    soon = (np.diff(own[order]) == 0) & (h[order][1:] == h[order][:-1]) & (np.diff(place[order]) < 2 * PASSAGE)
    first, last = order[np.append(True, ~soon)[: len(order)]], order[np.append(~soon, True)[: len(order)]]
    by = np.argsort(first)
    return first[by], (place[last] - place[first])[by]


#: The words after a window that matter (a passage's length at most), its place, and how much farther on it was last repeated, in one number.
_EXTENT_BITS, _TAIL_BIT = 28, 56
_PACKED = "hash long, doc_id long, pack long"


def _same_word_runs(words: np.ndarray, text_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place where the stretch of its word, said over and over, begins and ends (exclusive)."""
    bounds = np.concatenate([[0], np.flatnonzero((np.diff(words) != 0) | (np.diff(text_of) != 0)) + 1, [len(words)]])
    sizes = np.diff(bounds)
    return np.repeat(bounds[:-1], sizes), np.repeat(bounds[1:], sizes)


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shingler = Shingler()
    for batch in batches:
        for i in range(0, batch.num_rows, 500):
            part = batch.slice(i, 500)
            words = [shingler.words(t.as_py()) for t in part.column("text")]
            sizes = np.array([len(w) for w in words])
            starts = np.append(0, np.cumsum(sizes)[:-1])
            of = np.repeat(np.arange(len(words)), sizes)
            ids = np.array(part.column("doc_id").to_pylist(), np.int64)
            if len(of) < SEED_WORDS:
                continue
            # tokens inside one text that is long enough for a passage
            whole = np.flatnonzero((of[: len(of) - SEED_WORDS + 1] == of[SEED_WORDS - 1 :]) & (sizes[of[SEED_WORDS - 1 :]] >= PASSAGE_WORDS))
            flat = np.concatenate(words)
            tokens = _runs(_shingled(flat), SEED.shingles)[whole]
            begins, ends = (x[whole] for x in _same_word_runs(flat, of))
            one_word = ends - whole >= SEED_WORDS
            h, _, c, _ = compact_windows(tokens, of[whole], SEED, bounds=False, last=one_word)
            # one word said over and over is a passage by itself or not worth a window: it adds one shingle to what lies around it
            c = c[~one_word[c] | (ends[c] - begins[c] >= PASSAGE_WORDS)]
            h, own = tokens[c], of[whole[c]]
            place = whole[c] - starts[own]
            keep, extent = _stretched(own, h, place)
            own, place, h = own[keep], place[keep], h[keep]
            tail = np.minimum(sizes[own] - (place + extent + SEED_WORDS), PASSAGE)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(ids[own]), pa.array(((tail.astype(np.int64) << _TAIL_BIT) + (place << _EXTENT_BITS) + extent).astype(np.int64))], ["hash", "doc_id", "pack"])


def _place(pack: F.Column) -> F.Column:
    return F.shiftright(pack, _EXTENT_BITS).bitwiseAND((1 << _EXTENT_BITS) - 1).cast("int")


def _extent(pack: F.Column) -> F.Column:
    return pack.bitwiseAND((1 << _EXTENT_BITS) - 1).cast("int")


def candidates(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(windows, runs, open): windows of shared hashes, and what they say at once and what is to be verified.

    ``windows`` (hash, doc_id, c, extent, tail, rep_id, rep_c): every window of a hash that
    two documents have, with the first document and place of the hash. ``runs``
    (doc_id, rep_id, start_word, end_word, shift): windows on one diagonal of a pair
    of texts that overlap or touch are an interval of equal words; those of a
    passage's length are found. ``open`` (doc_id, rep_id, a_lo, a_hi, b_lo, b_hi), in
    shingles: what lies around runs near each other that are not one such interval.
    """
    windows = stored(docs.select("doc_id", "text").mapInArrow(_windows, _PACKED))
    # keys are reduced to their least and greatest document before they are joined back; stored, so that the join has
    # a shuffle of its own on both sides and a frequent key can be split in it
    shared = stored(windows.groupBy("hash").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("top")).filter("top > low").select("hash"))
    hit = stored(windows.join(shared, "hash"))
    drop_stored(windows)
    drop_stored(shared)
    first = stored(hit.groupBy("hash").agg(F.min(F.struct("doc_id", "pack")).alias("f")))
    p, q = F.col("pack"), F.col("f.pack")
    rows = stored(hit.join(first, "hash").select("hash", "doc_id", _place(p).alias("c"), _extent(p).alias("extent"), F.shiftright(p, _TAIL_BIT).cast("int").alias("tail"), F.col("f.doc_id").alias("rep_id"), _place(q).alias("rep_c"), _extent(q).alias("rep_extent")))
    line = Window.partitionBy("doc_id", "rep_id", "shift").orderBy("c")
    begins = F.coalesce((F.col("c") - F.lag("c").over(line) > SEED_WORDS).cast("int"), F.lit(1))
    repeats = F.greatest("extent", "rep_extent")
    runs = (
        rows.filter("doc_id > rep_id").withColumn("shift", F.col("rep_c") - F.col("c")).withColumn("begins", begins).withColumn("run", F.sum("begins").over(line))
        .groupBy("doc_id", "rep_id", "shift", "run").agg(F.min("c").alias("start_word"), (F.max("c") + SEED_WORDS).alias("end_word"), F.max(F.col("c") + F.col("extent")).alias("a_last"), F.max(F.col("rep_c") + F.col("rep_extent")).alias("b_last"), F.max(repeats).alias("repeats"))
    )
    near = Window.partitionBy("doc_id", "rep_id").orderBy("start_word", "shift")
    a_end = F.col("a_last") + SEED_WORDS
    runs = runs.withColumn("apart", F.coalesce((F.col("start_word") - F.max(a_end).over(near.rowsBetween(Window.unboundedPreceding, -1)) > REACH).cast("int"), F.lit(1)))
    runs = stored(runs.withColumn("group", F.sum("apart").over(near.rowsBetween(Window.unboundedPreceding, 0))))
    around = PASSAGE + F.floor((F.col("end_word") - F.col("start_word")) * 1.25).cast("int")
    b_start = F.col("start_word") + F.col("shift")
    sure = F.col("end_word") - F.col("start_word") >= PASSAGE_WORDS
    open_ = (
        runs.groupBy("doc_id", "rep_id", "group")
        .agg(F.min(F.col("start_word") - around).alias("a_lo"), F.max(a_end + around).alias("a_hi"), F.min(b_start - around).alias("b_lo"), F.max(F.col("b_last") + SEED_WORDS + around).alias("b_hi"), F.count(F.lit(1)).alias("n"), F.min(sure & (F.col("repeats") == 0)).alias("sure"))
        .filter("n > 1 OR NOT sure").drop("group", "n", "sure")
    )
    return rows, runs.filter(sure).select("doc_id", "rep_id", "start_word", "end_word", "shift"), open_


def _region(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shingler = Shingler()
    for batch in batches:
        rows: dict[str, list] = {"region_doc": [], "lo": [], "hi": [], "shingles": []}
        for doc_id, text, wanted in zip(batch.column("doc_id").to_pylist(), batch.column("text"), batch.column("wanted").to_pylist(), strict=True):
            h = shingler.shingles(text.as_py()).astype(np.uint32).view(np.int32)
            for w in wanted:
                rows["region_doc"].append(doc_id)
                rows["lo"].append(w["lo"])
                rows["hi"].append(w["hi"])
                rows["shingles"].append(h[w["lo"] : w["hi"]])
        yield pa.RecordBatch.from_pydict(rows, schema=pa.schema({"region_doc": pa.int64(), "lo": pa.int32(), "hi": pa.int32(), "shingles": pa.list_(pa.int32())}))


def best_stretch(found: np.ndarray, penalty: int) -> tuple[int, int]:
    """[start, end) of the stretch of greatest score, +1 for true and -penalty for false."""
    sums = np.concatenate([[0], np.cumsum(np.where(found, 1, -penalty))])
    low = np.minimum.accumulate(sums)
    end = int((sums - low).argmax())
    start = int(sums[: end + 1].argmin())
    return start, end


def _longest(sums: np.ndarray, slack: int = 0) -> tuple[int, int]:
    """The places i <= k farthest apart with sums[k] >= sums[i] - slack, by prefix minima."""
    low = np.minimum.accumulate(sums)
    first = np.searchsorted(-low, -(sums + slack), side="left")
    k = int((np.arange(len(sums)) - first).argmax())
    return int(first[k]), k


def _places(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place of ``a`` the first place in sorted ``b`` and the number of equal values."""
    first = np.searchsorted(b, a, side="left")
    return first, np.searchsorted(b, a, side="right") - first


def _chain(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A longest chain of the pairs (i, j), rising in both; pairs come by rising i and falling j."""
    if (np.diff(i) > 0).all() and (np.diff(j) > 0).all():
        return i, j
    tops: list[int] = []
    last: list[int] = []
    before = np.full(len(i), -1)
    for n, y in enumerate(j.tolist()):
        k = bisect_left(tops, y)
        if k:
            before[n] = last[k - 1]
        tops[k : k + 1], last[k : k + 1] = [y], [n]
    path, n = [], last[-1]
    while n >= 0:
        path.append(n)
        n = int(before[n])
    return i[path[::-1]], j[path[::-1]]


def _stretches(a: np.ndarray, b: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """Stretches [start, end) of both sides that may be a passage, the longest first.

    Along a chain of equal shingles a similarity of 0.8 is 9 x equal >= 4 x (both
    lengths), a sum over the steps; the longest stretch of a sum that is not negative
    is taken. Regions that repeat themselves have no chain of their own: there the
    shingles of each side that the other has are scored, at least eight of nine.
    """
    order = np.argsort(b, kind="stable")
    first, n = _places(a, b[order])
    i = np.repeat(np.arange(len(a)), n)
    j = order[np.repeat(first + n, n) - 1 - (np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n))] if len(i) <= 8 * (len(a) + len(b)) else None
    if j is not None:
        x, y = _chain(i, j)
        sums = np.append(0, np.cumsum(9 - 4 * (np.diff(x) + np.diff(y))))
        for k, m in (_longest(sums, 1), best_stretch_of(sums)):
            yield int(x[k]), int(x[m]) + 1, int(y[k]), int(y[m]) + 1
    found = n > 0
    longest = lambda f, penalty: _longest(np.append(0, np.cumsum(np.where(f, 1, -penalty))))
    for how, penalty in ((longest, 8), (best_stretch, 8), (best_stretch, 1 << 20)):
        start, end = how(found, penalty)
        yield start, end, *how(np.isin(b, a[start:end]), penalty)
    if j is not None:  # runs of equal shingles on one diagonal
        by = np.lexsort((i, j - i))
        at, diagonal = i[by], (j - i)[by]
        cut = np.flatnonzero((np.diff(diagonal) != 0) | (np.diff(at) != 1)) + 1
        starts, ends = np.append(0, cut), np.append(cut, len(at))
        k = int((ends - starts).argmax())
        s, e = int(at[starts[k]]), int(at[ends[k] - 1]) + 1
        yield s, e, s + int(diagonal[starts[k]]), e + int(diagonal[starts[k]])


def best_stretch_of(sums: np.ndarray) -> tuple[int, int]:
    """The places i <= k of the greatest sums[k] - sums[i]."""
    k = int((sums - np.minimum.accumulate(sums)).argmax())
    return int(sums[: k + 1].argmin()), k


def _widened(start: int, end: int, size: int) -> tuple[int, int]:
    """A stretch that just misses a passage, made a passage long where the region has room."""
    start = max(0, start - max(0, PASSAGE - (end - start)))
    return start, min(size, max(end, start + PASSAGE))


def verify(a: np.ndarray, b: np.ndarray) -> tuple[int, int, int, int, float] | None:
    """The passage that two regions share: [start, end) in shingles of each and the Jaccard similarity; None if there is none."""
    if min(len(a), len(b)) < PASSAGE or np.count_nonzero(np.isin(a, b)) < BLOCK:
        return None
    for start, end, s, e in _stretches(a, b):
        if min(end - start, e - s) < BLOCK:
            continue
        (start, end), (s, e) = _widened(start, end, len(a)), _widened(s, e, len(b))
        x, y = np.unique(a[start:end]), np.unique(b[s:e])
        same = len(np.intersect1d(x, y, assume_unique=True))
        similarity = same / (len(x) + len(y) - same)
        if similarity >= SIMILARITY:
            return start, end, s, e, similarity
    return None


def passages(a: np.ndarray, b: np.ndarray, pieces: list[tuple[int, int]]) -> tuple[list[tuple[int, int, int, int, float]], list[tuple[int, int]]]:
    """Passages that ``pieces`` of a region share with another, and the pieces that are left."""
    found, todo, left = [], list(pieces), []
    while todo:
        lo, hi = todo.pop()
        if hi - lo < PASSAGE:
            continue
        if (got := verify(a[lo:hi], b)) is None:
            left.append((lo, hi))
            continue
        start, end, s, e, similarity = got
        found.append((lo + start, lo + end, s, e, similarity))
        todo += [(lo, lo + start), (lo + end, hi)]
    return found, left


_NAMES = ["doc_id", "rep_id", "start_word", "end_word", "rep_start", "rep_end", "similarity"]
_FOUND = "doc_id long, rep_id long, start_word int, end_word int, rep_start int, rep_end int, similarity double"


def _columns(rows: list[tuple]) -> dict[str, np.ndarray]:
    kinds = [np.int64, np.int64, *[np.int32] * 4, np.float64]
    return {n: np.array([r[i] for r in rows], k) for i, (n, k) in enumerate(zip(_NAMES, kinds, strict=True))}


def _row(doc: int, rep: int, lo: int, rep_lo: int, passage: tuple) -> tuple:
    start, end, s, e, similarity = passage
    more = SHINGLE_WORDS - 1
    return doc, rep, lo + start, lo + end + more, rep_lo + s, rep_lo + e + more, similarity


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = zip(*(batch.column(c).to_pylist() for c in ("doc_id", "rep_id", "lo", "rep_lo")), strict=True)
        rows = []
        for at, a, b in zip(ids, batch.column("a"), batch.column("b"), strict=True):
            x, y = a.values.to_numpy(), b.values.to_numpy()
            rows += [_row(*at, got) for got in passages(x, y, [(0, len(x))])[0]]
        yield pa.RecordBatch.from_pydict(_columns(rows))


def _regions(table: pa.Table) -> dict:
    shingles = table.column("shingles").combine_chunks()
    flat, ends = shingles.flatten().to_numpy(), np.append(0, np.cumsum(shingles.value_lengths().to_numpy()))
    return {"doc": table.column("doc_id").to_numpy(), "lo": table.column("lo").to_numpy(), "flat": flat, "ends": ends}


def _in_common(flat: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How many places of each region have a shingle that each other region has."""
    n = len(ends) - 1
    code = np.unique(flat, return_inverse=True)[1]
    pairs, places = np.unique(code * n + np.repeat(np.arange(n), np.diff(ends)), return_counts=True)
    code, row = pairs // n, pairs % n
    code = np.unique(code, return_inverse=True)[1]
    often = np.bincount(code) > 1
    label = np.cumsum(often) - 1
    keep = often[code]
    code, row, places = label[code[keep]], row[keep], places[keep]
    common = np.zeros((n, n), np.float32)
    for first in range(0, int(often.sum()), 8192):
        lo, hi = np.searchsorted(code, [first, first + 8192])
        counts = np.zeros((n, 8192), np.float32)
        counts[row[lo:hi], code[lo:hi] - first] = places[lo:hi]
        common += counts @ (counts > 0).astype(np.float32).T
    return common


def _meet(prepared: dict, rows: slice, second: np.ndarray | None) -> dict[str, np.ndarray] | None:
    """Passages of regions of one hash with regions of earlier documents; what is found of a region is not looked for again."""
    doc, lo, ends = prepared["doc"][rows], prepared["lo"][rows], prepared["ends"][rows.start : rows.stop + 1]
    flat = prepared["flat"][ends[0] : ends[-1]]
    ends = ends - ends[0]
    common = _in_common(flat, ends)
    near = (common >= BLOCK) & (common.T >= BLOCK) & (doc[:, None] > doc[None, :])
    if second is not None:
        near &= second[:, None] ^ second[None, :]
    out = []
    for i in np.flatnonzero(near.any(axis=1)):
        a = flat[ends[i] : ends[i + 1]]
        pieces = [(0, len(a))]
        partners = np.flatnonzero(near[i])
        for j in partners[np.argsort(doc[partners], kind="stable")]:
            found, pieces = passages(a, flat[ends[j] : ends[j + 1]], pieces)
            out += [_row(int(doc[i]), int(doc[j]), int(lo[i]), int(lo[j]), f) for f in found]
            if not pieces:
                break
    return _columns(out) if out else None


def _cut(docs: DataFrame, regions: DataFrame) -> DataFrame:
    """(region_doc, lo, hi, shingles) of the distinct ``regions`` (doc_id, lo, hi)."""
    wanted = stored(regions.groupBy("doc_id").agg(F.collect_list(F.struct("lo", "hi")).alias("wanted")))  # bounded by the document's own length
    texts = sized_join(docs, wanted, ["doc_id"], "inner").select("doc_id", "text", "wanted")  # wanted grows with the table
    return stored(texts.mapInArrow(_region, "region_doc long, lo int, hi int, shingles array<int>").dropDuplicates(["region_doc", "lo", "hi"]))


def _down(c: F.Column) -> F.Column:
    return (F.greatest(F.floor((c - 4) / GRID), F.lit(0)) * GRID).cast("int")


def _up(c: F.Column) -> F.Column:
    return (F.ceil((c + 5) / GRID) * GRID).cast("int")


def _inside(found: DataFrame) -> DataFrame:
    """(doc_id, start_word, end_word): the parts of texts that lie a passage's length inside found passages, each once.

    The beginning of a text needs no distance; how much its end needs is the caller's matter.
    """
    start = F.when(F.col("start_word") > 0, F.col("start_word") + PASSAGE).otherwise(0)
    parts = found.select("doc_id", start.alias("start_word"), (F.col("end_word") - PASSAGE).alias("end_word")).filter(F.col("end_word") + PASSAGE > F.col("start_word")).distinct()
    by = Window.partitionBy("doc_id").orderBy("start_word", "end_word")
    top = F.max("end_word").over(by.rowsBetween(Window.unboundedPreceding, -1))
    new = F.coalesce((F.col("start_word") > top).cast("int"), F.lit(1))
    parts = parts.withColumn("new", new).withColumn("part", F.sum("new").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    return stored(parts.groupBy("doc_id", "part").agg(F.min("start_word").alias("start_word"), F.max("end_word").alias("end_word")).drop("part"))


def _among_themselves(docs: DataFrame, rows: DataFrame, found: DataFrame) -> DataFrame:
    """Passages of windows that share none with the first window of their hash.

    A window inside a passage of the first document is left to that, and a window
    that lies a passage's length inside what any document holds is done: what is to
    be found there is found. The others of its hash, the first document's own further
    places too, meet in pairs of blocks.
    """
    r, t, d = rows.alias("r"), found.alias("t"), _inside(found).alias("d")
    held = (F.col("r.doc_id") == F.col("t.doc_id")) & (F.col("r.rep_id") == F.col("t.rep_id")) & F.expr(f"r.c >= t.start_word AND r.c + {SHINGLE_WORDS} <= t.end_word")
    done = (F.col("r.doc_id") == F.col("d.doc_id")) & F.expr(f"r.c >= d.start_word AND r.c + r.extent + {SEED_WORDS} + r.tail <= d.end_word + {PASSAGE}")
    alone = r.filter("doc_id > rep_id").join(d, done, "left_anti").join(t, held, "left_anti").unionByName(rows.filter("doc_id = rep_id AND c > rep_c"))
    lo, hi = _down(F.col("c") - REACH), _up(F.col("c") + F.col("extent") + SEED.shingles + REACH)
    alone = stored(alone.select("hash", "doc_id", lo.alias("lo"), hi.alias("hi")).distinct())
    keys = stored(alone.groupBy("hash").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("top")).filter("top > low").select("hash"))
    alone = stored(alone.join(keys, "hash").withColumn("region", F.xxhash64("doc_id", "lo", "hi")))
    cut = _cut(docs, alone.select("doc_id", "lo", "hi").distinct())
    facts = cut.select(F.xxhash64(F.col("region_doc"), "lo", "hi").alias("region"), F.col("region_doc").alias("doc_id"), "lo", "shingles")
    return compare_blocks(alone.select("hash", "region"), ["hash"], "region", ["doc_id", "lo", "shingles"], _regions, _meet, _FOUND, BLOCK_ROWS, facts)


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Passages that repeat over documents: doc_id, rep_id, start_word, end_word, rep_start, rep_end, similarity.

    One row per document and passage, tied to an earlier document (smaller id) that
    holds it; words are runs without ASCII white space, A-Z lowered, ends exclusive.
    Any passage of 50 or more words that stands in two documents, exactly or with
    edits (Jaccard similarity of five-word shingles of 0.8 or more), ties the later
    one to some document. Null, empty and shorter texts have no passage; null ids take
    no part; rows of one id are one document, so repeated rows are not tied to each
    other. An empty table gives an empty result; other columns are not read.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).filter("doc_id IS NOT NULL AND text IS NOT NULL")
    rows, runs, doubtful = candidates(docs)
    pairs = stored(doubtful.select("doc_id", "rep_id", _down(F.col("a_lo")).alias("lo"), _up(F.col("a_hi")).alias("hi"), _down(F.col("b_lo")).alias("rep_lo"), _up(F.col("b_hi")).alias("rep_hi")).distinct())
    cut = _cut(docs, pairs.select("doc_id", "lo", "hi").union(pairs.select("rep_id", "rep_lo", "rep_hi")).distinct())
    a = cut.select(F.col("region_doc").alias("doc_id"), "lo", "hi", F.col("shingles").alias("a"))
    b = cut.select(F.col("region_doc").alias("rep_id"), F.col("lo").alias("rep_lo"), F.col("hi").alias("rep_hi"), F.col("shingles").alias("b"))
    both = pairs.join(a, ["doc_id", "lo", "hi"]).join(b, ["rep_id", "rep_lo", "rep_hi"]).select("doc_id", "rep_id", "lo", "rep_lo", "a", "b")
    found = stored(both.mapInArrow(_verified, _FOUND))
    exact = runs.select("doc_id", "rep_id", "start_word", "end_word", (F.col("start_word") + F.col("shift")).alias("rep_start"), (F.col("end_word") + F.col("shift")).alias("rep_end"), F.lit(1.0).alias("similarity"))
    # runs that a verified passage holds are not said twice
    held = F.expr("x.doc_id = y.doc_id AND x.rep_id = y.rep_id AND x.start_word >= y.start_word AND x.end_word <= y.end_word")
    first = stored(found.unionByName(exact.alias("x").join(found.alias("y"), held, "left_anti")))
    return first.unionByName(_among_themselves(docs, rows, first)).distinct()


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages that repeat over the whole documents table."""
    return substring_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
