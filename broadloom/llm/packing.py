"""Best-fit packing by a configuration linear program over the length histogram.

Documents become token pieces of at most ``capacity`` tokens. Only the histogram
of piece lengths, of at most ``capacity`` rows, goes to the driver. There a
configuration (a multiset of lengths that fits one sequence) is a column of a
covering program over all of the demand, solved by multiplicative weights: prices
of lengths fall as configurations that are best at these prices cover them, until
they agree, which is also a lower bound; knapsack dynamic programming prices, for
every length, the best configuration that holds it. At those prices columns gather
multiplicities, which are rounded down; what that leaves is covered again in whole
steps, and best fit on the histogram packs the few pieces left.
Pieces then take their places by rank in their length, in one distributed pass.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, replace
from itertools import islice
from unicodedata import category, is_normalized

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from broadloom.llm.common import stored

CAPACITY = 2048
#: Rounds of a pass over the program, and the part of a length's demand that one round may cover.
ROUNDS, ROUND_SHARE = 63, 1 / 16
#: The passes, each (rate of the weights inside the cover, preference for long pieces, how far below the best price a column may lie): at prices by length, and at prices that weights have moved, tried in turn.
FILLING = ((3e-3, 1e-2, 1e-3),) * 4
PRICED = tuple(tuple((rate, 0.0, 2e-3 * 2**n) for n in range(8)) for rate in (1e-2, 1e-1)) + (((0.1, 0.1, 0.03),) * 4,)
#: Rounds of multiplicative weights on prices at most, the first step, the width of a loss, rounds without a better bound before the step is halved, how far below the best a configuration taken may be worth, and rounds that raise prices.
WEIGHT_ROUNDS, STEP, STEP_WIDTH, PATIENCE, STEP_GAP, RAISES = 1_000, 0.1, 4.0, 40, 0.01, 2
#: A solution this close to the lower bound is taken without a further try.
CLOSE = 1e-4
#: Pieces of one length that are ranked in one group, about.
RANK_ROWS = 2_000
#: Words whose ids a Python worker remembers in each of two generations, about 90 MB for each.
MEMORY_WORDS = 500_000
_SIGNS = ".,;:!?#$%&*"
#: Stands between words that are learned together.
_MARK = "\x01"
#: Final sigma and dotted I are lowered by context; \\x1c-\\x1f separate words for Python alone.
_ODD = re.compile("[\u03a3\u0130\x01\x1c-\x1f]")
#: Python knows every character up to this one.
_BEYOND = re.compile("[^\x00-\u02ff]")


def _unknown(text: str) -> bool:
    """Whether a code point stands in the text that Python's tables do not know and the tokenizer's newer ones may lower."""
    return _BEYOND.search(text) is not None and any(category(c) == "Cn" for c in set(text))


class WordTokens:
    """Token ids of texts under a tokenizer file that drops white space; remembers the ids of words.

    A word is what stands between white space. The file's pre-tokenizer never joins
    over white space, so a text's ids are its words' ids in turn; the file's own
    model is run on the words that are not known, many in one call, told apart by a
    mark. Texts whose lower-casing depends on more than the single character, whose
    separators Python and the tokenizer see differently, or that hold the mark, one of
    the file's added tokens or a code point newer than Python's tables, go to the tokenizer whole.
    """

    def __init__(self, path: str, memory: int = MEMORY_WORDS):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            parts = json.load(f)
        self.tokenizer = Tokenizer.from_str(json.dumps(parts))
        self.added = tuple(t["content"].lower() for t in parts["added_tokens"])
        self.lowered = Tokenizer.from_str(json.dumps(parts | {"normalizer": None}))  # for words that are lower-cased already
        self.mark = self.tokenizer.encode(_MARK, add_special_tokens=False).ids
        # words used lately, and those used before them
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.memory = memory

    def _learn(self, fresh: list[str]) -> None:
        for i in range(0, len(fresh), 1000):
            some = fresh[i : i + 1000]
            got = self.lowered.encode_batch_fast([f" {_MARK} ".join(some)], add_special_tokens=False)[0]
            ids = np.array(got.ids, "<u4")
            ends = np.flatnonzero(ids == self.mark[0])
            data = ids.tobytes()
            self.words.update(zip(some, map(data.__getitem__, map(slice, [0, *(4 * ends + 4).tolist()], [*(4 * ends).tolist(), len(data)])), strict=True))

    def __call__(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit numbers."""
        split: list[list[str] | None] = []
        for text in texts:
            low = text.lower()
            plain = text.isascii() or (is_normalized("NFC", text) and is_normalized("NFC", low))
            split.append(None if not plain or _ODD.search(text) or _unknown(text) or any(a in low for a in self.added) else low.split())
        if len(self.words) > self.memory:
            self.older, self.words = self.words, {}
        fresh = set().union(*[s for s in split if s]).difference(self.words)
        # signs after a letter or digit are a part of their own
        bases = {w: base for w in fresh if (base := w.rstrip(_SIGNS)) and base != w and base[-1].isalnum()}
        fresh = fresh.difference(bases).union(bases.values(), (w[len(base) :] for w, base in bases.items())).difference(self.words)
        again = fresh.intersection(self.older) if self.older else set()
        self.words.update((w, self.older[w]) for w in again)
        self._learn(sorted(fresh - again))
        self.words.update((w, self.words[base] + self.words[w[len(base) :]]) for w, base in bases.items())
        get = self.words.__getitem__
        return [np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes() if words is None else b"".join(map(get, words)) for text, words in zip(texts, split, strict=True)]


#: One tokenizer for each file in a Python worker, kept over the tasks that it runs.
_OPENED: dict[str, WordTokens] = {}


def _opened(path: str, memory: int) -> WordTokens:
    if path not in _OPENED:
        _OPENED[path] = WordTokens(path, memory)
    _OPENED[path].memory = memory
    return _OPENED[path]


_PIECES = "doc_key long, doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", memory: int = MEMORY_WORDS, keep: bool = True) -> DataFrame:
    """(doc_key, doc_id, piece, start, length, ids_crc32) of every row's whole text.

    A null or empty text is the end token alone. Only texts of more than
    ``capacity`` tokens are cut. doc_key tells repeated rows apart. ``memory``: words
    that a Python worker remembers, ``keep``: whether it holds on to them and to the
    tokenizer between tasks; they change speed, not results.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, end, width = _opened(tokenizer_path, memory), np.array([end_id], "<u4").tobytes(), 4 * capacity
        for batch in batches:
            sizes, sums = [], array("q")
            texts = ((x.as_py() or "") for x in batch.column("text"))
            for data in (got + end for some in iter(lambda: list(islice(texts, 256)), []) for got in tokens(some)):  # noqa: B023
                sizes.append(len(data) // 4)
                if len(data) <= width:
                    sums.append(zlib.crc32(data))
                else:
                    view = memoryview(data)
                    sums.extend(zlib.crc32(view[i : i + width]) for i in range(0, len(data), width))
            size = np.array(sizes, np.int64)
            pieces = -(-size // capacity)
            of = np.repeat(np.arange(len(size)), pieces)
            piece = np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = piece * capacity
            columns = [batch.column("doc_key").take(pa.array(of)), batch.column("doc_id").take(pa.array(of)), pa.array(piece, pa.int32()), pa.array(start), pa.array(np.minimum(size[of] - start, capacity)), pa.array(np.frombuffer(sums, np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_key", "doc_id", "piece", "start", "length", "ids_crc32"])
        if not keep:
            _OPENED.pop(tokenizer_path, None)

    scan = docs.select(F.monotonically_increasing_id().alias("doc_key"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return scan.mapInArrow(run, _PIECES)


def _picks(values: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The knapsack's greatest values for each room, and the length that a best choice of a room begins with (-1: none fits)."""
    best, pick = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    fits = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for room in range(int(lengths[0]), capacity + 1):
        n = fits[room]
        worth = best[room - lengths[:n]] + values[:n]
        k = int(worth.argmax())
        # as good with less room: the rest stays open
        best[room], pick[room] = (worth[k], k) if worth[k] > best[room - 1] else (best[room - 1], pick[room - 1])
    return best, pick


def knapsack(values: np.ndarray, lengths: np.ndarray, capacity: int) -> np.ndarray:
    """The greatest value of a multiset of pieces for each room from 0 to ``capacity``; lengths rise."""
    best = np.zeros(capacity + 1)
    fits = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for room in range(int(lengths[0]), capacity + 1):
        n = fits[room]
        best[room] = max(best[room - 1], (best[room - lengths[:n]] + values[:n]).max())
    return best


def _column(first: int, lengths: np.ndarray, values: np.ndarray, open_: np.ndarray, allowed: np.ndarray, best: np.ndarray, need: float, capacity: int) -> dict[int, int] | None:
    """The best configuration with a piece of ``first`` and lengths used at most ``allowed`` times; None if its value is below ``need``.

    ``best`` prices each room; ``open_`` are the values with used-up lengths struck out.
    """
    counts, room, value = {first: 1}, capacity - int(lengths[first]), values[first]
    if value + best[room] < need:
        return None
    while room >= lengths[0]:
        n = int(np.searchsorted(lengths, room, side="right"))
        worth = best[room - lengths[:n]] + open_[:n]
        k = int(worth.argmax())
        while worth[k] > 0 and counts.get(k, 0) + 1 > allowed[k]:
            worth[k] = -1
            k = int(worth.argmax())
        if worth[k] <= 0:
            break
        if value + worth[k] < need:
            return None
        counts[k] = counts.get(k, 0) + 1
        value += values[k]
        room -= int(lengths[k])
    return counts if value >= need else None


def _raised(prices: np.ndarray, lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Prices raised by what the best configuration around each length lacks to 1, times the part of a sequence it fills.

    The pieces of a configuration fill a sequence at most, so none becomes worth more than 1.
    """
    for _ in range(RAISES):
        best, _ = _picks(prices, lengths, capacity)
        prices = prices / best[capacity]
        prices = prices + np.maximum(1 - (prices + best[capacity - lengths] / best[capacity]), 0) * lengths / capacity
    return prices / _picks(prices, lengths, capacity)[0][capacity]


def weights(lengths: np.ndarray, demand: np.ndarray, capacity: int) -> tuple[np.ndarray, float]:
    """(prices, bound) of the program's dual by multiplicative weights: no configuration's pieces are worth more than 1.

    Prices begin in proportion to the length. In a round one knapsack gives the best
    configuration around every length; those within STEP_GAP of the best are taken as
    often as their length is demanded, and a length's price falls by the exponential of
    how far it is covered, relative to the mean by value and bounded by STEP_WIDTH
    (cheap partners are covered many times over). Prices times demand are a lower
    bound of any packing. Where it has not risen for PATIENCE rounds, weights go on
    from the best prices, raised, with half the step.
    """
    total, prices, step = demand.astype(np.float64), lengths / capacity, STEP
    top, bound, since = prices, 0.0, 0
    for _ in range(WEIGHT_ROUNDS):
        best, pick = _picks(prices, lengths, capacity)
        prices = prices / best[capacity]
        since += 1
        if (got := float((total * prices).sum())) > bound * (1 + 1e-6):
            top, bound, since = prices, got, 0
        elif since > PATIENCE:
            step, since = step / 2, 0
            if step < STEP / 100:
                break
            top = prices = _raised(top, lengths, capacity)
            bound = float((total * top).sum())
            best, pick = _picks(prices, lengths, capacity)
        near = np.flatnonzero(prices + best[capacity - lengths] / best[capacity] >= 1 - STEP_GAP)
        covered = np.zeros(len(lengths))
        covered[near] = total[near]
        room, times = capacity - lengths[near], total[near]
        while len(room):
            k = pick[room]
            on = k >= 0
            room, times, k = room[on], times[on], k[on]
            np.add.at(covered, k, times)
            room = room - lengths[k]
        covered /= total
        mean = (covered * total * prices).sum() / (total * prices).sum()
        prices = prices * np.exp(-step * np.minimum(covered / mean, STEP_WIDTH))
    top = _raised(top, lengths, capacity)
    return top, float((total * top).sum())


def cover(lengths: np.ndarray, demand: np.ndarray, capacity: int, rate: float, long_first: float, gap: float, whole: bool, prices: np.ndarray | None = None, rounds: int = ROUNDS) -> dict[tuple[tuple[int, int], ...], float]:
    """Columns ((length number, pieces), ..) of the covering program and how often each is taken.

    A length is worth its price (its part of a sequence unless given) times a weight
    exp(-rate x the part of its demand that is covered), a little more for long pieces,
    so that short ones stay to fill the last gaps. In a round the columns of all
    lengths are priced by one knapsack, those within ``gap`` of the best are taken as
    often as ROUND_SHARE of every demand allows, and weights change after. Demand is
    never covered twice. With ``whole`` multiplicities are whole numbers.
    """
    prices = lengths / capacity if prices is None else prices
    total, left = demand.astype(np.float64), demand.astype(np.float64)
    taken: dict[tuple[tuple[int, int], ...], float] = {}
    for _ in range(rounds):
        live = np.flatnonzero(left >= 1)
        if not len(live):
            break
        own = lengths[live]
        values = prices[live] * np.exp(-rate * (1 - left[live] / total[live])) * (1 + long_first * own / capacity)
        best = knapsack(values, own, capacity)
        need = (1 - gap) * best[capacity]
        allowed = np.minimum(np.maximum(total[live] * ROUND_SHARE, 1), left[live])
        open_, found = values.copy(), False
        for first in range(len(live) - 1, -1, -1):
            while allowed[first] >= 1:
                counts = _column(first, own, values, open_, allowed, best, need, capacity)
                if counts is None:
                    break
                at, n = np.fromiter(counts, np.int64), np.fromiter(counts.values(), np.int64)
                times = (allowed[at] / n).min()
                times = float(np.floor(times)) if whole else float(times)
                key = tuple(sorted((int(live[k]), c) for k, c in counts.items()))
                taken[key] = taken.get(key, 0.0) + times
                allowed[at] -= times * n
                left[live[at]] -= times * n
                open_[at[allowed[at] < 1]] = -np.inf
                found = True
        if not found:
            break
    return taken


def best_fit(lengths: np.ndarray, left: np.ndarray, capacity: int) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """Packs the counts ``left`` on the histogram: the longest length opens a sequence, the longest that fits follows.

    Each filled configuration is used as often as its counts allow, which uses up
    one length or more, so the steps depend on the number of lengths alone.
    """
    plans, left = [], left.copy()
    while left.any():
        counts, room = [], capacity
        for k in np.flatnonzero(left)[::-1]:
            take = min(int(left[k]), room // int(lengths[k]))
            if take:
                counts.append((int(k), take))
                room -= take * int(lengths[k])
        times = min(int(left[k]) // n for k, n in counts)
        for k, n in counts:
            left[k] -= n * times
        plans.append((tuple(sorted(counts)), times))
    return plans


@dataclass(frozen=True)
class Packing:
    """Configurations ((length number, pieces), ..) with their multiplicities, how many sequences are columns of the program, and a lower bound of any packing."""

    plans: list[tuple[tuple[tuple[int, int], ...], int]]
    by_program: int
    bound: int

    @property
    def sequences(self) -> int:
        return sum(times for _, times in self.plans)


def _solve(lengths: np.ndarray, demand: np.ndarray, capacity: int, passes: tuple[tuple[float, float, float], ...], bound: int, prices: np.ndarray | None = None) -> Packing:
    """A packing by ``passes`` (the settings of each) over the program at ``prices``: the first fractional and over all of the demand, the others whole."""
    left = demand.astype(np.int64)
    plans: list = []
    for number, setting in enumerate(passes):
        live = np.flatnonzero(left)
        if not len(live):
            break
        columns = cover(lengths[live], left[live], capacity, *setting, whole=number > 0, prices=None if prices is None else prices[live])
        whole = [(tuple((int(live[k]), n) for k, n in key), int(times + 1e-9)) for key, times in columns.items() if times + 1e-9 >= 1]
        for key, times in whole:
            for k, n in key:
                left[k] -= n * times
        plans += whole
    return Packing(plans + best_fit(lengths, left, capacity), sum(times for _, times in plans), bound)


def solve(lengths: np.ndarray, demand: np.ndarray, capacity: int = CAPACITY) -> Packing:
    """Configurations that hold every piece of the histogram exactly once; ``lengths`` rise.

    The first prices are the lengths, whose bound is all tokens over the capacity.
    Where the packing is not as small as that but for CLOSE, multiplicative weights
    move the prices, which gives a higher bound, and PRICED are tried in turn at
    those. The fewest sequences are taken.
    """
    if not len(lengths):
        return Packing([], 0, 0)
    bound = -(-int((lengths * demand).sum()) // capacity)
    found = _solve(lengths, demand, capacity, FILLING, bound)
    if found.sequences <= bound * (1 + CLOSE):
        return found
    prices, dual = weights(lengths, demand, capacity)
    bound = max(bound, int(np.ceil(dual * (1 - 1e-9))))
    tried = [found]
    for passes in PRICED:
        if tried[-1].sequences <= bound * (1 + CLOSE):
            break
        tried.append(_solve(lengths, demand, capacity, passes, bound, prices))
    return replace(min(tried, key=lambda p: p.sequences), bound=bound)


def _slots(packing: Packing, lengths: np.ndarray) -> dict[int, np.ndarray]:
    """Per length the rows (first rank, first sequence, pieces in each sequence, offset of the first)."""
    slots: dict[int, list] = {int(n): [] for n in lengths}
    ranks = dict.fromkeys(slots, 0)
    sequence = 0
    for counts, times in packing.plans:
        offset = 0
        for k, c in reversed(counts):
            n = int(lengths[k])
            slots[n].append((ranks[n], sequence, c, offset))
            ranks[n] += c * times
            offset += n * c
        sequence += times
    return {n: np.array(rows, np.int64).reshape(-1, 4) for n, rows in slots.items()}


def ranked(pieces: DataFrame, histogram: list[tuple[int, int]], rows: int = RANK_ROWS) -> DataFrame:
    """``pieces`` (stored) with ``rank``, from 0 in each length, without one group for a frequent length.

    Rows of a length are dealt by hash over as many parts as its count asks for; parts
    are counted, offsets summed over the parts, and rows numbered inside their part.
    """
    # bounded: a row for each length
    parts = pieces.sparkSession.createDataFrame([(n, -(-count // rows)) for n, count in histogram], "length long, parts int")
    dealt = pieces.join(F.broadcast(parts), "length").withColumn("part", F.pmod(F.xxhash64("doc_key", "piece"), F.col("parts")).cast("int")).drop("parts")
    counts = dealt.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("length", "part").orderBy("doc_key", "piece")
    return dealt.join(offsets, ["length", "part"]).withColumn("rank", F.col("first") + F.row_number().over(inside) - 1).drop("part", "first")


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (stored: doc_key, piece, length and others) with sequence_id and offset.

    Every piece has one place; a sequence's pieces lie without gaps from 0. Pieces
    that fill a sequence have one of their own (numbers below 0). Only the histogram
    of the others is collected: fewer than ``capacity`` rows whatever the table's size.
    """
    alone = pieces.filter(F.col("length") == capacity).withColumns({"sequence_id": -1 - F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")})
    others = pieces.filter(F.col("length") < capacity)
    histogram = [(r["length"], r["n"]) for r in others.groupBy("length").agg(F.count(F.lit(1)).alias("n")).orderBy("length").collect()]
    lengths, demand = np.array([n for n, _ in histogram], np.int64), np.array([c for _, c in histogram], np.int64)
    slots = pieces.sparkSession.sparkContext.broadcast(_slots(solve(lengths, demand, capacity), lengths))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = slots.value
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            order = np.argsort(length, kind="stable")
            starts = np.flatnonzero(np.diff(length[order], prepend=-1))
            for at in np.split(order, starts[1:]) if len(order) else []:
                n = int(length[at[0]])
                rows = table[n]
                slot = rows[np.searchsorted(rows[:, 0], rank[at], side="right") - 1]
                inner = rank[at] - slot[:, 0]
                sequence[at] = slot[:, 1] + inner // slot[:, 2]
                offset[at] = slot[:, 3] + inner % slot[:, 2] * n
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sequence), pa.array(offset)], [*batch.schema.names, "sequence_id", "offset"])

    rows = ranked(others, histogram)
    schema = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes) + ", sequence_id long, offset long"
    return rows.mapInArrow(run, schema).drop("rank").unionByName(alone)


def pack_documents(docs: DataFrame, tokenizer_path: str | None = None, capacity: int = CAPACITY, memory: int = MEMORY_WORDS, keep: bool = True) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null text is empty; an empty table gives no rows; repeated rows are packed each
    for itself; other columns are not read.
    """
    if tokenizer_path is None:
        import public_tokenizers

        tokenizer_path = public_tokenizers.path("word_bpe_49k.json")
    pieces = stored(token_pieces(docs, tokenizer_path, capacity, memory=memory, keep=keep))
    return pack(pieces, capacity).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packs the whole documents table."""
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
