"""Byte-level BPE with a hierarchical-bitmap rank queue.

Merge candidates wait in one bucket per merge rank. A bit for each bucket in use, in
words of 64, and above them a number with a bit for each word in use give the lowest
rank by find-first-set on both levels, whatever the length of the pre-token. A bucket holds positions of a linked
list of parts; a position whose pair has changed since it was queued is stale
and skipped. A pre-token of n bytes costs O(n log n) at worst.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Pieces of text, and pre-tokens, whose ids a worker remembers; a memory is cleared when full.
_CACHE_WORDS = 600_000
_CACHE_TOKENS = 1_200_000
_CACHE_CHARS = 64
# Fixed value: the pre-token pattern of the rank file, under which texts may be cut at single spaces.
SPACE_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_SPACES = re.compile(r"\s\s|^\s|\s$").search


class RankQueue:
    """Buckets of positions by merge rank, and the bitmap words that mark the buckets in use.

    ``low`` has a bit for each rank; the level above, a bit for each word of ``low``, is
    a local number of the merge. All are empty between merges.
    """

    def __init__(self, ranks: int):
        self.low = [0] * (ranks // 64 + 1)
        self.buckets: list[list[int]] = [[] for _ in range(ranks)]


class ByteBPE:
    """Encoder and decoder for a rank file (base64 token and rank on each line)."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        size = max(self.ranks.values()) + 1
        self.tokens: list[bytes] = [b""] * size
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.queue = RankQueue(size)
        self.split = regex.compile(pattern)
        self.known: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.by_space = pattern == SPACE_PATTERN

    def merge(self, data: bytes) -> list[int]:
        """Ids of one pre-token: merges the pair of lowest rank, leftmost first, until none is left."""
        get = self.ranks.get
        if (whole := get(data)) is not None:
            return [whole]
        n = len(data)
        low, buckets, top = self.queue.low, self.queue.buckets, 0
        after = list(range(1, n + 1))  # where the part that begins here ends, and the next begins
        before = list(range(-1, n - 1))
        pair = [get(data[i : i + 2], -1) for i in range(n - 1)]  # rank of the part that begins here joined with the next
        pair.append(-1)
        new = [(i, rank) for i, rank in enumerate(pair) if rank >= 0]
        while True:
            for i, rank in new:
                bucket = buckets[rank]
                if bucket:
                    heappush(bucket, i)
                else:
                    bucket.append(i)
                    a = rank >> 6
                    word = low[a]
                    if not word:
                        top |= 1 << a
                    low[a] = word | 1 << (rank & 63)
            if not top:
                break
            first = top & -top  # find-first-set on each level
            a = first.bit_length() - 1
            word = low[a]
            bit = word & -word
            rank = (a << 6) + bit.bit_length() - 1
            bucket = buckets[rank]
            if len(bucket) > 1:
                i = heappop(bucket)
            else:
                i = bucket.pop()
                low[a] = word ^ bit
                if word == bit:
                    top ^= first
            new = []
            if pair[i] != rank:
                continue  # stale
            right = after[i]
            end = after[i] = after[right]
            pair[right] = pair[i] = -1
            if end < n:
                before[end] = i
                if (rank := get(data[i : after[end]], -1)) >= 0:
                    pair[i] = rank
                    new.append((i, rank))
            left = before[i]
            if left >= 0:
                rank = pair[left] = get(data[left:end], -1)
                if rank >= 0:
                    new.append((left, rank))
        ranks = self.ranks
        out, i = [], 0
        while i < n:
            out.append(ranks[data[i : after[i]]])
            i = after[i]
        return out

    def _ids(self, piece: str) -> bytes:
        """Ids of a piece of text, as 32-bit numbers."""
        out = []
        words = self.words
        for word in self.split.findall(piece):
            ids = words.get(word)
            if ids is None:
                ids = array("I", self.merge(word.encode("utf-8", "surrogatepass"))).tobytes()
                if len(word) <= _CACHE_CHARS:
                    words[word] = ids
            out.append(ids)
        return b"".join(out)

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text, each match of the pattern by itself.

        With the pattern of the rank file no match goes on over a single space that
        follows a letter, digit or sign, so texts without runs of white space are cut
        at spaces, and the ids of short pieces remembered.
        """
        if self.by_space and not _SPACES(text):
            first, *rest = text.split(" ")
            found = [first, *map(" ".__add__, rest)] if first else list(map(" ".__add__, rest))
        else:
            found = self.split.findall(text)
        known = self.known
        try:
            data = b"".join(map(known.__getitem__, found))
        except KeyError:
            if len(known) > _CACHE_WORDS:
                known.clear()
            if len(self.words) > _CACHE_TOKENS:
                self.words.clear()
            long: dict[str, bytes] = {}
            for word in set(found).difference(known):
                (known if len(word) <= _CACHE_CHARS else long)[word] = self._ids(word)
            data = b"".join([known[w] if w in known else long[w] for w in found])
        return np.frombuffer(data, np.uint32)

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of a sequence of ids; an id outside the vocabulary is an IndexError."""
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


#: One coder for each file and pattern in a Python worker, kept with its bounded memory over the tasks that it runs.
_OPENED: dict[tuple[str, str], ByteBPE] = {}


def _opened(path: str, pattern: str) -> ByteBPE:
    if (path, pattern) not in _OPENED:
        _OPENED[path, pattern] = ByteBPE(path, pattern)
    return _OPENED[path, pattern]


def _tokenizer(path: str | None, pattern: str | None) -> tuple[str, str]:
    import public_tokenizers

    return path or public_tokenizers.path("byte_bpe_50k.tiktoken"), pattern or public_tokenizers.PATTERN


def encode_documents(docs: DataFrame, path: str | None = None, pattern: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) for every row; null text counts as empty and has no ids."""
    path, pattern = _tokenizer(path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _opened(path, pattern)
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                ids = [bpe.encode(t.as_py() or "").astype(np.int32) for t in part.column("text")]
                ends = np.append(0, np.cumsum([len(x) for x in ids])).astype(np.int32)
                flat = np.concatenate(ids) if ids else np.empty(0, np.int32)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], ["doc_id", "ids"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """Adds ``decoded`` binary to rows with ids array<int>; null ids decode to null."""
    path, pattern = _tokenizer(path, None)
    schema = ", ".join(f"`{n}` {t}" for n, t in encoded.dtypes) + ", decoded binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _opened(path, pattern)
        for batch in batches:
            ids = batch.column("ids")
            values, ends = ids.values.to_numpy(zero_copy_only=False), ids.offsets.to_numpy()
            out = [None if not ok else bpe.decode(values[a:b]) for ok, a, b in zip(ids.is_valid().to_pylist(), ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], [*batch.schema.names, "decoded"])

    return encoded.mapInArrow(run, schema)


def bpe_digests(docs: DataFrame, path: str | None = None, pattern: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row: encoded and decoded again in one pass.

    Null text is empty: no tokens, digests of the empty string. Repeated rows each
    give a row, an empty table none; other columns are not read.
    """
    path, pattern = _tokenizer(path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _opened(path, pattern)
        decimal = [str(i) for i in range(len(bpe.tokens))]
        for batch in batches:
            n, ids_sha, out_sha = [], [], []
            for text in batch.column("text"):
                ids = bpe.encode(text.as_py() or "")
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(" ".join(map(decimal.__getitem__, ids.tolist())).encode()).hexdigest())
                out_sha.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(out_sha, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encodes and decodes the whole documents table."""
    return bpe_digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))
