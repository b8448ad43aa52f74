"""Cross-tokenizer alignment by diagonal run skipping.

Two tokenizers cut the same bytes. Their arrays of token ends are walked together:
while both ends agree at the current index shift, exponential probing compares
longer and longer stretches and jumps over the one-to-one run; where they differ,
the token that ends first is followed by the next of its side until both ends meet,
which gives one irregular group and a new shift. Every step of the walk is one
overlap of an A and a B token.

How often an id pair is linked is a count over the corpus. A task cuts its
documents into blocks of bounded size and gives each block's pairs once; the
counts come back to the blocks by a join on the pair, so that neither the counts
nor a document's pairs are broadcast.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadloom.llm.common import stored

#: A block of documents is closed once it has so many characters; so many of its words are aligned at a time and tokenized in one text.
BLOCK_CHARS, SLICE, TOGETHER = 16_000_000, 20_000, 500
#: Places before a space at which neither tokenizer lets a token go on.
_CUT = re.compile(r"(?<! )(?= \S)")
_SPACES = re.compile(r"\s\s|^\s|\s$").search


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: printable Latin-1 for itself, the rest from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class ByteLevelTokens:
    """A byte-level BPE file of the tokenizers library; words are encoded with the space before them."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        letters = _byte_letters()
        with open(path, encoding="utf-8") as f:
            described = json.load(f)
        vocab = described["model"]["vocab"]
        special = {t["content"]: t["id"] for t in described["added_tokens"]}
        self.tokens = [b""] * (1 + max([*vocab.values(), *special.values()]))
        for token, i in vocab.items():
            self.tokens[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        for token, i in special.items():
            self.tokens[i] = token.encode()

    def encode(self, words: list[str]) -> list[list[int]]:
        return [e.ids for e in self.model.encode_batch([" " + w for w in words], add_special_tokens=False)]


class PieceTokens:
    """A sentencepiece model that puts a space before a text by itself."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.tokens = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]

    def encode(self, words: list[str]) -> list[list[int]]:
        return self.model.encode(words, num_threads=1)


def open_tokens(path: str) -> ByteLevelTokens | PieceTokens:
    return PieceTokens(path) if path.endswith(".model") else ByteLevelTokens(path)


@dataclass
class Alignment:
    """Ends of groups as token indices of A and B, and for each overlap of two tokens their indices, in order."""

    group_a: list[int] = field(default_factory=list)
    group_b: list[int] = field(default_factory=list)
    link_a: list[int] = field(default_factory=list)
    link_b: list[int] = field(default_factory=list)


def align_ends(ends_a: list[int], ends_b: list[int]) -> Alignment:
    """Groups and links of two ascending lists of byte ends that close with the same end."""
    out = Alignment()
    i, j, n = 0, 0, len(ends_a)
    group_a, group_b, link_a, link_b = out.group_a, out.group_b, out.link_a, out.link_b
    while i < n:
        x, y = ends_a[i], ends_b[j]
        if x == y:
            # probe at the shift j - i with doubled lengths, then halve into the probe that failed
            run, w = 1, 1
            while i + run < n and ends_a[i + run : i + run + w] == ends_b[j + run : j + run + w]:
                run += w
                w *= 2
            run = min(run, n - i)
            while w > 1 and i + run < n:
                w //= 2
                if ends_a[i + run : i + run + w] == ends_b[j + run : j + run + w]:
                    run = min(run + w, n - i)
            link_a.extend(range(i, i + run))
            link_b.extend(range(j, j + run))
            group_a.extend(range(i + 1, i + run + 1))
            group_b.extend(range(j + 1, j + run + 1))
            i += run
            j += run
            continue
        while x != y:
            link_a.append(i)
            link_b.append(j)
            if x < y:
                i += 1
                x = ends_a[i]
            else:
                j += 1
                y = ends_b[j]
        link_a.append(i)
        link_b.append(j)
        i += 1
        j += 1
        group_a.append(i)
        group_b.append(j)
    return out


class Words(NamedTuple):
    """Aligned words in an order of their own: what each adds to a text that holds it."""

    place: np.ndarray  # of each word given, -1 where a tokenizer does not give its bytes back
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    codes: np.ndarray  # of the links of all words, A's id times B's size plus B's id
    groups: list[str]


class Aligner:
    """Tokenizes texts with both files and aligns them.

    Neither tokenizer lets a token cross a single space before a word, so the
    different words of many texts are aligned once, together, as one text.
    """

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = open_tokens(path_a), open_tokens(path_b)
        self.size_b = len(self.b.tokens)
        self.width_a = np.array([len(t) for t in self.a.tokens])
        self.width_b = np.array([len(t) for t in self.b.tokens])
        self.decimal = [str(i) for i in range(max(len(self.a.tokens), self.size_b))]

    def _same(self, text: str, ids_a: list[int], ids_b: list[int]) -> bool:
        """Whether both sides' bytes are those of a space and the text."""
        data = b" " + text.encode()
        return data == b"".join(map(self.a.tokens.__getitem__, ids_a)) and data == b"".join(map(self.b.tokens.__getitem__, ids_b))

    def tokenize(self, text: str) -> tuple[list[int], list[int]] | None:
        """Ids by A of a space and the text, and by B of the text; None if a side's bytes are not those of the space and text."""
        if not text:
            return None
        (ids_a,), (ids_b,) = self.a.encode([text]), self.b.encode([text])
        return (ids_a, ids_b) if self._same(text, ids_a, ids_b) else None

    def align(self, ids_a: list[int], ids_b: list[int]) -> Alignment:
        return align_ends(np.cumsum(self.width_a[ids_a]).tolist(), np.cumsum(self.width_b[ids_b]).tolist())

    def _groups(self, ids_a: list[int], ids_b: list[int], found: Alignment) -> list[str]:
        """Ids of each group as ``a1,a2|b1``."""
        text = self.decimal.__getitem__
        a, b = list(map(text, ids_a)), list(map(text, ids_b))
        out, i, j = [], 0, 0
        for p, q in zip(found.group_a, found.group_b, strict=True):
            out.append(f"{a[i]}|{b[j]}" if p - i == 1 == q - j else f"{','.join(a[i:p])}|{','.join(b[j:q])}")
            i, j = p, q
        return out

    def _encoded(self, words: list[str]) -> tuple[list[int], list[int], list[int]]:
        """Indices of the words that both sides give back, in the order taken, and the ids of these words."""
        # a word that starts or ends with a space, or starts with white space, would be cut otherwise beside others
        odd = [k for k, w in enumerate(words) if w[:1].isspace() or w[-1:] in ("", " ")]
        alone = set(odd)
        plain = [k for k in range(len(words)) if k not in alone] if odd else list(range(len(words)))
        queue = [plain[i : i + TOGETHER] for i in range(0, len(plain), TOGETHER)] + [[k] for k in odd]
        order: list[int] = []
        ids_a: list[int] = []
        ids_b: list[int] = []
        while queue:
            texts = [" ".join([words[k] for k in group]) for group in queue]
            failed = []
            for group, text, a, b in zip(queue, texts, self.a.encode(texts), self.b.encode(texts), strict=True):
                if self._same(text, a, b):
                    order += group
                    ids_a += a
                    ids_b += b
                elif len(group) > 1:
                    failed += [[k] for k in group]
            queue = failed
        return order, ids_a, ids_b

    def align_words(self, words: list[str]) -> Words:
        """The words aligned, SLICE of them at a time."""
        slices = [self._align_slice(words[i : i + SLICE]) for i in range(0, max(len(words), 1), SLICE)]
        base = np.append(0, np.cumsum([len(s.groups) for s in slices]))
        place = np.concatenate([np.where(s.place < 0, -1, s.place + k) for s, k in zip(slices, base[:-1], strict=True)])
        return Words(place, *(np.concatenate(x) for x in list(zip(*slices, strict=True))[1:6]), [g for s in slices for g in s.groups])

    def _align_slice(self, words: list[str]) -> Words:
        order, ids_a, ids_b = self._encoded(words)
        place = np.full(len(words), -1)
        place[order] = np.arange(len(order))
        found = self.align(ids_a, ids_b)
        a, b = np.array(ids_a, np.int64), np.array(ids_b, np.int64)
        ends_a, ends_b = np.cumsum(self.width_a[a]), np.cumsum(self.width_b[b])
        link_a, link_b = np.array(found.link_a, np.int64), np.array(found.link_b, np.int64)
        ends = np.cumsum([1 + len(words[k].encode()) for k in order])
        group_ends = ends_a[np.array(found.group_a, np.int64) - 1]
        cuts = [np.append(0, np.searchsorted(x, ends, "right")) for x in (ends_a, ends_b, group_ends, np.minimum(ends_a[link_a], ends_b[link_b]))]
        groups, at = self._groups(ids_a, ids_b, found), cuts[2].tolist()
        return Words(place, *map(np.diff, cuts), a[link_a] * self.size_b + b[link_b], [";".join(groups[i:j]) for i, j in itertools.pairwise(at)])


def words_of(text: str) -> list[str]:
    """Words that give the text when each has a space before it, but for the text's first space; no token crosses from word to word."""
    return [w[1:] for w in _CUT.split(" " + text) if w] if _SPACES(text) else text.split(" ") if text else []


@functools.lru_cache(maxsize=1)
def _aligner(path_a: str, path_b: str) -> Aligner:
    """One for a Python worker, as files are slow to open."""
    return Aligner(path_a, path_b)


def _paths(path_a: str | None, path_b: str | None) -> tuple[str, str]:
    if path_a is None or path_b is None:
        import public_tokenizers

        path_a, path_b = path_a or public_tokenizers.path("byte_bpe_50k.json"), path_b or public_tokenizers.path("piece_bpe_32k.model")
    return path_a, path_b


def token_alignment(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids_a, ids_b and groups, an array of (a_end, b_end): how many tokens of each side the groups up to this one hold.

    Texts that are null or empty, or that a tokenizer does not give back byte by byte, have empty arrays.
    Repeated rows each give a row; other columns are not read.
    """
    path_a, path_b = _paths(path_a, path_b)
    group = pa.list_(pa.struct([("a_end", pa.int32()), ("b_end", pa.int32())]))
    schema = pa.schema([("doc_id", pa.int64()), ("ids_a", pa.list_(pa.int32())), ("ids_b", pa.list_(pa.int32())), ("groups", group)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(path_a, path_b)
        for batch in batches:
            for i in range(0, batch.num_rows, 100):
                part = batch.slice(i, 100)
                rows = [aligner.tokenize(t or "") or ([], []) for t in part.column("text").to_pylist()]
                found = [aligner.align(*g) for g in rows]
                groups = [[{"a_end": p, "b_end": q} for p, q in zip(f.group_a, f.group_b, strict=True)] for f in found]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([a for a, _ in rows], schema.types[1]), pa.array([b for _, b in rows], schema.types[2]), pa.array(groups, group)], schema=schema)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids_a array<int>, ids_b array<int>, groups array<struct<a_end: int, b_end: int>>")


_FACTS = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
_COUNTS = ("n_a", "n_b", "n_groups", "n_links")
#: ``kind`` of a row: a document with the numbers of its words; a block's words with their lengths and codes; its pairs and how often they are linked.
_DOC, _WORDS, _PAIRS = 0, 1, 2
_ALIGNED = pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("doc_id", pa.int64()), *((n, pa.int64()) for n in _COUNTS), ("groups_sha256", pa.string()), ("words", pa.list_(pa.int32())), ("codes", pa.list_(pa.int64())), ("times", pa.list_(pa.int64()))])


class _Numbers(dict):
    """Numbers words in the order they come."""

    def __missing__(self, word: str) -> int:
        self[word] = len(self)
        return len(self) - 1


class _Block:
    """Documents that stand together, as numbers of their words."""

    def __init__(self, number: int):
        self.number, self.index, self.docs, self.chars = number, _Numbers(), [], 0

    def add(self, doc_id: int | None, text: str) -> None:
        words = words_of(text)
        self.docs.append((doc_id, np.fromiter(map(self.index.__getitem__, words), np.int32, len(words))))
        self.chars += len(text)

    def close(self, aligner: Aligner) -> Iterator[pa.RecordBatch]:
        """Rows of the documents, of the block's words and of its pairs."""
        if not self.docs:
            return
        words = aligner.align_words(list(self.index))
        ids = [d for d, _ in self.docs]
        numbers = [words.place[k] for _, k in self.docs]
        numbers = [k if len(k) and k.min() >= 0 else k[:0] for k in numbers]
        flat, n = np.concatenate(numbers).astype(np.int32), len(ids)
        ends = np.append(0, np.cumsum([len(k) for k in numbers]))
        facts = [np.diff(np.append(0, np.cumsum(x[flat]))[ends]) for x in (words.n_a, words.n_b, words.n_groups, words.n_links)]
        group = words.groups.__getitem__
        digests = [hashlib.sha256(";".join(map(group, k.tolist())).encode()).hexdigest() if len(k) else "" for k in numbers]
        pairs, place = np.unique(words.codes, return_inverse=True)
        times = np.zeros(len(pairs), np.int64)
        np.add.at(times, place, np.repeat(np.bincount(flat, minlength=len(words.groups)), words.n_links))
        none = [[] for _ in ids]
        columns = [[self.number] * n, [_DOC] * n, ids, *facts, digests, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32())), none, none]
        yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, _ALIGNED.types, strict=True)], schema=_ALIGNED)
        for kind, three in ((_WORDS, (words.n_links, words.codes, [])), (_PAIRS, ([], pairs, times))):
            columns = [self.number, kind, *[None] * 6, *three]
            yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(columns, _ALIGNED.types, strict=True)], schema=_ALIGNED)


def _aligned(path_a: str, path_b: str):
    """Blocks of the documents of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(path_a, path_b)
        block = _Block(TaskContext.get().partitionId() << 32)
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                block.add(doc_id, text.as_py() or "")
                if block.chars >= BLOCK_CHARS:
                    yield from block.close(aligner)
                    block = _Block(block.number + 1)
        yield from block.close(aligner)

    return run


def _with_counts(key, rows: pa.Table, counts: pa.Table) -> pa.Table:
    """Sums over the links of a block's documents, from the counts of the block's pairs."""
    kind = rows.column("kind").to_numpy()
    docs = rows.filter(pa.array(kind == _DOC))
    words = rows.filter(pa.array(kind == _WORDS))
    order = np.argsort(counts.column("code").to_numpy())
    known, total, best = (counts.column(n).to_numpy()[order] for n in ("code", "total", "best"))
    lengths, codes = (words.column(n).combine_chunks().flatten().to_numpy() for n in ("words", "codes"))
    lists = docs.column("words").combine_chunks()
    numbers = lists.flatten().to_numpy()
    ends = np.append(0, np.cumsum(lists.value_lengths().to_numpy()))
    word_ends = np.append(0, np.cumsum(lengths))
    place = np.searchsorted(known, codes)

    def sums(x: np.ndarray) -> pa.Array:
        of_links = np.append(0, np.cumsum(x[place]))
        of_words = np.append(0, np.cumsum(np.diff(of_links[word_ends])[numbers]))
        return pa.array(np.diff(of_words[ends]), pa.int64())

    return docs.drop_columns(["own", "kind", "words", "codes"]).append_column("n_best", sums(best)).append_column("count_sum", sums(total))


def alignment_digests(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row.

    Texts that are null or empty, or that a tokenizer does not give back byte by byte
    (those with U+2581), have no tokens: zeros and ''. Rows repeated and rows with a
    null id each give a row and count like others; an empty table gives none; other
    columns are not read.
    """
    path_a, path_b = _paths(path_a, path_b)
    size_b = len(open_tokens(path_b).tokens)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    aligned = stored(rows.mapInArrow(_aligned(path_a, path_b), f"block long, kind int, doc_id long, {_FACTS}, words array<int>, codes array<long>, times array<long>"))
    # a pair stands once in each block that holds it
    local = aligned.filter(F.col("kind") == _PAIRS).select("block", F.explode(F.arrays_zip("codes", "times")).alias("p")).select("block", F.col("p.codes").alias("code"), F.col("p.times").alias("times"))
    counts = stored(local.groupBy("code").agg(F.sum("times").alias("total")).withColumn("b", F.col("code") % size_b))
    best = counts.groupBy("b").agg(F.max("total").alias("most"))
    counts = stored(counts.join(best, "b").select("code", "total", (F.col("total") == F.col("most")).cast("long").alias("best")))
    back = local.select("block", "code").join(counts, "code")
    facts = aligned.filter(F.col("kind") != _PAIRS).select(F.col("block").alias("own"), "kind", "doc_id", *_COUNTS, "groups_sha256", "words", "codes")
    out = facts.groupBy("own").cogroup(back.groupBy("block")).applyInArrow(_with_counts, f"doc_id long, {_FACTS}, n_best long, count_sum long")
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment of two tokenizers over the whole documents table."""
    return alignment_digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))
