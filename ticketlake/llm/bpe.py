"""Byte-level BPE: whole texts to token ids and back, with the tables of a tokenizer file."""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketlake.llm.common import arrow_batches

# Fixed value: what the tokenizer's byte-level step calls one word.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Text a task encodes at once, and words it remembers at most.
_BLOCK_BYTES, _HELD_WORDS = 8 << 20, 300_000
_NONE = np.iinfo(np.int64).max


def byte_names() -> list[str]:
    """The character that stands for each byte: itself where it prints, else the next free one from 256."""
    prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in prints else chr(next(spare)) for b in range(256)]


@dataclass
class Tables:
    """What is broadcast of a tokenizer file; its size is that of the vocabulary."""

    first: np.ndarray  # id of each byte
    pairs: np.ndarray  # sorted: left id << 32 | right id
    ranks: np.ndarray  # rank of each pair
    left: np.ndarray  # by rank
    right: np.ndarray
    merged: np.ndarray
    pieces: list[bytes]  # bytes of each id
    special: dict[str, int]

    @classmethod
    def load(cls, path: str) -> Tables:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab, added = spec["model"]["vocab"], {x["content"]: x["id"] for x in spec["added_tokens"]}
        names = byte_names()
        byte_of = {name: b for b, name in enumerate(names)}
        merges = [x.split(" ") if isinstance(x, str) else x for x in spec["model"]["merges"]]
        left, right = (np.array([vocab[m[side]] for m in merges], np.int64) for side in (0, 1))
        merged = np.array([vocab[a + b] for a, b in merges], np.int64)
        pairs = left << 32 | right
        order = np.argsort(pairs)
        pieces = [b""] * (max([*vocab.values(), *added.values()]) + 1)
        for token, i in vocab.items():
            pieces[i] = token.encode() if token in added else bytes(byte_of[c] for c in token)
        for token, i in added.items():
            pieces[i] = token.encode()
        first = np.array([vocab[x] for x in names], np.int64)
        return cls(first, pairs[order], order.astype(np.int64), left, right, merged, pieces, added)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each adjacent pair; _NONE for one that never merges."""
        code = left << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, code), len(self.pairs) - 1)
        return np.where((left >= 0) & (right >= 0) & (self.pairs[at] == code), self.ranks[at], _NONE)


class PairIndex:
    """All positions of every mergeable pair in a run of words; ranks are applied in ascending order."""

    def __init__(self, tables: Tables, words: list[bytes]):
        self.tables = tables
        raw = np.frombuffer(b"".join(words), np.uint8)
        lengths = np.array([len(x) for x in words], np.int64)
        # a gap in front of each word and one behind the last: pairs never cross words
        self.starts = np.concatenate([[0], np.cumsum(lengths + 1)])
        self.symbol = np.full(self.starts[-1] + 1, -1, np.int64)
        inside = np.ones(len(self.symbol), bool)
        inside[self.starts] = False
        self.symbol[inside] = tables.first[raw]
        self.next = np.arange(1, len(self.symbol) + 1)
        self.previous = np.arange(-1, len(self.symbol) - 1)
        self.positions: dict[int, list[np.ndarray]] = {}
        self.active: list[int] = []
        self._add(np.flatnonzero(inside))

    def _add(self, at: np.ndarray) -> None:
        """List positions under the rank of the pair that begins there now."""
        ranks = self.tables.rank_of(self.symbol[at], self.symbol[self.next[at]])
        some = ranks != _NONE
        at, ranks = at[some], ranks[some]
        if not len(at):
            return
        order = np.argsort(ranks, kind="stable")
        at, ranks = at[order], ranks[order]
        cuts = np.flatnonzero(np.diff(ranks)) + 1
        for rank, part in zip(ranks[np.concatenate([[0], cuts])].tolist(), np.split(at, cuts), strict=True):
            if rank in self.positions:
                self.positions[rank].append(part)
            else:
                self.positions[rank] = [part]
                heappush(self.active, rank)

    def merge(self) -> list[np.ndarray]:
        """Token ids of each word."""
        heapify(self.active)
        while self.active:
            rank = heappop(self.active)
            self._apply(rank, np.unique(np.concatenate(self.positions.pop(rank))))
        alive = self.symbol >= 0
        count = np.concatenate([[0], np.cumsum(alive)])
        return np.split(self.symbol[alive], count[self.starts[1:-1]])

    def _apply(self, rank: int, at: np.ndarray) -> None:
        left, right, symbol, after = self.tables.left[rank], self.tables.right[rank], self.symbol, self.next
        at = at[(symbol[at] == left) & (symbol[after[at]] == right)]
        if left == right and len(at) > 1:  # of a run of one symbol every other pair merges, from its start
            joined = np.concatenate([[False], after[at[:-1]] == at[1:]])
            run_start = np.maximum.accumulate(np.where(joined, 0, np.arange(len(at))))
            at = at[(np.arange(len(at)) - run_start) % 2 == 0]
        if not len(at):
            return
        gone = after[at]
        symbol[at], symbol[gone] = self.tables.merged[rank], -2
        after[at] = after[gone]
        self.previous[after[at]] = at
        before = self.previous[at]
        self._add(np.unique(np.concatenate([before[symbol[before] >= 0], at])))


class Encoder:
    """Encodes texts of one task; ids of a word are found once and remembered."""

    def __init__(self, tables: Tables):
        self.tables, self.known = tables, {}
        self.words = regex.compile(PATTERN).findall
        special = "|".join(regex.escape(x) for x in sorted(tables.special, key=len, reverse=True))
        self.special = regex.compile(f"({special})") if special else None

    def split(self, text: str) -> list[str]:
        if self.special is None or not any(x in text for x in self.tables.special):
            return self.words(text)
        out: list[str] = []
        for part in self.special.split(text):
            out += [part] if part in self.tables.special else self.words(part)
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        split = [self.split(x) for x in texts]
        if len(self.known) > _HELD_WORDS:
            self.known = {}
        known = self.known
        new = list(set().union(*split).difference(known))
        if new:
            for word, ids in zip(new, PairIndex(self.tables, [x.encode() for x in new]).merge(), strict=True):
                known[word] = ids.astype("<u4").tobytes()
            for word, i in self.tables.special.items():
                if word in known:
                    known[word] = np.array([i], "<u4").tobytes()
        return [b"".join([known[x] for x in words]) for words in split]


def _blocks(texts: list[str]) -> Iterator[list[str]]:
    block, size = [], 0
    for text in texts:
        block.append(text)
        size += len(text)
        if size >= _BLOCK_BYTES:
            yield block
            block, size = [], 0
    if block:
        yield block


def _encoded(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for batch in batches:
            texts = [x or "" for x in batch.column(_IN).to_pylist()]
            ids = [x for block in _blocks(texts) for x in encoder.encode(block)]
            yield _replaced(batch, pa.array(ids, pa.binary()))

    return run


def _decoded(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = shared.value.pieces
        for batch in batches:
            texts = []
            for ids in batch.column(_IN).to_pylist():
                numbers = np.frombuffer(ids or b"", "<u4")
                known = numbers[numbers < len(pieces)].tolist()
                texts.append(b"".join([pieces[i] for i in known]).decode("utf-8", "replace"))
            yield _replaced(batch, pa.array(texts, pa.string()))

    return run


_IN, _OUT = "bpe_input", "bpe_output"


def _replaced(batch: pa.RecordBatch, new: pa.Array) -> pa.RecordBatch:
    """The row and the new value; what was read needn't go back."""
    return pa.RecordBatch.from_arrays([batch.column("row"), new], names=["row", _OUT])


def _through(df: DataFrame, function, source: str, target: str, kind: T.DataType) -> DataFrame:
    others = [df[c] for c in df.columns if c not in (source, target)]
    held = df.select(F.struct(*others or [F.lit(0).alias("none")]).alias("row"), F.col(source).alias(_IN))
    schema = T.StructType([held.schema["row"], T.StructField(_OUT, kind)])
    out = held.mapInArrow(function, schema)
    return out.select(*(F.col("row")[c].alias(c) for c in df.columns if c not in (source, target)), F.col(_OUT).alias(target))


def tables(spark: SparkSession, path: str):
    """The broadcast tables of a tokenizer file that the driver reads."""
    return spark.sparkContext.broadcast(Tables.load(path))


def encode(docs: DataFrame, shared, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """docs with the text replaced by its token ids: binary, little-endian unsigned 32-bit integers.

    The text is split into words; words of a block of texts are put side by side, every mergeable pair is
    listed with all its positions, and ranks are applied from the lowest, which updates the lists of the pairs
    beside each merge. Strings of special tokens become these tokens; none are added. A null or
    empty text has no ids. A column of the input named like the ids is replaced; others stay.
    """
    arrow_batches(docs.sparkSession)
    return _through(docs, _encoded(shared), text_col, ids_col, T.BinaryType())


def decode(docs: DataFrame, shared, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """docs with the ids replaced by their text; special tokens show, ids outside the vocabulary don't.

    Bytes that aren't UTF-8 become U+FFFD. Null ids give the empty text.
    """
    arrow_batches(docs.sparkSession)
    return _through(docs, _decoded(shared), ids_col, text_col, T.StringType())
