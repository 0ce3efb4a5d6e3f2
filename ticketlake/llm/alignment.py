"""Alignment of two tokenizers over the same bytes, by products of sparse incidence matrices."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketlake.llm import bpe
from ticketlake.llm.common import arrow_batches, stored

# Characters that are aligned at once, nonzeros that a product expands at once, distinct id pairs a task adds up
# before it passes them on, and the most frequent id pairs that tasks hold.
BLOCK, EXPANDED, ADDED, HELD = 1 << 20, 1 << 20, 1 << 21, 1 << 19
MARK = "▁"


# ---------------------------------------------------------------- sparse matrices


class Rows:
    """A sparse matrix by rows: `start[i] : start[i + 1]` are the places of row i in `column` and `value`."""

    def __init__(self, start: np.ndarray, column: np.ndarray, value: np.ndarray, width: int):
        self.start, self.column, self.value, self.width = start, column, value, width

    def __len__(self) -> int:
        return len(self.start) - 1

    @classmethod
    def runs(cls, ends: np.ndarray) -> Rows:
        """Row i has ones in the columns from the end of row i - 1 up to its own: tokens over bytes, groups over
        tokens."""
        width = int(ends[-1]) if len(ends) else 0
        start = np.concatenate([np.zeros(1, np.int64), ends])
        return cls(start, np.arange(width, dtype=np.int32), np.ones(width, np.int32), width)

    def transposed(self) -> Rows:
        row = np.repeat(np.arange(len(self), dtype=np.int32), np.diff(self.start))
        value, start = self.value, np.zeros(self.width + 1, np.int64)
        np.cumsum(np.bincount(self.column, minlength=self.width), out=start[1:])
        if (self.column[1:] < self.column[:-1]).any():
            order = np.argsort(self.column, kind="stable")
            row, value = row[order], value[order]
        return Rows(start, row, value, len(self))

    def times(self, other: Rows) -> Rows:
        """Gustavson's product: row i is the sum of the rows of `other` that row i of this one names, each times the
        value that names it. Rows are taken in blocks of at most EXPANDED summands, or one by one."""
        sizes_of, width = np.diff(other.start), np.int64(max(other.width, 1))
        single = bool((sizes_of == 1).all())  # rows of one entry need no spreading
        weight = self.start if single else np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes_of[self.column])])[self.start]
        at, counts, columns, values = 0, [np.zeros(0, np.int64)], [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
        while at < len(self):
            to = max(at + 1, int(np.searchsorted(weight, weight[at] + EXPANDED, "right")) - 1)
            part = slice(self.start[at], self.start[to])
            named, value = self.column[part], self.value[part]
            code = np.repeat(np.arange(to - at) * width, np.diff(self.start[at : to + 1]))
            if single:
                place = named
            else:
                sizes = sizes_of[named]
                place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes - other.start[named], sizes)
                code, value = np.repeat(code, sizes), np.repeat(value, sizes)
            code = code + other.column[place]
            value = value * other.value[place]
            step = np.diff(code)
            if (step < 0).any():
                order = np.argsort(code, kind="stable")
                code, value = code[order], value[order]
                step = np.diff(code)
            new = np.concatenate([np.zeros(min(len(code), 1), np.int64), np.flatnonzero(step) + 1])
            row, column = np.divmod(code[new], width)
            columns.append(column.astype(np.int32))
            values.append(np.add.reduceat(value, new) if len(new) else value)
            counts.append(np.bincount(row, minlength=to - at))
            at = to
        start = np.concatenate([np.zeros(1, np.int64), np.cumsum(np.concatenate(counts))])
        return Rows(start, np.concatenate(columns), np.concatenate(values), other.width)


@dataclass
class Alignment:
    """Tokens of a run of bytes: `links` has a row an A token and a column a B token (the value: bytes shared);
    `a_of` and `b_of` have a row a group and a column a token."""

    links: Rows
    a_of: Rows
    b_of: Rows

    @classmethod
    def of(cls, a_ends: np.ndarray, b_ends: np.ndarray) -> Alignment:
        links = Rows.runs(a_ends).times(Rows.runs(b_ends).transposed())
        ends = np.intersect1d(a_ends, b_ends, assume_unique=True)
        a_of, b_of = (Rows.runs(np.searchsorted(x, ends) + 1) for x in (a_ends, b_ends))
        return cls(links, a_of, b_of)

    def shared_group_links(self) -> Rows:
        """All pairs of an A and a B token that share a group."""
        return self.a_of.transposed().times(self.b_of)


# ---------------------------------------------------------------- tokens


@dataclass
class Vocabularies:
    """What is broadcast: ids and bytes of tokenizer A, the file of B and the bytes of its tokens."""

    a_ids: list[int]
    a_bytes: list[bytes]
    b_model: bytes
    b_bytes: list[bytes]

    @classmethod
    def load(cls, a_path: str, b_path: str) -> Vocabularies:
        """A must number its tokens in the order of their merges, as then ids are ranks. Strings of special tokens are
        plain text."""
        tables = bpe.Tables.load(a_path)
        merged = tables.merged.tolist()
        if merged != sorted(set(merged)) or merged[0] <= tables.first.max():
            raise ValueError(f"the ids of {a_path} don't follow its merges")
        with open(b_path, "rb") as file:
            model = file.read()
        pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        names = [pieces.id_to_piece(i) for i in range(pieces.get_piece_size())]
        as_bytes = [
            bytes([int(name[3:5], 16)]) if pieces.is_byte(i) else name.replace(MARK, " ").encode()
            for i, name in enumerate(names)
        ]
        return cls([*tables.first.tolist(), *merged], tables.pieces, model, as_bytes)


class Encoders:
    """Both tokenizers of one task; texts come with their leading space."""

    def __init__(self, vocabularies: Vocabularies):
        a = vocabularies.a_bytes
        ranks = {a[i]: i for i in vocabularies.a_ids}
        self.a = tiktoken.Encoding("a", pat_str=bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=vocabularies.b_model)
        self.a_bytes, self.b_bytes = a.__getitem__, vocabularies.b_bytes.__getitem__

    def ids(self, text: str) -> tuple[bytes, bytes]:
        """Little-endian unsigned 32-bit ids; none where the text is empty or the bytes of either differ from it."""
        if text and MARK not in text:
            a, b, whole = self.a.encode_ordinary(" " + text), self.b.encode(text), f" {text}".encode()
            if b"".join(map(self.a_bytes, a)) == whole == b"".join(map(self.b_bytes, b)):
                return np.array(a, "<u4").tobytes(), np.array(b, "<u4").tobytes()
        return b"", b""


# ---------------------------------------------------------------- documents


_DECIMALS = 10 ** np.arange(9, -1, -1, dtype=np.int64)


def _spelled(numbers: np.ndarray, behind: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The decimal digits of each number and the byte behind it (0: none), side by side; and where each ends."""
    width = len(str(int(numbers.max()))) if len(numbers) else 1
    cells = np.empty((len(numbers), width + 1), np.uint8)
    cells[:, :width] = numbers[:, None] // _DECIMALS[-width:] % 10 + ord("0")
    cells[:, width] = behind
    show = np.empty(cells.shape, bool)
    show[:, : width - 1] = numbers[:, None] >= _DECIMALS[-width:-1]
    show[:, width - 1], show[:, width] = True, behind > 0
    return cells[show].tobytes(), np.cumsum(show.sum(1))


class Aligned:
    """A block of documents side by side."""

    def __init__(self, a_ids: list[bytes], b_ids: list[bytes], a_sizes: np.ndarray, b_sizes: np.ndarray, b_width: int):
        a, b = (np.frombuffer(b"".join(x), "<u4").astype(np.int64) for x in (a_ids, b_ids))
        a_doc, b_doc = (np.repeat(np.arange(len(x)), [len(i) // 4 for i in x]) for x in (a_ids, b_ids))
        self.n = len(a_ids)
        aligned = Alignment.of(np.cumsum(a_sizes[a]), np.cumsum(b_sizes[b]))
        links = aligned.links
        row = np.repeat(np.arange(len(links)), np.diff(links.start))
        self.link_doc, self.link_code = a_doc[row], a[row] * b_width + b[links.column]
        group_doc = a_doc[aligned.a_of.column[aligned.a_of.start[:-1]]]
        self.counts = [np.bincount(d, minlength=self.n) for d in (a_doc, b_doc, group_doc, self.link_doc)]
        self.texts = self._groups(aligned, a, b, group_doc)

    def _groups(self, aligned: Alignment, a: np.ndarray, b: np.ndarray, group_doc: np.ndarray) -> list[bytes]:
        """Per document `a1,a2|b1;a3|b2,b3`."""
        of_a, of_b = np.diff(aligned.a_of.start), np.diff(aligned.b_of.start)
        sizes = np.stack([of_a, of_b], 1).ravel()
        ends = np.cumsum(sizes)
        numbers, behind = np.empty(sizes.sum(), np.int64), np.full(sizes.sum(), ord(","), np.uint8)
        in_a = np.repeat(np.arange(len(sizes)) % 2 == 0, sizes)
        numbers[in_a], numbers[~in_a] = a[aligned.a_of.column], b[aligned.b_of.column]
        behind[ends[::2] - 1], behind[ends[1::2] - 1] = ord("|"), ord(";")
        last = np.flatnonzero(np.diff(group_doc, append=-1))  # a document's last group has nothing behind it
        behind[ends[1::2][last] - 1] = 0
        text, at = _spelled(numbers, behind)
        cuts, out = at[ends[1::2][last] - 1], [b""] * self.n
        for doc, start, end in zip(group_doc[last].tolist(), [0, *cuts[:-1].tolist()], cuts.tolist(), strict=True):
            out[doc] = text[start:end]
        return out

    def pairs(self) -> list[tuple[bytes, bytes]]:
        """Per document its distinct linked id pairs, as ascending codes, and how often each is linked."""
        order = np.lexsort((self.link_code, self.link_doc))
        doc, code = self.link_doc[order], self.link_code[order]
        new = np.flatnonzero(np.concatenate([np.ones(min(len(doc), 1), bool), (np.diff(doc) != 0) | (np.diff(code) != 0)]))
        times = np.diff(np.append(new, len(doc))).astype("<u4")
        codes, cuts = code[new].astype("<u4"), np.searchsorted(doc[new], np.arange(self.n + 1))
        return [(codes[s:e].tobytes(), times[s:e].tobytes()) for s, e in zip(cuts[:-1], cuts[1:], strict=True)]


def _blocks(texts: list[str]) -> Iterator[slice]:
    start, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= BLOCK:
            yield slice(start, i + 1)
            start, size = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


_COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def _aligned(shared):
    names = ["doc_id", *_COUNTS, "groups_sha256", "codes", "times"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabularies = shared.value
        encoders = Encoders(vocabularies)
        a_sizes, b_sizes = (np.array([len(x) for x in y], np.int64) for y in (vocabularies.a_bytes, vocabularies.b_bytes))
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for part in _blocks(texts):
                ids = zip(*map(encoders.ids, texts[part]), strict=True)
                block = Aligned(*ids, a_sizes, b_sizes, len(b_sizes))
                digests = [sha256(t).hexdigest() if t else "" for t in block.texts]
                codes, times = zip(*block.pairs(), strict=True)
                arrays = [batch.column("doc_id")[part.start : part.stop]]
                arrays += [pa.array(c, pa.int64()) for c in block.counts]
                arrays += [pa.array(digests, pa.string()), pa.array(codes, pa.binary()), pa.array(times, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return run


# ---------------------------------------------------------------- counts over all documents


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each id pair in a task, added up as long as the distinct pairs fit."""

    def out(codes: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(codes), 1 << 17):
            part = slice(at, at + (1 << 17))
            yield pa.RecordBatch.from_arrays([pa.array(codes[part], pa.int64()), pa.array(counts[part], pa.int64())], names=["code", "docs"])

    codes, counts, waiting, held = np.zeros(0, np.int64), np.zeros(0, np.int64), [], 0

    def merged() -> tuple[np.ndarray, np.ndarray]:
        all_codes = np.concatenate([codes, *waiting]) if waiting else codes
        distinct, at = np.unique(all_codes, return_inverse=True)
        weights = np.concatenate([counts, np.ones(len(all_codes) - len(codes), np.int64)])
        return distinct, np.bincount(at, weights=weights, minlength=len(distinct)).astype(np.int64)

    for batch in batches:
        for row in batch.column("codes").to_pylist():
            waiting.append(np.frombuffer(row, "<u4").astype(np.int64))
            held += len(waiting[-1])
            if held >= ADDED:
                (codes, counts), waiting, held = merged(), [], 0
                if len(codes) >= ADDED:
                    yield from out(codes, counts)
                    codes, counts = codes[:0], counts[:0]
    yield from out(*merged())


def _summed(shared):
    """Sums over the links whose pair the task holds, and the other pairs with how often they are linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, docs, best = shared.value
        for batch in batches:
            sums, bests, rest, rest_times = [], [], [], []
            for codes, times in zip(batch.column("codes").to_pylist(), batch.column("times").to_pylist(), strict=True):
                code, n = np.frombuffer(codes, "<u4").astype(np.int64), np.frombuffer(times, "<u4").astype(np.int64)
                at = np.minimum(np.searchsorted(held, code), max(len(held) - 1, 0))
                known = held[at] == code if len(held) else np.zeros(len(code), bool)
                sums.append(int((docs[at[known]] * n[known]).sum()))
                bests.append(int(n[known][best[at[known]]].sum()))
                rest.append(code[~known].tolist())
                rest_times.append(n[~known].tolist())
            more = [pa.array(sums, pa.int64()), pa.array(bests, pa.int64())]
            more += [pa.array(x, pa.list_(pa.int64())) for x in (rest, rest_times)]
            names = ["row", "doc_id", *_COUNTS, "groups_sha256"]
            arrays = [batch.column(c) for c in names] + more
            yield pa.RecordBatch.from_arrays(arrays, names=[*names, "held_sum", "held_best", "codes", "times"])

    return run


def vocabularies(spark: SparkSession, a_path: str, b_path: str):
    """The broadcast tables of both tokenizer files, which the driver reads."""
    return spark.sparkContext.broadcast(Vocabularies.load(a_path, b_path))


def align(docs: DataFrame, shared, id_col: str = "doc_id", text_col: str = "text", held: int = HELD) -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Each text is encoded behind a space by a byte-level tokenizer (A) and a piece tokenizer (B); strings of special
    tokens are plain text. Token-byte incidence matrices, by rows, give the links as A times B transposed: pairs
    of tokens that share bytes. Offsets where tokens of both end cut the bytes into groups, and the products of
    group-byte and token-byte incidence give the tokens of each group. An id pair counts the rows (documents) that
    hold it linked, over all of them; `count_sum` adds the counts of a row's links, `n_best` counts links whose
    count is the highest of their A id.

    Null and empty texts, and such whose tokens don't spell the text (a U+2581 in it), have zeros and an empty
    digest. Every row is a document of its own, also one that is repeated or shares its id. Texts are whole whatever
    their length: one long text is a block of its own and its products are formed in parts. An empty table
    gives an empty result; other columns are ignored.

    Tasks add up pairs before they are shuffled. The `held` most frequent pairs are broadcast; the others of each
    row are looked up in the stored counts. The highest count an A id is one number an id of the vocabulary.
    """
    spark = docs.sparkSession
    arrow_batches(spark)
    b_width = len(shared.value.b_bytes)
    if len(shared.value.a_bytes) * b_width > 2**32:
        raise ValueError("the vocabularies have more id pairs than 32 bits tell apart")
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    columns = ", ".join(f"{c} long" for c in _COUNTS)
    aligned = plain.mapInArrow(_aligned(shared), f"doc_id long, {columns}, groups_sha256 string, codes binary, times binary")
    aligned = stored(aligned.withColumn("row", F.monotonically_increasing_id()), "alignment")

    counts = aligned.select("codes").mapInArrow(_added, "code long, docs long")
    counts = stored(counts.groupBy("code").agg(F.sum("docs").alias("docs")), "alignment-counts")
    # one row an A id at most
    top = counts.groupBy(F.floor(F.col("code") / b_width).alias("a")).agg(F.max("docs").alias("top"))
    counts = counts.withColumn("a", F.floor(F.col("code") / b_width)).join(F.broadcast(top), "a")
    counts = counts.select("code", "docs", (F.col("docs") == F.col("top")).alias("best"))
    frequent = counts.orderBy(F.col("docs").desc(), "code").limit(held).toArrow().sort_by("code")
    shown = spark.sparkContext.broadcast(tuple(frequent.column(c).to_numpy() for c in ("code", "docs", "best")))

    out = f"row long, doc_id long, {columns}, groups_sha256 string, held_sum long, held_best long, codes array<long>, times array<long>"
    summed = stored(aligned.mapInArrow(_summed(shown), out), "alignment-summed")
    rare = summed.select("row", F.explode(F.arrays_zip("codes", "times")).alias("p")).select(
        "row", F.col("p.codes").alias("code"), F.col("p.times").alias("times")
    )
    rare = rare.join(counts, "code").groupBy("row").agg(
        F.sum(F.col("docs") * F.col("times")).alias("rare_sum"), F.sum(F.when(F.col("best"), F.col("times"))).alias("rare_best")
    )
    both = lambda a, b: (F.col(a) + F.coalesce(F.col(b), F.lit(0))).cast("long")
    return summed.join(rare, "row", "left").select(
        "doc_id", *_COUNTS, both("held_best", "rare_best").alias("n_best"), both("held_sum", "rare_sum").alias("count_sum"), "groups_sha256"
    )
