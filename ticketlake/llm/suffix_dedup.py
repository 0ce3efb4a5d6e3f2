"""Suffix-array dedup: bytes covered by a string of fixed length that also starts earlier in the corpus."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketlake.llm.common import NO_ID, arrow_batches, stored
from ticketlake.llm.suffix_sort import deep_shallow

LENGTH = 100
# Rows and bytes of a block at most (neighbours in their file, a single longer text is a block of its own); anchors of
# a bucket on average; occurrences from which an anchor's strings are dealt one by one; bytes handled at once.
BLOCK_ROWS, BLOCK_BYTES, BUCKET_ANCHORS, HOT, PIECE = 1024, 16 << 20, 200_000, 1000, 1 << 20

_SEEN = np.dtype([("hash", "<u8"), ("block", "<u4"), ("n", "u1")])
_SPAN = np.dtype([("hash", "<u8"), ("doc", "<i8"), ("digest", "<i8"), ("at", "<i8"), ("n", "<u2"), ("off", "<u2")])
_WINDOW = np.dtype([("high", "<u8"), ("low", "<u8"), ("doc", "<i8"), ("digest", "<i8"), ("at", "<i8")])
_RANGE = np.dtype([("doc", "<i8"), ("digest", "<i8"), ("at", "<i8"), ("n", "<i4")])


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xA24BAED4963EE407)
    return h ^ (h >> np.uint64(29))


class Anchors:
    """Content-chosen anchors: every string of `length` bytes has one, at the same offset in every copy.

    The anchor of a string is its k-gram of smallest hash (the first of equal ones). Neighbouring strings
    share anchors, so strings come in runs; equal strings are looked for among runs with equal k-grams.
    """

    def __init__(self, length: int):
        self.length, self.k = length, 1
        while self.k * 2 <= min(32, length // 3):
            self.k *= 2

    def runs(self, data: bytes, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(first start, number of starts, anchor, k-gram hash) of each run; strings stay inside the texts
        that end at `ends`."""
        b = np.frombuffer(data, np.uint8)
        none = np.zeros(0, np.int64)
        if len(b) < self.length:
            return none, none, none, np.zeros(0, np.uint64)
        gram, width, power = (b.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15), 1, 0xD6E8FEB86659FD93
        while width < self.k:
            gram = gram[:-width] * np.uint64(power) + gram[width:]
            width, power = width * 2, power * power % 2**64
        gram = _mix(gram)
        low = np.uint64((1 << 21) - 1)
        best = (gram & ~low) | np.arange(len(gram), dtype=np.uint64)
        wanted, width = self.length - self.k + 1, 1
        while width * 2 <= wanted:
            best, width = np.minimum(best[:-width], best[width:]), width * 2
        if width < wanted:
            best = np.minimum(best[: len(best) - (wanted - width)], best[wanted - width :])
        anchor = (best & low).astype(np.int64)
        text_of = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
        starts = np.flatnonzero(text_of[: len(anchor)] == text_of[self.length - 1 :][: len(anchor)])
        if not len(starts):
            return none, none, none, np.zeros(0, np.uint64)
        anchor = anchor[starts]
        new = np.flatnonzero((anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)) + 1
        first = np.concatenate([[0], new])
        return starts[first], np.diff(np.concatenate([first, [len(starts)]])), anchor[first], gram[anchor[first]]

    def pieces(self, texts: list[bytes]) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, np.ndarray]]:
        """(data, ends, number of the text, its offset there) of texts joined up to PIECE bytes; longer texts are
        cut with an overlap, so that every string starts in exactly one piece."""
        held: list[tuple[bytes, int, int]] = []
        size = 0
        for number, text in enumerate(texts):
            for at in range(0, max(len(text) - self.length + 1, 0), PIECE):
                part = text[at : at + PIECE + self.length - 1]
                if held and size + len(part) > PIECE + self.length:
                    yield self._joined(held)
                    held, size = [], 0
                held.append((part, number, at))
                size += len(part)
        if held:
            yield self._joined(held)

    @staticmethod
    def _joined(held):
        parts, numbers, offsets = zip(*held, strict=True)
        return b"".join(parts), np.cumsum([len(x) for x in parts]), np.array(numbers), np.array(offsets)


def _rows(schema: str, rows: list[tuple]) -> pa.Table:
    names, kinds = zip(*(c.split() for c in schema.split(", ")), strict=True)
    arrow = {"long": pa.int64(), "binary": pa.binary()}
    columns = zip(*rows, strict=True) if rows else [[] for _ in names]
    return pa.table({n: pa.array(c, arrow[k]) for n, k, c in zip(names, kinds, columns, strict=True)})


def _parts(by: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(value, positions) for each value of `by`."""
    order = np.argsort(by, kind="stable")
    cuts = np.flatnonzero(np.diff(by[order])) + 1
    for part in np.split(order, cuts) if len(order) else []:
        yield int(by[part[0]]), part


def _bytes(texts: pa.ChunkedArray | pa.Array) -> list[bytes]:
    return [x or b"" for x in texts.cast(pa.binary()).to_pylist()]


_ANCHORS, _REPEATED = "bucket long, seen binary", "block long, hashes binary, hot binary, copies binary"
_DEALT = "bucket long, block long, spans binary, text binary, windows binary, ranges binary"
_FOUND = "block long, ranges binary, copies binary"


def _in_bytes(entries: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The entries, repeated where their count takes more than one byte, and a byte of the count for each."""
    times = -(-count // 255)
    out = np.full(times.sum(), 255)
    last = np.cumsum(times) - 1
    out[last] = count - 255 * (times - 1)
    return np.repeat(entries, times), out


def _anchors(length: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = Anchors(length)
        for batch in batches:
            blocks, hashes = [], []
            block_of = batch.column("block").to_numpy()
            for data, ends, numbers, _ in anchors.pieces(_bytes(batch.column("text"))):
                first, _, _, gram = anchors.runs(data, ends)
                blocks.append(block_of[numbers[np.searchsorted(ends, first, side="right")]])
                hashes.append(gram)
            if not blocks:
                continue
            block, gram = np.concatenate(blocks), np.concatenate(hashes)
            order = np.lexsort((gram, block))
            block, gram = block[order], gram[order]
            new = np.flatnonzero(np.concatenate([[True], (gram[1:] != gram[:-1]) | (block[1:] != block[:-1])])[: len(gram)])
            count = np.diff(np.concatenate([new, [len(gram)]]))
            new, count = _in_bytes(new, count)
            seen = np.zeros(len(new), _SEEN)
            seen["hash"], seen["block"], seen["n"] = gram[new], block[new], count
            bucket = (_mix(seen["hash"]) >> np.uint64(8)) % np.uint64(buckets)
            yield from _rows(_ANCHORS, [(b, seen[at].tobytes()) for b, at in _parts(bucket)]).to_batches()

    return run


def _repeated(table: pa.Table) -> pa.Table:
    """Per block, its k-grams that occur more than once in the corpus, and those that occur very often."""
    seen = np.concatenate([np.frombuffer(x, _SEEN) for x in table.column("seen").to_pylist()])
    _, at = np.unique(seen["hash"], return_inverse=True)
    total = np.bincount(at, weights=seen["n"])[at]
    rows, seen, total = [], seen[total > 1], total[total > 1]
    for block, part in _parts(seen["block"].astype(np.int64)):
        hashes, often = seen["hash"][part], total[part] >= HOT
        rows.append((block, hashes.tobytes(), hashes[often].tobytes(), None))
    return _rows(_REPEATED, rows)


def _read(table: pa.Table, column: str, kind) -> np.ndarray:
    return np.concatenate([np.zeros(0, kind), *(np.frombuffer(x, kind) for x in table.column(column).to_pylist() if x)])


def _copied(table: pa.Table) -> set[tuple[int, int]]:
    return set(map(tuple, _read(table, "copies", np.dtype("<i8")).reshape(-1, 2).tolist()))


def _spans(length: int, buckets: int):
    def run(docs: pa.Table, repeated: pa.Table) -> pa.Table:
        if not docs.num_rows or not repeated.num_rows:
            return _rows(_DEALT, [])
        anchors, copied = Anchors(length), _copied(repeated)
        hashes, hot = np.unique(_read(repeated, "hashes", "<u8")), np.unique(_read(repeated, "hot", "<u8"))
        block = docs.column("block")[0].as_py()
        keys = list(zip(docs.column("doc_id").to_pylist(), docs.column("digest").to_pylist(), strict=True))
        texts = [b"" if k in copied else x for k, x in zip(keys, _bytes(docs.column("text")), strict=True)]
        first_of: dict[tuple[bytes, int], list[tuple]] = {}
        ranges: list[tuple] = []
        for data, ends, numbers, offsets in anchors.pieces(texts):
            first, n, anchor, gram = anchors.runs(data, ends)
            some = np.isin(gram, hashes)
            first, n, anchor, gram = first[some], n[some], anchor[some], gram[some]
            part = np.searchsorted(ends, first, side="right")
            at = first - np.concatenate([[0], ends])[part] + offsets[part]
            for s, count, off, h, number, where in zip(
                *(x.tolist() for x in (first, n, anchor - first, gram, numbers[part], at)), strict=True
            ):
                span = data[s : s + count + length - 1], off
                new = (*keys[number], where, count, h)
                old = first_of.setdefault(span, [new])
                mine, first_at = (new[0], new[2]), (old[0][0], old[0][2])
                if mine < first_at:  # of equal runs the earliest stands for all
                    first_of[span] = [new]
                    ranges += [late[:4] for late in old]
                elif mine > first_at:
                    ranges.append(new[:4])
                elif all(new[1] != x[1] for x in old):  # rows of one id that differ elsewhere
                    old.append(new)
        return _rows(_DEALT, _dealt_out(block, first_of, ranges, hot, length, buckets))

    return run


def _dealt_out(block, first_of, ranges, hot, length, buckets) -> list[tuple]:
    """One row for each bucket that the block has something for."""
    spans = np.array([(v[4], v[0], v[1], v[2], v[3], k[1]) for k, runs in first_of.items() for v in runs], _SPAN)
    texts = [k[0] for k, runs in first_of.items() for _ in runs]
    often = np.isin(spans["hash"], hot)
    out: dict[int, dict[str, bytes]] = {}
    bucket = (_mix(spans["hash"]) >> np.uint64(8)) % np.uint64(buckets)
    cold = np.flatnonzero(~often)
    for b, part in _parts(bucket[cold]):
        at = cold[part]
        out[b] = {"spans": spans[at].tobytes(), "text": b"".join([texts[i] for i in at])}
    if often.any():
        at = np.flatnonzero(often)
        data = b"".join([texts[i] for i in at])
        starts, owner, inner = _starts(spans[at], length)
        late, first = _later(spans[at], data, starts, owner, inner, length)
        ranges = [*ranges, *late.tolist()]
        windows = np.zeros(len(first), _WINDOW)
        for i, w in enumerate(first.tolist()):
            digest = xxhash.xxh3_128_digest(data[starts[w] : starts[w] + length])
            windows[i]["high"], windows[i]["low"] = np.frombuffer(digest, "<u8")
        for name in ("doc", "digest"):
            windows[name] = spans[at][name][owner[first]]
        windows["at"] = spans[at]["at"][owner[first]] + inner[first]
        for b, part in _parts(windows["high"] % np.uint64(buckets)):
            out.setdefault(b, {})["windows"] = windows[part].tobytes()
    if ranges:
        out.setdefault(block % buckets, {})["ranges"] = np.array(ranges, _RANGE).tobytes()
    return [(b, block, *(row.get(c) for c in ("spans", "text", "windows", "ranges"))) for b, row in out.items()]


def _starts(spans: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per string of the joined spans: where it starts, its span, and its number in the span."""
    n = spans["n"].astype(np.int64)
    base = np.concatenate([[0], np.cumsum(n + length - 1)])[:-1]
    owner = np.repeat(np.arange(len(spans)), n)
    inner = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    return base[owner] + inner, owner, inner


def _later(spans, data, starts, owner, inner, length) -> tuple[np.ndarray, np.ndarray]:
    """Sort the strings; ranges of those that start earlier elsewhere, and the first strings of each class."""
    _, classes = deep_shallow(data, starts, length)
    doc, at = spans["doc"][owner], spans["at"][owner] + inner
    order = np.lexsort((at, doc, classes))
    new = np.concatenate([[True], np.diff(classes[order]) != 0])[: len(order)]
    first = order[new]
    winner = first[np.cumsum(new) - 1] if len(order) else order
    later = (doc[winner] != doc[order]) | (at[winner] != at[order])
    late, first = np.sort(order[later]), np.sort(order[~later])
    cut = np.flatnonzero((owner[late[1:]] != owner[late[:-1]]) | (late[1:] != late[:-1] + 1)) + 1
    begin = late[np.concatenate([[0], cut])] if len(late) else late
    ranges = np.zeros(len(begin), _RANGE)
    ranges["doc"], ranges["digest"], ranges["at"] = doc[begin], spans["digest"][owner[begin]], at[begin]
    ranges["n"] = np.diff(np.concatenate([np.concatenate([[0], cut])[: len(begin)], [len(late)]]))
    return ranges, first


def _sorted(length: int):
    def run(table: pa.Table) -> pa.Table:
        """One bucket: every group of equal k-grams is whole here, but for strings dealt one by one."""
        found: dict[int, list[bytes]] = {}
        spans, texts, blocks, windows, window_blocks = [], [], [], [], []
        for block, packed, text, window, ranges in zip(
            *(table.column(c).to_pylist() for c in ("block", "spans", "text", "windows", "ranges")), strict=True
        ):
            if ranges:
                found.setdefault(block, []).append(ranges)
            if window:
                windows.append(np.frombuffer(window, _WINDOW))
                window_blocks += [block] * len(windows[-1])
            if packed:
                spans.append(np.frombuffer(packed, _SPAN))
                blocks += [block] * len(spans[-1])
                end = np.cumsum(spans[-1]["n"].astype(np.int64) + length - 1)
                texts += [text[a:b] for a, b in zip([0, *end[:-1].tolist()], end.tolist(), strict=True)]
        if spans:
            _cold(np.concatenate(spans), texts, np.array(blocks), length, found)
        if windows:
            _single(np.concatenate(windows), np.array(window_blocks), found)
        return _rows(_FOUND, [(block, b"".join(x), None) for block, x in found.items()])

    return run


def _add(found, blocks, ranges) -> None:
    for block, part in _parts(blocks):
        found.setdefault(block, []).append(ranges[part].tobytes())


def _cold(spans, texts, blocks, length, found) -> None:
    first_of: dict[tuple[bytes, int], int] = {}
    kept: dict[tuple[int, int], int] = {}
    place: dict[tuple[int, int], set[int]] = {}  # rows repeated in full may lie in several blocks
    late = []
    for i in np.lexsort((spans["at"], spans["doc"])).tolist():
        j = first_of.setdefault((texts[i], int(spans["off"][i])), i)
        if (spans["doc"][i], spans["at"][i]) != (spans["doc"][j], spans["at"][j]):
            late.append(i)
            continue
        kept.setdefault((j, int(spans["digest"][i])), i)
        place.setdefault((int(spans["doc"][i]), int(spans["digest"][i])), set()).add(int(blocks[i]))
    ranges = np.zeros(len(late), _RANGE)
    for name in ("doc", "digest", "at", "n"):
        ranges[name] = spans[name][late]
    _add(found, blocks[late], ranges)
    kept = np.array(list(kept.values()))
    _, at, count = np.unique(spans["hash"][kept], return_inverse=True, return_counts=True)
    kept = kept[count[at] > 1]  # a k-gram in one run only: nothing else can equal its strings
    if not len(kept):
        return
    starts, owner, inner = _starts(spans[kept], length)
    ranges, _ = _later(spans[kept], b"".join([texts[i] for i in kept]), starts, owner, inner, length)
    where = [sorted(place[k]) for k in zip(ranges["doc"].tolist(), ranges["digest"].tolist(), strict=True)]
    times = np.array([len(x) for x in where], np.int64)
    _add(found, np.array([b for x in where for b in x], np.int64), np.repeat(ranges, times))


def _single(windows, blocks, found) -> None:
    order = np.lexsort((windows["at"], windows["doc"], windows["low"], windows["high"]))
    windows, blocks = windows[order], blocks[order]
    new = np.concatenate([[True], (np.diff(windows["high"]) != 0) | (np.diff(windows["low"]) != 0)])
    winner = np.flatnonzero(new)[np.cumsum(new) - 1]
    late = (windows["doc"] != windows["doc"][winner]) | (windows["at"] != windows["at"][winner])
    ranges = np.zeros(late.sum(), _RANGE)
    for name in ("doc", "digest", "at"):
        ranges[name] = windows[name][late]
    ranges["n"] = 1
    _add(found, blocks[late], ranges)


def _inside(text: bytes, start: int, end: int) -> tuple[int, int]:
    """The range without the characters that it covers in part."""
    while start < end and text[start] & 0xC0 == 0x80:
        start += 1
    while start < end < len(text) and text[end] & 0xC0 == 0x80:
        end -= 1
    return start, end


def _removed(length: int, whole_characters: bool, result: T.StructType):
    names = result.fieldNames()

    def run(docs: pa.Table, found: pa.Table) -> pa.Table:
        copied, ranges = _copied(found), _read(found, "ranges", _RANGE)
        ranges = ranges[np.lexsort((ranges["at"], ranges["digest"], ranges["doc"]))]
        new = np.concatenate([[True], (np.diff(ranges["doc"]) != 0) | (np.diff(ranges["digest"]) != 0)])[: len(ranges)]
        begin = np.flatnonzero(new)
        of = {
            (int(ranges["doc"][a]), int(ranges["digest"][a])): slice(a, b)
            for a, b in zip(begin.tolist(), np.append(begin[1:], len(ranges))[: len(begin)].tolist(), strict=True)
        }
        sizes, spans, kept = [], [], []
        keys = zip(docs.column("doc_id").to_pylist(), docs.column("digest").to_pylist(), strict=True)
        for key, text in zip(keys, _bytes(docs.column("text")), strict=True):
            sizes.append(len(text))
            if key in copied:
                cover = [(0, len(text))]
            elif key in of:
                at = ranges["at"][of[key]]
                end = np.maximum.accumulate(at + ranges["n"][of[key]] + length - 1)
                cut = np.flatnonzero(at[1:] > end[:-1])
                cover = list(zip(at[np.r_[0, cut + 1]].tolist(), end[np.r_[cut, len(end) - 1]].tolist(), strict=True))
            else:
                cover = []
            if whole_characters:
                cover = [_inside(text, a, b) for a, b in cover]
            spans.append([{"start": a, "end": b} for a, b in cover])
            inner = zip([0, *(b for _, b in cover)], [*(a for a, _ in cover), len(text)], strict=True)
            kept.append(b"".join([text[a:b] for a, b in inner]))
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        new = [pa.array(sizes, pa.int64()), pa.array(spans, span), pa.array(kept, pa.binary())]
        return pa.Table.from_arrays([docs.column("row"), docs.column("doc_id"), *new], names=names)

    return run


def _with_blocks(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows under fixed names, each with the block that it belongs to: neighbours in its file of about its size.

    A row alone tells its block. Texts above BLOCK_BYTES / BLOCK_ROWS fall into classes that double in size, and the
    blocks of a class span half as many rows as those of the class before, so that each keeps to BLOCK_BYTES.
    """
    size = F.octet_length(F.coalesce(docs[text_col], F.lit("")))
    doubled = F.greatest(F.ceil(F.log2(size / F.lit(BLOCK_BYTES / BLOCK_ROWS))), F.lit(0))  # null where size is 0
    doubled = F.coalesce(doubled, F.lit(0))
    span = F.greatest(F.floor(BLOCK_ROWS / F.pow(F.lit(2), doubled)), F.lit(1))
    place = F.floor(F.col("_metadata.row_index") / span)
    block = F.pmod(F.xxhash64("_metadata.file_path", doubled, place), F.lit(2**32 - 5))
    row = F.struct(*(docs[c] for c in docs.columns if c != text_col), F.lit(0).alias("filler"))
    columns = [
        F.coalesce(docs[id_col].cast("long"), F.lit(NO_ID)).alias("doc_id"),
        F.coalesce(docs[text_col], F.lit("")).alias("text"),
        row.alias("row"),
    ]
    try:
        rows = docs.select(block.alias("block"), *columns)
    except AnalysisException:  # not read from files: its rows have no place of their own
        return _with_blocks(stored(docs, "suffix-input"), id_col, text_col)
    return rows.withColumn("digest", F.xxhash64("text"))


def repeated_bytes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    whole_characters: bool = False,
) -> DataFrame:
    """Per input row: row (its other columns), n_bytes, spans removed (start, end), kept (binary).

    A byte goes if a string of `length` bytes that covers it also starts earlier: in a document of smaller
    id, or before in the same one. Strings are judged on the input and never cross documents. A null text is
    empty; a null id sorts last; rows that share an id count as one document, in which equal starts are
    not earlier. With whole_characters a span leaves the characters that it covers in part. An empty table gives an empty result. Whatever else the table holds is passed on in `row`.

    1. Every string has an anchor, its k-gram of smallest hash; blocks of neighbouring documents of like size,
       bounded in rows and bytes (a longer text is alone), list their anchors once, and k-grams found twice or
       more are handed back to the blocks.
    2. A full copy of a text in an earlier document is settled by its digest alone.
    3. Blocks cut the runs of strings around repeated anchors; equal runs are merged, their strings
       meet in buckets of equal anchors, where deep-shallow sorting brings equal strings together and
       the earliest of each class stays. Runs around an anchor found HOT times or more are sorted in
       their block first and their distinct strings dealt by their own digests.
    4. Blocks remove the union of what was found.
    """
    spark = docs.sparkSession
    if length < 3:
        raise ValueError("length must be at least 3")
    arrow_batches(spark)
    rows = _with_blocks(docs, id_col, text_col)
    whole = rows.select("block", "doc_id", "digest", F.octet_length("text").alias("n"), F.unhex(F.sha2("text", 256)).alias("sha"))
    whole = stored(whole, "suffix-digests")
    total = whole.agg(F.sum("n")).first()[0] or 0
    # a block sends each bucket a row or two, so buckets are no more than the work needs
    buckets = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), total // 30 // BUCKET_ANCHORS)
    long = whole.where(F.col("n") >= length)
    first = long.groupBy("sha").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    # stored, so that the join may split a group of very many copies
    copies = long.join(stored(first.drop("last"), "suffix-first"), "sha").where("doc_id > first")
    packed = _copies(copies)

    narrow = rows.select("block", "doc_id", "digest", "text")
    seen = rows.select("block", "text").mapInArrow(_anchors(length, buckets), _ANCHORS)
    repeated = seen.groupBy("bucket").applyInArrow(_repeated, _REPEATED)
    copies_of = packed.select("block", F.lit(None).cast("binary").alias("hashes"), F.lit(None).cast("binary").alias("hot"), "copies")
    repeated = stored(repeated.union(copies_of), "suffix-repeated")
    dealt = narrow.groupBy("block").cogroup(repeated.groupBy("block")).applyInArrow(_spans(length, buckets), _DEALT)
    found = dealt.groupBy("bucket").applyInArrow(_sorted(length), _FOUND)
    none = F.lit(None).cast("binary")
    found = stored(found.union(packed.select("block", none.alias("ranges"), "copies")), "suffix-found")
    result = T.StructType(
        [
            rows.schema["row"],
            T.StructField("order_id", T.LongType()),
            T.StructField("n_bytes", T.LongType()),
            T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
            T.StructField("kept", T.BinaryType()),
        ]
    )
    out = rows.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(_removed(length, whole_characters, result), result)
    return out.drop("order_id")


def _copies(copies: DataFrame) -> DataFrame:
    """Per block and salt the (id, digest) of full copies, packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("doc_id", "digest")], 1).astype("<i8")
            out = [(b, keys[at].tobytes()) for b, at in _parts(batch.column("block").to_numpy())]
            yield from _rows("block long, copies binary", out).to_batches()

    return copies.select("block", "doc_id", "digest").mapInArrow(run, "block long, copies binary")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """docs with the repeated bytes cut out of the text; every row stays. A character that a cut would part
    stays whole, so texts remain UTF-8. A null text becomes the empty one."""
    cut = repeated_bytes(docs, id_col, text_col, length, whole_characters=True)
    text = F.col("kept").cast("string").alias(text_col)
    return cut.select(*(text if c == text_col else F.col("row")[c].alias(c) for c in docs.columns))
