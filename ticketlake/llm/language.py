"""Language identification: known words first, shorter and shorter character n-grams for unseen ones."""

from __future__ import annotations

import re
import sys
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketlake.llm.common import arrow_batches, stored

# Words and n-grams of each length that every task holds, the most frequent ones (all others are looked up in stored
# tables); longest n-gram; what a step to shorter n-grams costs; the weight of a unit that a language doesn't have.
MAX_WORDS, MAX_GRAMS, LONGEST, STEP_COST, SMOOTHING = 200_000, 20_000, 4, float(np.log(0.4)), 0.1
UNKNOWN = "und"
# Distinct words or texts a task holds before it hands them on or forgets them; different words that a block of texts
# asks for at most (but for those of its last text), and unseen words that a block scores, on average.
_HELD_WORDS, BLOCK_WORDS, BLOCK_UNSEEN = 500_000, 200_000, 50_000
# Texts met by the most tasks whose answers are broadcast.
COMMON_TEXTS = 1000


_WORD = re.compile(r"[^\W\d_]+")


@cache
def _numbers() -> re.Pattern:
    """Number signs that count as word characters but are neither digits nor letters (Unicode category L)."""
    return re.compile(f"[{''.join(c for c in map(chr, range(sys.maxunicode + 1)) if c.isalnum() and not c.isalpha())}]")


def words(text: str | None) -> list[str]:
    """Runs of letters, in lower case."""
    found = _WORD.findall((text or "").lower())
    if all(map(str.isalpha, found)):
        return found
    return [part for word in found for part in ([word] if word.isalpha() else _numbers().split(word)) if part]


def grams(word: str, n: int) -> list[str]:
    """Character n-grams of the word between its boundaries; single ones without them."""
    padded = f"<{word}>" if n > 1 else word
    return [padded[i : i + n] for i in range(len(padded) - n + 1)]


@dataclass
class Model:
    """Log frequencies of the most frequent units: for each length (0: whole words) a row a unit and a column a
    language. `counts` has all words and all n-grams (length, unit, counts), `whole` and `distinct` their
    occurrences by language and their number for each length. Counts of a unit are a text, `language:n` with commas,
    languages by their place in `langs`."""

    langs: list[str]
    prior: np.ndarray
    units: list[dict[str, int]]
    logs: list[np.ndarray]
    counts: list[DataFrame] = field(default_factory=list)
    whole: list[np.ndarray] = field(default_factory=list)
    distinct: list[int] = field(default_factory=list)

    def frequencies(self, length: int, counts: list[str]) -> np.ndarray:
        """Log frequencies of units of a length by their counts."""
        table = np.zeros((len(counts), len(self.langs)))
        for i, text in enumerate(counts):
            for part in text.split(","):
                lang, n = part.split(":")
                table[i, int(lang)] = int(n)
        return np.log((table + SMOOTHING) / (self.whole[length] + SMOOTHING * max(1, self.distinct[length])))

    def unseen(self, fresh: list[str], more: dict[str, np.ndarray] | None = None) -> np.ndarray:
        """Per word the mean log frequency of the longest n-grams the model knows in it; zero if it knows none.
        `more` has the log frequencies of those that it doesn't hold itself."""
        out = np.zeros((len(fresh), len(self.langs)))
        at: list[list[int]] = [[] for _ in range(LONGEST + 1)]
        rows: list[list[int]] = [[] for _ in range(LONGEST + 1)]
        sizes: list[list[int]] = [[] for _ in range(LONGEST + 1)]
        place = {gram: i for i, gram in enumerate(more or {})}
        for i, word in enumerate(fresh):
            for n in range(LONGEST, 0, -1):
                units, held = self.units[n], len(self.logs[n])
                known = [units[g] if g in units else held + place[g] for g in grams(word, n) if g in units or g in place]
                if known:
                    at[n].append(i)
                    rows[n] += known
                    sizes[n].append(len(known))
                    break
        for n in range(1, LONGEST + 1):
            if at[n]:
                size = np.array(sizes[n])
                logs = np.concatenate([self.logs[n], list(more.values())]) if more else self.logs[n]
                sums = np.add.reduceat(logs[rows[n]], np.cumsum(size) - size)
                out[at[n]] = sums / size[:, None] + STEP_COST * (LONGEST + 1 - n)
        return out

    def beyond(self, word: str) -> list[str]:
        """The n-grams of an unseen word that must be looked up."""
        out: list[str] = []
        for n in range(LONGEST, 0, -1):
            here = set(grams(word, n))
            out += [gram for gram in here if gram not in self.units[n]]
            if any(gram in self.units[n] for gram in here):
                break
        return out

    def read(self, counts: Counter) -> tuple[np.ndarray, dict[str, int]]:
        """The sum over the words that the model holds, and the others' counts."""
        total = self.prior.copy()
        known = {word: row for word in counts if (row := self.units[0].get(word)) is not None}
        if known:
            total += np.array([counts[word] for word in known], float) @ self.logs[0][list(known.values())]
        return total, {word: n for word, n in counts.items() if word not in known}

    def decide(self, total: np.ndarray) -> tuple[str, float]:
        """The likeliest language and its posterior probability."""
        chance = np.exp(total - total.max())
        best = int(chance.argmax())
        return self.langs[best], float(chance[best] / chance.sum())


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, Counter] = {}
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            counts.setdefault(lang, Counter()).update(words(text))
        if sum(map(len, counts.values())) > _HELD_WORDS:
            yield from _counted(counts)
            counts = {}
    yield from _counted(counts)


def _counted(counts: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
    for lang, units in counts.items():
        arrays = [pa.array([lang] * len(units), pa.string()), pa.array(list(units), pa.string())]
        yield pa.RecordBatch.from_arrays([*arrays, pa.array(list(units.values()), pa.int64())], names=["lang", "unit", "n"])


def _count_grams(langs: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for word, by_lang in zip(batch.column("unit").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                parts = [(int(lang), int(n)) for lang, n in (x.split(":") for x in by_lang.split(","))]
                for length in range(1, LONGEST + 1):
                    for gram in grams(word, length):
                        for lang, n in parts:
                            counts[length, lang, gram] += n
            if len(counts) > _HELD_WORDS:
                yield _grams(counts, langs)
                counts = Counter()
        yield _grams(counts, langs)

    return run


def _grams(counts: Counter, langs: list[str]) -> pa.RecordBatch:
    length, lang, gram = zip(*counts, strict=True) if counts else ([], [], [])
    arrays = [pa.array(length, pa.int32()), pa.array([langs[i] for i in lang], pa.string()), pa.array(gram, pa.string())]
    return pa.RecordBatch.from_arrays([*arrays, pa.array(list(counts.values()), pa.int64())], names=["length", "lang", "unit", "n"])


def _by_unit(counted: DataFrame, langs: list[str], *more: str) -> DataFrame:
    """Per unit its counts by language and their sum. One shuffle, of what tasks have added up."""
    place = F.array_position(F.array(*map(F.lit, langs)) if langs else F.array().cast("array<string>"), F.col("lang")) - 1
    summed = counted.repartition(*more, "unit").groupBy(*more, "unit", place.cast("int").alias("lang")).agg(F.sum("n").alias("n"))
    part = F.concat_ws(":", "lang", "n")
    return summed.groupBy(*more, "unit").agg(
        F.array_join(F.sort_array(F.collect_list(part)), ",").alias("counts"), F.sum("n").alias("n")
    )


def _most_frequent(by_unit: DataFrame, most: int) -> list:
    """Unit and counts of about `most` of the most frequent units.

    Frequencies are told apart by sixteenths of a doubling; of the last class that fits in part, units of
    smallest hash are taken. So no task sends more than its share of the units that are kept.
    """
    by_unit = by_unit.withColumn("class", F.floor(F.log2("n") * 16))
    room, last, share = most, -1, 1.0
    for frequency, size in sorted(by_unit.groupBy("class").count().collect(), reverse=True):
        if size > room:
            last, share = frequency, room / size
            break
        room -= size
    drawn = F.pmod(F.xxhash64("unit"), F.lit(1 << 40)) / float(1 << 40) < share
    return by_unit.where((F.col("class") > last) | ((F.col("class") == last) & drawn)).select("unit", "counts").collect()


def _totals(by_unit: DataFrame, langs: list[str]) -> tuple[dict[int, np.ndarray], dict[int, int]]:
    """Per length the occurrences by language and the number of units."""
    pair = F.split("part", ":")
    parts = by_unit.select("length", F.explode(F.split("counts", ",")).alias("part")).select("length", pair.alias("pair"))
    parts = parts.groupBy("length", F.col("pair")[0].cast("int").alias("lang"))
    whole = {n: np.zeros(len(langs)) for n in range(LONGEST + 1)}
    for length, lang, n in parts.agg(F.sum(F.col("pair")[1].cast("long"))).collect():  # a row a length and language
        whole[length][lang] = n
    return whole, dict(by_unit.groupBy("length").count().collect())


def fit(corpus: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Counts cover every text with a language, repeated rows as often as they occur. The model holds about
    MAX_WORDS of the most frequent words and MAX_GRAMS of the most frequent n-grams of each length, which bounds it
    whatever the corpus; the others stay in stored tables, and what is held changes no score. Rows without a text, a
    letter or a language don't teach; an empty table gives a model without languages.
    """
    arrow_batches(corpus.sparkSession)
    taught = corpus.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    langs = sorted(r[0] for r in taught.where("lang is not null").select("lang").distinct().collect())
    taught = taught.where("text is not null and lang is not null")
    counted = taught.mapInArrow(_count_words, "lang string, unit string, n long")
    words_ = stored(_by_unit(counted, langs), "language-words").withColumn("length", F.lit(0))
    grams_ = words_.select("unit", "counts").mapInArrow(_count_grams(langs), "length int, lang string, unit string, n long")
    grams_ = stored(_by_unit(grams_, langs, "length"), "language-grams")

    both = words_.select("length", "unit", "counts", "n").unionByName(grams_)
    whole, distinct = _totals(both, langs)
    if not distinct:
        return Model([], np.zeros(0), [{}] * (LONGEST + 1), [np.zeros((0, 0))] * (LONGEST + 1))
    with np.errstate(divide="ignore"):  # a language without a word is never the likeliest
        prior = np.log(whole[0] / whole[0].sum())
    model = Model(langs, prior, [], [], [words_, grams_])
    for length in range(LONGEST + 1):
        by_unit = grams_.where(F.col("length") == length) if length else words_
        rows = sorted(_most_frequent(by_unit, MAX_GRAMS if length else MAX_WORDS), key=lambda r: r["unit"])
        model.whole.append(whole[length])
        model.distinct.append(distinct.get(length, 0))
        model.units.append({row["unit"]: i for i, row in enumerate(rows)})
        model.logs.append(model.frequencies(length, [row["counts"] for row in rows]))
    return model


_READ = "block long, digest binary, total binary, at binary, times binary, words array<string>"


class _Block:
    """Neighbouring texts of a task and the different words that they ask for. A text names words by their place."""

    def __init__(self):
        self.asked: dict[str, int] = {}
        self.texts: list[tuple] = []

    def add(self, digest: bytes, total: np.ndarray, others: dict[str, int]) -> None:
        at = [self.asked.setdefault(word, len(self.asked)) for word in others]
        self.texts.append((digest, total.tobytes(), np.array(at, "<u4").tobytes(), np.array(list(others.values()), "<u4").tobytes()))

    def batch(self, number: int, last: bool) -> pa.RecordBatch:
        """Its texts and, when it is complete, one row with its words."""
        rows = [(number, *t, None) for t in self.texts] + [(number, None, None, None, None, list(self.asked))] * last
        kinds = pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.string())
        columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
        self.texts = []
        names = ["block", "digest", "total", "at", "times", "words"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)


def _read(shared):
    """Texts of a task once each; such without letters are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, met, block, number = shared.value, set(), _Block(), None
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("part", "digest", "text"))
            for part, digest, text in zip(*columns, strict=True):
                number = part << 32 if number is None else number
                if digest in met or not (counts := Counter(words(text))):
                    continue
                if len(met) > _HELD_WORDS:
                    met.clear()
                met.add(digest)
                block.add(digest, *model.read(counts))
                if len(block.asked) >= BLOCK_WORDS:
                    yield block.batch(number, True)
                    block, number = _Block(), number + 1
            if block.texts:
                yield block.batch(number, False)
        if number is not None:
            yield block.batch(number, True)

    return run


def _beyond(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block, word = (batch.column(c).to_pylist() for c in ("fresh", "unit"))
            asked = {(b, gram) for b, w in zip(block, word, strict=True) for gram in shared.value.beyond(w)}
            block, gram = zip(*asked, strict=True) if asked else ([], [])
            yield pa.RecordBatch.from_arrays([pa.array(block, pa.int64()), pa.array(gram, pa.string())], names=["fresh", "unit"])

    return run


def _unseen(shared):
    def run(fresh: pa.Table, found: pa.Table) -> pa.Table:
        model, more = shared.value, {}
        for gram, counts in zip(found.column("unit").to_pylist(), found.column("counts").to_pylist(), strict=True):
            more[gram] = model.frequencies(len(gram), [counts])[0]
        names = fresh.column("unit").to_pylist()
        scores = [row.tobytes() for row in model.unseen(names, more)]
        return pa.Table.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.binary())], names=["unit", "score"])

    return run


_KEY = "digest binary, lang string, score double"


def _decided(shared):
    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        model, out = shared.value, {}
        at, counts, scores = (answers.column(c).to_pylist() for c in ("at", "counts", "score"))
        known = [i for i, x in enumerate(counts) if x is not None]
        table = np.zeros((max(at, default=-1) + 1, len(model.langs)))
        table[[at[i] for i in known]] = model.frequencies(0, [counts[i] for i in known])
        for i, score in zip(at, scores, strict=True):
            if score is not None:
                table[i] = np.frombuffer(score)
        columns = (texts.column(c).to_pylist() for c in ("digest", "total", "at", "times"))
        for digest, total, asked, times in zip(*columns, strict=True):
            total = np.frombuffer(total)
            if asked:
                total = total + np.frombuffer(times, "<u4").astype(float) @ table[np.frombuffer(asked, "<u4")]
            out[digest] = model.decide(total)
        lang, score = zip(*out.values(), strict=True) if out else ([], [])
        arrays = [pa.array(list(out), pa.binary()), pa.array(lang, pa.string()), pa.array(score, pa.float64())]
        return pa.Table.from_arrays(arrays, names=["digest", "lang", "score"])

    return run


def _answers(asked: DataFrame, model: Model, shared) -> DataFrame:
    """(block, at, counts or score) for every word that a block asks for: its own counts, or the score that its n-grams
    give a word that nobody learnt."""
    least = int(asked.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    words_, grams_ = (counts.select("unit", "counts") for counts in model.counts)
    found = stored(asked.join(words_, "unit", "left"), "language-found")
    unknown = found.where("counts is null").select("block", "at", "unit")
    fresh = stored(unknown.select("unit").distinct(), "language-fresh")
    blocks = max(least, -(-fresh.count() // BLOCK_UNSEEN))
    fresh = fresh.select(F.pmod(F.xxhash64("unit"), F.lit(blocks)).alias("fresh"), "unit")
    grams_ = fresh.mapInArrow(_beyond(shared), "fresh long, unit string").distinct().join(grams_, "unit")
    scores = fresh.groupBy("fresh").cogroup(grams_.groupBy("fresh")).applyInArrow(_unseen(shared), "unit string, score binary")
    known = found.where("counts is not null").select("block", "at", "counts", F.lit(None).cast("binary").alias("score"))
    return known.unionByName(unknown.join(scores, "unit").select("block", "at", F.lit(None).cast("string").alias("counts"), "score"))


def predict(
    docs: DataFrame, model: Model, text_col: str = "text", lang_col: str = "lang_pred", score_col: str = "score"
) -> DataFrame:
    """docs with the likeliest learnt language and its posterior probability; of equally likely ones the first in
    the order of their names.

    A null text, one without letters, or a model that learnt nothing gives `und` and 0. Columns of the
    input that are named like the two new ones are replaced, others stay under any name. Whole texts are read;
    repeated rows and equal texts get equal answers, each row its own. An empty table gives an empty result.

    Each distinct text is read once a task: words that the model holds are summed, the others are kept. Blocks of
    neighbouring texts ask the stored counts once for each such word; of those nobody learnt, blocks of words
    ask for their n-grams. The answers complete the sums, and rows meet them by the digest of their text.
    """
    spark = docs.sparkSession
    arrow_batches(spark)
    columns = [c for c in docs.columns if c == text_col or c not in (lang_col, score_col)]
    unknown = F.lit(UNKNOWN), F.lit(0.0)
    if not model.langs:
        return docs.select(*(F.col(f"`{c}`") for c in columns), unknown[0].alias(lang_col), unknown[1].alias(score_col))
    shared = spark.sparkContext.broadcast(replace(model, counts=[]))
    digest = F.unhex(F.sha2(F.col(text_col), 256))
    texts = docs.select(F.spark_partition_id().alias("part"), digest.alias("digest"), F.col(text_col).alias("text"))
    read = stored(texts.where("text is not null").mapInArrow(_read(shared), _READ), "language-read")
    asked = read.where("words is not null").select("block", F.posexplode("words").alias("at", "unit"))
    answers = _answers(asked, model, shared)
    texts = read.where("digest is not null").select("block", "digest", "total", "at", "times")
    found = texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_decided(shared), _KEY)
    # a text lies in as many blocks as tasks read it; those of the most tasks are answered beside the shuffle
    found = found.groupBy("digest").agg(F.min(F.struct("lang", "score")).alias("found"), F.count(F.lit(1)).alias("blocks"))
    found = stored(found, "language-found-texts")
    common = found.where("blocks > 1").orderBy(F.col("blocks").desc(), "digest").limit(COMMON_TEXTS)
    common = F.broadcast(common.select("digest", F.col("found").alias("early")))
    nobody = F.concat(F.lit("-"), F.monotonically_increasing_id()).cast("binary")  # meets nothing, spreads rows
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in columns)).alias("row"), digest.alias("digest"))
    rows = rows.join(common, "digest", "left")
    open_digest = F.when(F.col("early").isNull(), F.col("digest"))
    rows = rows.select("row", "early", F.coalesce(open_digest, nobody).alias("digest"))
    joined = rows.join(found.select("digest", "found"), "digest", "left")
    answer = F.coalesce("early", "found")
    return joined.select(
        *(F.col("row")[c].alias(c) for c in columns),
        F.coalesce(answer["lang"], unknown[0]).alias(lang_col),
        F.coalesce(answer["score"], unknown[1]).alias(score_col),
    )
