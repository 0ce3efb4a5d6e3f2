"""Quality scores: labelled documents vote by similarity in a latent-semantic space."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketlake.llm.common import arrow_batches, stored

# Terms are hashed byte pairs and triples, half of BYTE_TERMS each, and word pairs: words fall into WORD_CLASSES by
# hash, and each ordered pair of classes one and two places apart is a term. Dimensions of the latent space.
BYTE_TERMS, WORD_CLASSES, PLACES, DIMENSIONS = 2048, 8, (1, 2), 32
TERMS = BYTE_TERMS + len(PLACES) * WORD_CLASSES**2
# Labelled texts that vote at most (a bounded sample), neighbours that vote on one document, and the power
# of the similarity that weighs a vote.
MAX_LABELLED, NEIGHBOURS, SHARPNESS = 4096, 24, 16
_BLOCK_TEXTS, _BLOCK_BYTES = 128, 4 << 20


def term_counts(texts: list[bytes]) -> np.ndarray:
    """Counts of the terms, one row a text."""
    out = np.zeros((len(texts), TERMS), np.float32)
    half, pairs_of_classes = BYTE_TERMS // 2, WORD_CLASSES**2
    for row, text in enumerate(texts):
        for at in range(0, max(len(text) - 2, 0), _BLOCK_BYTES):
            b = np.frombuffer(text, np.uint8)[at : at + _BLOCK_BYTES + 2].astype(np.uint32)
            pairs = (b[:-1] << np.uint32(8)) | b[1:]
            triples = (pairs[:-1] << np.uint32(8)) | b[2:]
            hashed = np.concatenate(
                [
                    (pairs[:-1] * np.uint32(2654435761)) >> np.uint32(22),
                    ((triples * np.uint32(2246822519)) >> np.uint32(22)) + np.uint32(half),
                ]
            )
            out[row, :BYTE_TERMS] += np.bincount(hashed, minlength=BYTE_TERMS)
        classes = np.array(list(map(crc32, text.split())), np.int64) % WORD_CLASSES
        for nth, back in enumerate(PLACES):
            term = classes[:-back] * WORD_CLASSES + classes[back:]
            first = BYTE_TERMS + nth * pairs_of_classes
            out[row, first : first + pairs_of_classes] = np.bincount(term, minlength=pairs_of_classes)
    return out


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


@dataclass
class Model:
    """What is broadcast: term weights, latent axes, and the labelled vectors."""

    weights: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float

    def terms(self, texts: list[bytes]) -> np.ndarray:
        """Bytes and words weigh the same."""
        weighed = np.log1p(term_counts(texts)) * self.weights
        return np.hstack([_unit(weighed[:, :BYTE_TERMS]), _unit(weighed[:, BYTE_TERMS:])])

    def project(self, terms: np.ndarray) -> np.ndarray:
        """Latent vectors. Blocks are filled up to one size, so that a text's vector doesn't depend on its block."""
        full = np.zeros((_BLOCK_TEXTS, TERMS), np.float32)
        full[: len(terms)] = terms
        return _unit(full @ self.axes)

    def score(self, texts: list[bytes]) -> np.ndarray:
        """Share of label 1 among the nearest labelled vectors, each weighed by its cosine. All that are as near as the
        last of the NEIGHBOURS vote."""
        if not len(self.labels):
            return np.full(len(texts), self.prior)
        cosine = (self.project(self.terms(texts)) @ self.vectors.T)[: len(texts)]
        k = min(NEIGHBOURS, len(self.labels))
        last = -np.partition(-cosine, k - 1, axis=1)[:, k - 1 : k]
        row, near = np.nonzero((cosine >= last) & (cosine > 0))
        weight = cosine[row, near].astype(float) ** SHARPNESS
        some = np.bincount(row, weight, len(texts))
        votes = np.bincount(row, weight * self.labels[near], len(texts))
        return np.where(some > 0, np.clip(votes / np.maximum(some, 1e-300), 0, 1), self.prior)


_SEEN = "term int, docs long"
_TEXT, _SCORE = "text_to_score", "score_of_text"


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen, n = np.zeros(TERMS, np.int64), 0
    for batch in batches:
        texts = [(x or "").encode() for x in batch.column("text").to_pylist()]
        for at in range(0, len(texts), _BLOCK_TEXTS):
            seen += (term_counts(texts[at : at + _BLOCK_TEXTS]) > 0).sum(0)
        n += len(texts)
    terms = np.concatenate([[-1], np.arange(TERMS)])
    counts = np.concatenate([[n], seen])
    yield pa.RecordBatch.from_arrays([pa.array(terms, pa.int32()), pa.array(counts, pa.int64())], names=["term", "docs"])


def fit(
    corpus: DataFrame, labels: DataFrame, key: str = "doc_id", text_col: str = "text", label_col: str = "label"
) -> Model:
    """Term statistics cover every text of `corpus`; the labelled sample is bounded by MAX_LABELLED.

    `labels` has the key and a label, 0 or 1; rows with another label, no key or a null text don't teach. The sample
    takes the texts of smallest hash, copies as one with the mean of their labels, also of rows that are repeated
    or share a key. Tasks turn its texts into term vectors, and only these reach the driver. Without labelled
    rows, as in empty tables, every score is 0.5.
    """
    arrow_batches(corpus.sparkSession)
    n, seen = 0, np.zeros(TERMS, np.int64)
    parts = corpus.select(F.col(text_col).alias("text")).mapInArrow(_frequencies, _SEEN)
    summed = parts.groupBy("term").agg(F.sum("docs").alias("docs"))
    for row in summed.collect():  # one row a term, and one for the number of texts
        if row["term"] < 0:
            n = row["docs"]
        else:
            seen[row["term"]] = row["docs"]
    weights = (np.log((1 + n) / (1 + seen)) + 1).astype(np.float32)

    text = F.col(text_col)
    hashed = corpus.where(text.isNotNull()).select(F.col(key).alias("key"), F.xxhash64(text).alias("hash"))
    known = labels.select(F.col(key).alias("key"), F.col(label_col).cast("int").alias("label")).where("label in (0, 1)")
    sample = hashed.join(known, "key").groupBy("hash").agg(F.avg("label").alias("mean"))
    sample = stored(sample.orderBy("hash").limit(MAX_LABELLED), "quality-sample")
    texts = corpus.where(text.isNotNull()).select(F.xxhash64(text).alias("hash"), text.alias("text"))
    texts = texts.join(F.broadcast(sample), "hash").groupBy("hash", "mean").agg(F.max("text").alias("text"))
    model = Model(weights, np.zeros((TERMS, DIMENSIONS), np.float32), np.zeros((0, DIMENSIONS)), np.zeros(0), 0.5)
    rows = texts.mapInArrow(_term_vectors(model), "hash long, mean double, terms binary").toArrow().sort_by("hash")
    if not rows.num_rows:
        return model
    terms = np.frombuffer(b"".join(rows.column("terms").to_pylist()), np.float32).reshape(-1, TERMS)
    model.labels = rows.column("mean").to_numpy()
    model.prior = float(model.labels.mean())
    model.axes = np.ascontiguousarray(_leading(terms.T @ terms, DIMENSIONS))
    blocks = range(0, len(terms), _BLOCK_TEXTS)
    model.vectors = np.concatenate([model.project(terms[at : at + _BLOCK_TEXTS]) for at in blocks])[: len(terms)]
    return model


def _term_vectors(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x.encode() for x in batch.column("text").to_pylist()]
            blocks = [model.terms(texts[at : at + _BLOCK_TEXTS]) for at in range(0, len(texts), _BLOCK_TEXTS)]
            terms = pa.array([row.tobytes() for block in blocks for row in block], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("hash"), batch.column("mean"), terms], names=["hash", "mean", "terms"])

    return run


def _leading(gram: np.ndarray, k: int) -> np.ndarray:
    """Axes of the k largest eigenvalues by subspace iteration, which needs no copy of the matrix."""
    axes = np.linalg.qr(np.random.default_rng(0).standard_normal((len(gram), 2 * k)).astype(np.float32))[0]
    for _ in range(12):
        axes = np.linalg.qr(gram @ axes)[0]
    values, turn = np.linalg.eigh(axes.T @ gram @ axes)
    return (axes @ turn[:, ::-1][:, :k]).astype(np.float32)


def _scored(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = [(x or "").encode() for x in batch.column(_TEXT).to_pylist()]
            blocks = [texts[at : at + _BLOCK_TEXTS] for at in range(0, len(texts), _BLOCK_TEXTS)]
            scores = np.concatenate([model.score(block) for block in blocks]) if blocks else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, pa.float64())], names=[*batch.schema.names, _SCORE]
            )

    return run


def score(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """docs with a score from 0 to 1; higher: label 1 is likelier. A null text scores like the empty one.

    Every document meets every labelled vector: exact cosines, block by block. A text without terms, or far
    from all labelled ones, scores the mean label. Equal texts score the same, repeated rows each on its own; of
    labelled vectors as near as the last that votes all vote. A column of the input named like the score is
    replaced, others stay. An empty table gives an empty result.
    """
    arrow_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.drop(score_col) if score_col != text_col else docs
    held = rows.select(F.struct(*(rows[c] for c in rows.columns)).alias("row"), F.col(text_col).alias(_TEXT))
    schema = T.StructType([*held.schema.fields, T.StructField(_SCORE, T.DoubleType())])
    scored = held.mapInArrow(_scored(shared), schema)
    return scored.select("row.*", F.col(_SCORE).alias(score_col))
