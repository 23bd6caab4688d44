"""Quality classifier: regularised quadratic discriminant analysis over document statistics.

Each text becomes a vector of transformed statistics (shares, lengths, entropies).
Training sums, per class, the count, the vector and its outer product over all
labelled rows: one small row per task, added up.  Class covariances are shrunk
towards the pooled covariance and its diagonal, their Cholesky factors are computed
once and sent along.  A text's score is the logistic of the difference of its
Mahalanobis log-densities, tempered because documents are not exactly normal.

Labels, language, source and id are never inputs of a score.

Defined results: null text is empty and gets a score like any other; labels of
documents that do not exist, null labels and null ids are not learned from; a
document labelled twice counts twice; with a class missing, every score is the
share of label 1; repeated rows get equal scores; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import if_small, keep_table, whole_text

SHRINK_TO_POOLED = 0.1
SHRINK_TO_DIAGONAL = 0.01
TEMPER = 0.25  # of the log-density difference
SYMBOLS = b"*#$%&!|<>{}[]\\^~@=+_"
LABEL_ROW_BYTES = 40

_LOWER = bytes(range(97, 123))
_UPPER = bytes(range(65, 91))
_DIGITS = bytes(range(48, 58))
_MARKS = b".,;:?'\"()-"


def _share(part: float, whole: float) -> float:
    return part / whole if whole else 0.0


def _root(share: float) -> float:
    return math.sqrt(share)


def _entropy(counts: np.ndarray, total: int) -> float:
    p = counts[counts > 0] / total
    return float(-(p * np.log2(p)).sum()) if total else 0.0


def statistics(text: str) -> list[float]:
    """The transformed statistics of a text, whole."""
    raw = text.encode("utf-8", "replace")
    size, words, lines = len(raw), raw.split(), [x for x in raw.split(b"\n") if x.strip()]
    n = len(words)
    counts = Counter(words)
    lengths = np.fromiter(map(len, words), np.int64, n)
    lower = size - len(raw.translate(None, _LOWER))
    upper = size - len(raw.translate(None, _UPPER))
    symbols = size - len(raw.translate(None, SYMBOLS))
    marks = size - len(raw.translate(None, _MARKS))
    digits = size - len(raw.translate(None, _DIGITS))
    again = sum(a == b for a, b in zip(words, words[1:]))
    top = counts.most_common(1)[0][1] if counts else 0
    line_counts = Counter(lines)
    odd_lines = sum(1 for x in lines if 25 * (len(x) - len(x.translate(None, SYMBOLS))) > len(x))
    bytes_seen = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    return [
        math.log1p(n),
        math.log1p(float(lengths.mean()) if n else 0.0),
        math.log1p(float(lengths.std()) if n else 0.0),
        math.log1p(_share(n, len(lines))),
        _root(_share(upper, upper + lower)),
        _root(_share(symbols, size)),
        _root(_share(marks, size)),
        _root(_share(digits, size)),
        _root(_share(again, n)),
        _root(_share(top, n)),
        _share(len(counts), n) ** 2,
        _entropy(np.fromiter(counts.values(), np.int64, len(counts)), n) / math.log2(n + 2),
        _entropy(bytes_seen, size),
        _root(_share(len(lines) - len(line_counts), len(lines))),
        _root(_share(odd_lines, len(lines))),
    ]


WIDTH = len(statistics(""))


@dataclass(frozen=True)
class Discriminant:
    """Per class: mean, inverse Cholesky factor, log determinant; and the prior of label 1."""

    means: np.ndarray
    factors: np.ndarray
    log_dets: np.ndarray
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Score from 0 to 1 of each row of statistics."""
        if not len(self.means):
            return np.full(len(x), self.prior)
        density = []
        for mean, factor, log_det in zip(self.means, self.factors, self.log_dets):
            white = (x - mean) @ factor.T
            density.append(-0.5 * (white * white).sum(axis=1) - log_det)
        odds = TEMPER * (density[1] - density[0]) + math.log(self.prior / (1 - self.prior))
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def fit_sums(n: np.ndarray, total: np.ndarray, outer: np.ndarray) -> Discriminant:
    """The discriminant from each class's count, sum and sum of outer products."""
    prior = float((n[1] + 1) / (n.sum() + 2))
    if (n < 2).any():
        return Discriminant(np.zeros((0, WIDTH)), np.zeros((0, WIDTH, WIDTH)), np.zeros(0), prior)
    means = total / n[:, None]
    scatter = outer - means[:, :, None] * total[:, None, :]
    pooled = scatter.sum(axis=0) / (n.sum() - 2)
    factors, log_dets = [], []
    for c in (0, 1):
        cov = (1 - SHRINK_TO_POOLED) * scatter[c] / (n[c] - 1) + SHRINK_TO_POOLED * pooled
        own = np.diag(np.diag(cov))
        cov = (1 - SHRINK_TO_DIAGONAL) * cov + SHRINK_TO_DIAGONAL * own + 1e-6 * np.eye(WIDTH)
        lower = np.linalg.cholesky(cov)
        factors.append(np.linalg.inv(lower))
        log_dets.append(np.log(np.diag(lower)).sum())
    return Discriminant(means, np.array(factors), np.array(log_dets), prior)


def remainder(doc_id: Column, of: int) -> Column:
    """crc32 of the id as text, modulo ``of``."""
    return F.crc32(doc_id.cast("string")) % of


def document_vectors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, x): the statistics of every whole text."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [statistics(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(x, pa.list_(pa.float64()))], ["doc_id", "x"])

    texts = docs.select(docs[id_col].cast("bigint").alias("doc_id"), whole_text(docs, text_col).alias("text"))
    return texts.mapInArrow(measure, "doc_id BIGINT, x ARRAY<DOUBLE>")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), float).reshape(-1, WIDTH)


def fit(vectors: DataFrame, labels: DataFrame, label_col: str = "quality") -> Discriminant:
    """Learn from all rows of ``labels`` (doc_id, ``label_col`` 0/1) that ``vectors`` has."""
    wanted = labels.select(
        labels["doc_id"].cast("bigint").alias("doc_id"), labels[label_col].cast("int").alias("label")
    ).where("label IN (0, 1)")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, 1 + WIDTH + WIDTH * WIDTH))
        for b in batches:
            x, y = _matrix(b.column("x")), b.column("label").to_numpy(zero_copy_only=False)
            for c in (0, 1):
                rows = x[y == c]
                sums[c] += np.concatenate([[len(rows)], rows.sum(axis=0), (rows.T @ rows).reshape(-1)])
        label, place = np.indices(sums.shape)
        columns = [pa.array(label.reshape(-1)), pa.array(place.reshape(-1)), pa.array(sums.reshape(-1))]
        yield pa.RecordBatch.from_arrays(columns, ["label", "place", "value"])

    found = vectors.join(wanted, "doc_id").select("x", "label").mapInArrow(
        add, "label BIGINT, place BIGINT, value DOUBLE"
    )
    sums = np.zeros((2, 1 + WIDTH + WIDTH * WIDTH))
    for r in found.groupBy("label", "place").agg(F.sum("value").alias("value")).collect():
        sums[r["label"], r["place"]] = r["value"]
    return fit_sums(sums[:, 0], sums[:, 1 : 1 + WIDTH], sums[:, 1 + WIDTH :].reshape(2, WIDTH, WIDTH))


def score_vectors(vectors: DataFrame, model: Discriminant) -> DataFrame:
    """(doc_id, score) of every row."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = model.score(_matrix(b.column("x")))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(s)], ["doc_id", "score"])

    return vectors.mapInArrow(score, "doc_id BIGINT, score DOUBLE")


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float = 0.3,
    folds: int = 5,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted; learns only from rows not held out."""
    vectors = keep_table(document_vectors(docs, id_col, text_col), "quality-vectors")
    model = fit(vectors, labels.where(remainder(labels["doc_id"], folds) != 0))
    return score_vectors(vectors, model).select(
        "doc_id",
        F.coalesce(remainder(F.col("doc_id"), folds) == 0, F.lit(True)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def drop_low_quality(
    docs: DataFrame, labels: DataFrame, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` whose doc_id was not rejected; rows without an id stay."""
    gone = keep_table(
        quality_scores(docs, labels, threshold, id_col=id_col, text_col=text_col)
        .where("predicted = 0 AND doc_id IS NOT NULL")
        .select(F.col("doc_id").alias("_gone_id"))
        .distinct(),
        "low-quality",
    )
    gone = if_small(gone, gone.count(), LABEL_ROW_BYTES)
    return docs.join(gone, docs[id_col].cast("bigint") == gone["_gone_id"], "left_anti")
