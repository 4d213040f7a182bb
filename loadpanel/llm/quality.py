"""Quality classifier: regularised quadratic discriminant over document statistics.

Each class is a normal distribution of transformed statistics of the text. Its
covariance is shrunk, first towards the covariance pooled over the classes, then
towards a diagonal, so that a class with few documents or a statistic that never
varies stays invertible. A document's score is the posterior of the good class: the
logistic of the difference of two Mahalanobis log-densities, from Cholesky
factors that are computed once and sent with the tasks.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from loadpanel.llm.common import text_bytes
from loadpanel.scale import is_small, materialize

# Words (or bytes, lines) of typical text that every ratio is smoothed with, so that short texts look typical.
PRIOR = 40.0
STATISTICS = ("symbols", "capitals", "digits", "marks", "word_length", "repeated_words", "doubled_words", "repeated_lines", "separators")

_KIND = np.zeros(256, np.int64)
for _i in range(128):
    _c = chr(_i)
    if _c.isspace():
        _KIND[_i] = 0
    elif _c.islower():
        _KIND[_i] = 1
    elif _c.isupper():
        _KIND[_i] = 2
    elif _c.isdigit():
        _KIND[_i] = 3
    elif _c in ".,;:'\"()-?":
        _KIND[_i] = 4
    else:
        _KIND[_i] = 5
_KIND[128:] = 1
_SPACE, _SMALL, _CAPITAL, _DIGIT, _MARK, _SYMBOL = range(6)


def _ratio(part: float, whole: float, typical: float, prior: float = PRIOR) -> float:
    return (part + prior * typical) / (whole + prior)


def document_statistics(text: bytes) -> list[float]:
    """Transformed statistics of a whole text; an empty one gets the typical values."""
    kinds = np.bincount(_KIND[np.frombuffer(text, np.uint8)], minlength=6)
    letters = int(kinds[_SMALL] + kinds[_CAPITAL])
    visible = int(letters + kinds[_DIGIT] + kinds[_MARK] + kinds[_SYMBOL])
    words = text.lower().split()
    n = len(words)
    doubled = sum(map(eq, words, words[1:]))
    triples = set(zip(words, words[1:], words[2:]))
    lines = [x for x in text.split(b"\n") if x.strip()]
    alone = sum(1 for w in words if not w.strip(b"|-*#~=_<>/\\"))
    return [
        float(np.log(_ratio(float(kinds[_SYMBOL]), visible, 0.002, 5 * PRIOR))),
        float(np.log(_ratio(float(kinds[_CAPITAL]), letters, 0.02, 5 * PRIOR))),
        float(np.log(_ratio(float(kinds[_DIGIT]), visible, 0.005, 5 * PRIOR))),
        float(np.log(_ratio(float(kinds[_MARK]), visible, 0.03, 5 * PRIOR))),
        float(np.log(_ratio(float(visible), n, 5.5))),
        float(np.log(_ratio(float(max(0, n - 2 - len(triples))), n, 0.02))),
        float(np.log(_ratio(float(doubled), n, 0.01, PRIOR / 4))),
        float(np.log(_ratio(float(len(lines) - len(set(lines))), len(lines), 0.02, PRIOR / 4))),
        float(np.log(_ratio(float(alone), n, 0.005))),
    ]


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _statistics(texts: pd.Series) -> pd.Series:
    return texts.map(document_statistics)


# Ids of labelled documents that are broadcast: a number each, some 20 MB.
LABELS_SENT = 1_000_000


def held_out(doc_id: str = "doc_id") -> Column:
    """The quarter of the documents that no label is learnt from; a null id is in it never."""
    rest = F.pmod(F.crc32(F.col(doc_id).cast("long").cast("string").cast("binary")), F.lit(4))
    return F.coalesce(rest == 2, F.lit(False))


@dataclass(frozen=True)
class Discriminant:
    """Two normal densities: log priors, means, inverse Cholesky factors and log determinants, by class."""

    log_prior: np.ndarray
    mean: np.ndarray
    inverse: np.ndarray
    log_det: np.ndarray
    # Score of every text where the labels hold one class only, or none.
    constant: float | None = None

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Posterior probability of class 1 for each row of ``x``."""
        if self.constant is not None:
            return np.full(len(x), self.constant)
        density = [
            self.log_prior[c] - self.log_det[c] - 0.5 * (((x - self.mean[c]) @ self.inverse[c].T) ** 2).sum(axis=1)
            for c in (0, 1)
        ]
        return 1.0 / (1.0 + np.exp(np.clip(density[0] - density[1], -700, 700)))


def _moments(labelled: DataFrame, size: int) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Rows, mean and covariance of each class, as sums over all labelled rows that combine before the shuffle."""
    exact = lambda c: F.sum(c.cast("decimal(30,12)")).cast("double")
    x = [F.col("x")[i] for i in range(size)]
    pairs = [(i, j) for i in range(size) for j in range(i, size)]
    rows = (
        labelled.groupBy("quality")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.array(*[exact(v) for v in x]).alias("s"),
            F.array(*[exact(x[i] * x[j]) for i, j in pairs]).alias("ss"),
        )
        .collect()
    )
    out = {}
    for r in rows:
        mean = np.array(r["s"]) / r["n"]
        second = np.zeros((size, size))
        for (i, j), v in zip(pairs, r["ss"]):
            second[i, j] = second[j, i] = v / r["n"]
        out[r["quality"]] = (float(r["n"]), mean, second - np.outer(mean, mean))
    return out


def fit(labelled: DataFrame, to_pooled: float = 0.3, to_diagonal: float = 0.1, floor: float = 1e-4) -> Discriminant:
    """The discriminant from rows of (x, quality) with quality 0 or 1.

    Class covariances move by ``to_pooled`` towards the pooled one, then by
    ``to_diagonal`` towards their own diagonal; ``floor`` is added to each variance.
    """
    size = len(STATISTICS)
    moments = _moments(labelled.filter("quality in (0, 1)"), size)
    if set(moments) != {0, 1}:
        only = 0.0 if set(moments) == {0} else 1.0
        none = np.zeros(0)
        return Discriminant(none, none, none, none, constant=only)
    total = sum(n for n, _, _ in moments.values())
    pooled = sum(n * cov for n, _, cov in moments.values()) / total
    priors, means, inverses, dets = [], [], [], []
    for c in (0, 1):
        n, mean, cov = moments[c]
        cov = (1 - to_pooled) * cov + to_pooled * pooled
        cov = (1 - to_diagonal) * cov + to_diagonal * np.diag(np.diag(cov)) + floor * np.eye(size)
        factor = np.linalg.cholesky(cov)
        priors.append(np.log(n / total))
        means.append(mean)
        inverses.append(np.linalg.inv(factor))
        dets.append(np.log(np.diag(factor)).sum())
    return Discriminant(np.array(priors), np.array(means), np.array(inverses), np.array(dets))


def _score_with(model: Discriminant):
    @F.pandas_udf(T.DoubleType())
    def score(x: pd.Series) -> pd.Series:
        return pd.Series(model.scores(np.stack(x.to_numpy())) if len(x) else [], dtype="float64")

    return score


def with_statistics(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), _statistics(text_bytes()).alias("x"), held_out().alias("held_out")
    )


def train(stats: DataFrame, labels: DataFrame) -> Discriminant:
    """Fits on the labels of documents that are not held out; other columns are never looked at."""
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    return fit(stats.filter(~F.col("held_out")).join(marks, "doc_id").select("x", "quality"))


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from ``threshold`` on) of every row of ``docs``.

    Null and empty texts get the score of typical values. Labels other than 0 and 1
    and labels without a document are ignored; a document with several labels
    counts once for each. If the labels know one class only, every text is of that
    class (score 0 or 1); without any label every text is good (score 1).
    """
    stats = materialize(with_statistics(docs), "quality-statistics")
    score = _score_with(train(stats, labels))
    scored = stats.select("doc_id", "held_out", score("x").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def accepted_rows(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` that reach ``threshold``, with their columns.

    While the labels are few, only labelled texts are looked at for the fit; texts are never shuffled for it.
    """
    marks = materialize(labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality"), "quality-labels")
    labelled = docs
    if is_small(marks, LABELS_SENT):
        known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        labelled = known.join(F.broadcast(marks.select("doc_id").distinct()), "doc_id", "left_semi")
    model = train(materialize(with_statistics(labelled), "quality-statistics"), marks)
    named = docs.select(F.struct("*").alias("row"), _statistics(text_bytes()).alias("x"))
    return named.filter(_score_with(model)("x") >= threshold).select("row.*")
