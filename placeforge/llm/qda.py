"""Regularised quadratic discriminant for document quality.

Each text becomes a short vector of transformed statistics. Each class gets a mean and a covariance that
is shrunk towards the pooled one and its diagonal. The score is the posterior of label 1 from the two
Mahalanobis log-densities, by triangular Cholesky factors that are computed once and sent to the workers.

Fitting takes at most FIT_ROWS labelled rows, one for each id, chosen by a hash of doc_id, so its cost and what
reaches the driver are bounded however often an id stands in either table; scoring covers all rows and moves none.

Defined results: null and empty texts are vectors of zeros' transforms and get a score. Without labels of
both classes the score is the share of label 1 (0.5 without labels). Labels that are null are left out.
Repeated rows give repeated results. Extra columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeforge.llm.common import in_fold, labelled, map_columns

#: The bound of the fitting sample.
FIT_ROWS = 20_000
THRESHOLD = 0.3
#: Share of the pooled covariance and of its diagonal in each class covariance.
POOLED, DIAGONAL = 0.10, 0.05

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_LETTER = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]")
_DIGITS = re.compile(r"[0-9]")
FEATURES = (
    "words", "word_length", "symbols", "upper", "distinct", "adjacent", "exclaim", "pipes",
    "digits", "stops", "top_word", "repeats", "deflate", "line_words",
)


def vector(text: str | None) -> list[float]:
    """The transformed statistics of one text."""
    text = text or ""
    words = _WORD.findall(text)
    n, size = len(words), len(text)
    if n == 0:
        return [0.0] * len(FEATURES)
    count = Counter(words)
    letters = len(_LETTER.findall(text))
    raw = text.encode("utf-8", "surrogatepass")
    lines = text.count("\n") + 1
    share = lambda x: math.sqrt(x / size)
    grams = n - 2
    same = sum(a == b for a, b in zip(words, words[1:], strict=False))
    return [
        math.log1p(n),
        math.log(size / n),
        share(sum(map(text.count, "#*$%&<>"))),
        math.sqrt(len(_UPPER.findall(text)) / max(letters, 1)),
        math.log(len(count) / n),
        math.sqrt(same / n),
        share(text.count("!")),
        share(text.count("|")),
        share(len(_DIGITS.findall(text))),
        share(text.count(".") + text.count(",")),
        math.sqrt(max(count.values()) / n),
        math.sqrt(1 - len(set(zip(words, words[1:], words[2:], strict=False))) / grams) if grams > 0 else 0.0,
        math.log((len(zlib.compress(raw, 1)) - 8) / len(raw) + 0.05),
        math.log1p(n / lines),
    ]


class Discriminant:
    """The fitted model: for each class a mean, an inverse Cholesky factor and a constant."""

    def __init__(self, means, factors, constants, prior):
        self.means, self.factors, self.constants, self.prior = means, factors, constants, prior

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.means is None:
            return np.full(len(x), self.prior)
        dens = [c - 0.5 * (((x - m) @ f.T) ** 2).sum(1) for m, f, c in zip(self.means, self.factors, self.constants, strict=True)]
        return 1 / (1 + np.exp(np.clip(dens[0] - dens[1], -700, 700)))


def fit(x: np.ndarray, y: np.ndarray, pooled: float = POOLED, diagonal: float = DIAGONAL) -> Discriminant:
    """Means, shrunk covariances and their Cholesky factors from labelled vectors."""
    ones = int((y == 1).sum())
    if ones == 0 or ones == len(y):
        return Discriminant(None, None, None, ones / len(y) if len(y) else 0.5)
    parts = [x[y == k] for k in (0, 1)]
    means = [p.mean(0) for p in parts]
    covs = [(p - m).T @ (p - m) / len(p) for p, m in zip(parts, means, strict=True)]
    within = sum(c * len(p) for c, p in zip(covs, parts, strict=True)) / len(x)
    floor = np.diag(np.maximum(np.diag(within), 1e-6))
    factors, constants = [], []
    for c, p in zip(covs, parts, strict=True):
        s = (1 - pooled - diagonal) * c + pooled * within + diagonal * floor + 1e-9 * np.eye(len(c))
        low = np.linalg.cholesky(s)
        factors.append(np.linalg.inv(low))
        constants.append(math.log(len(p) / len(x)) - float(np.log(np.diag(low)).sum()))
    return Discriminant(means, factors, constants, ones / len(x))


def labelled_vectors(df: DataFrame, labels: DataFrame, most: int = FIT_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Vectors and labels of at most about `most` learnable rows, in an order that doesn't depend on tasks."""
    got = labelled(df, labels, ("text",), "x array<double>", lambda: lambda texts: ([vector(t) for t in texts],), most)
    if got.num_rows == 0:
        return np.zeros((0, len(FEATURES))), np.zeros(0)
    x = np.array(got.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False)).reshape(-1, len(FEATURES))
    return x, got.column("y").to_numpy()


def quality(df: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, most: int = FIT_ROWS, extra: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, held_out, score and predicted (and `extra` columns of df) for each row of df (doc_id, text)."""
    shared = df.sparkSession.sparkContext.broadcast(fit(*labelled_vectors(df, labels, most)))
    types = dict(df.dtypes)

    def make():
        model = shared.value

        def run(ids, texts, *others):
            s = model.scores(np.array([vector(t) for t in texts]))
            return ids, s.tolist(), (s >= threshold).astype(int).tolist(), *others

        return run

    schema = ", ".join(["doc_id long, score double, predicted int", *(f"__{c} {types[c]}" for c in extra)])
    out = map_columns(df, ("doc_id", "text", *extra), schema, make)
    return out.select("doc_id", in_fold().alias("held_out"), "score", "predicted", *[F.col(f"__{c}").alias(c) for c in extra])
