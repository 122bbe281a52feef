"""Quality classifier: regularised quadratic discriminant analysis over transformed text statistics."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import held_out, stored

#: Statistics of a text, shares by their variance-stabilising arcsine, sizes by logarithm.
FEATURES = [
    "log_chars", "signs", "shouts", "capitals", "digits", "bars", "log_word", "distinct_words",
    "repeated_next", "top_word", "repeated_lines", "log_line", "sentence_ends", "words_with_signs",
]

_BYTE = {name: np.zeros(256, bool) for name in ("upper", "lower", "digit", "sign", "shout", "bar", "lead", "tail")}
_BYTE["upper"][65:91] = True
_BYTE["lower"][97:123] = True
_BYTE["digit"][48:58] = True
_BYTE["lead"][192:] = True
_BYTE["tail"][128:192] = True
_BYTE["sign"][[ord(c) for c in "#$%&*+/<=>@[\\]^_`{|}~"]] = True
_BYTE["shout"][[ord(c) for c in "!?"]] = True
_BYTE["bar"][ord("|")] = True
_SIGNED = re.compile(r"[^\s\w.,;:'\"()-]")


def _share(part: float, whole: float) -> float:
    return float(np.arcsin(np.sqrt(min(1.0, part / whole)))) if whole else 0.0


def statistics(text: str | None) -> list[float]:
    """The features of a whole text; all 0 for a null or empty one."""
    if not text:
        return [0.0] * len(FEATURES)
    counts = np.bincount(np.frombuffer(text.encode("utf-8", "replace"), np.uint8), minlength=256)
    of = {name: int(counts[mask].sum()) for name, mask in _BYTE.items()}
    chars = int(counts.sum()) - of["tail"]
    words = text.split()
    forms = Counter(words)
    lines = [line for line in text.split("\n") if line]
    return [
        float(np.log1p(chars)),
        _share(of["sign"], chars),
        _share(of["shout"], chars),
        _share(of["upper"], of["upper"] + of["lower"] + of["lead"]),
        _share(of["digit"], chars),
        _share(of["bar"], chars),
        float(np.log1p(chars / max(1, len(words)))),
        float(np.log1p(len(forms)) / np.log1p(len(words))) if words else 0.0,
        _share(sum(map(str.__eq__, words, words[1:])), len(words)),
        _share(max(forms.values(), default=0) if len(words) > 20 else 0, len(words)),
        _share(len(lines) - len(set(lines)), len(lines)),
        float(np.log1p(chars / max(1, len(lines)))),
        _share(sum(map(text.count, ".!?")), len(words)),
        _share(sum(1 for w, n in forms.items() if _SIGNED.search(w)), len(forms)),
    ]


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows ``(doc_id, features)``, one for each row of ``docs``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "features": [statistics(t) for t in batch["text"]]})

    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return named.mapInPandas(run, "doc_id long, features array<double>")


@dataclass
class Discriminant:
    """Per class 0 and 1: the mean, the inverse Cholesky factor of the covariance, and the constant of the log-density."""

    means: list[np.ndarray]
    factors: list[np.ndarray]
    constants: list[float]

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        """Log of the odds of class 1, by the difference of the log-densities."""
        density = []
        for mean, factor, constant in zip(self.means, self.factors, self.constants):
            density.append(constant - 0.5 * np.square((x - mean) @ factor.T).sum(axis=1))
        return density[1] - density[0]


def fit(labelled: DataFrame, shrinkage: float = 0.05, floor: float = 5e-3) -> Discriminant | None:
    """Fit on rows ``(label 0 or 1, features)``; None if a class has no row.

    Spark sums the first and second moments; the driver sees one row for each class.  A class
    covariance is shrunk towards its diagonal and the pooled covariance, the more the fewer rows it
    has, and ``floor`` is added to each variance.
    """
    d = len(FEATURES)
    x = [F.col("features")[i] for i in range(d)]
    sums = [F.sum(x[i]).alias(f"s{i}") for i in range(d)]
    products = [F.sum(x[i] * x[j]).alias(f"p{i}_{j}") for i in range(d) for j in range(i, d)]
    rows = labelled.filter("label in (0, 1)").groupBy("label").agg(F.count("*").alias("n"), *sums, *products).collect()
    found = {r["label"]: r for r in rows}
    if set(found) != {0, 1}:
        return None
    means, covariances, counts = [], [], []
    for label in (0, 1):
        r, n = found[label], found[label]["n"]
        mean = np.array([r[f"s{i}"] for i in range(d)]) / n
        second = np.zeros((d, d))
        for i in range(d):
            for j in range(i, d):
                second[i, j] = second[j, i] = r[f"p{i}_{j}"] / n
        means.append(mean)
        covariances.append(second - np.outer(mean, mean))
        counts.append(n)
    pooled = sum(n * c for n, c in zip(counts, covariances)) / sum(counts)
    factors, constants = [], []
    for n, covariance in zip(counts, covariances):
        a = min(1.0, shrinkage + d / (n + d))
        target = 0.5 * (np.diag(np.diag(covariance)) + pooled)
        chol = np.linalg.cholesky((1 - a) * covariance + a * target + floor * np.eye(d))
        factors.append(np.linalg.inv(chol))
        constants.append(float(np.log(n / sum(counts)) - np.log(np.diag(chol)).sum()))
    return Discriminant(means, factors, constants)


def score(
    docs: DataFrame, labels: DataFrame, learns_from, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality"
) -> DataFrame:
    """Rows ``(doc_id, score)``: the probability of label 1, one row for each row of ``docs``.

    ``learns_from`` is a condition on ``doc_id``: labels of other rows are not looked at.  Null and
    empty texts get the score of their (zero) statistics.  Repeated rows are scored each; an id
    with several label rows counts with its smallest label, null labels and ids do not.  If
    a class has no rows every score is 1 (nothing is rejected).  An empty table gives no rows.
    """
    table = stored(features(docs, id_col, text_col))
    known = labels.filter(learns_from).filter(F.col("doc_id").isNotNull() & F.col(label_col).isNotNull())
    known = known.groupBy("doc_id").agg(F.min(label_col).alias("label"))
    model = fit(table.join(known, "doc_id"))
    if model is None:
        return table.select("doc_id", F.lit(1.0).alias("score"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                odds = model.log_odds(np.array(batch["features"].tolist(), float))
                yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "score": 0.5 * (1 + np.tanh(np.clip(odds, -60, 60) / 2))})

    return table.mapInPandas(run, "doc_id long, score double")


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose score, learnt from all labels, reaches the threshold; rows without an id stay."""
    scores = score(docs, labels, F.lit(True)).groupBy("doc_id").agg(F.max("score").alias("_score"))
    rejected = scores.filter(F.col("_score") < threshold).select("doc_id")
    return docs.join(rejected, "doc_id", "left_anti")


def predict(docs: DataFrame, labels: DataFrame, modulus: int = 3, remainder: int = 1) -> DataFrame:
    """Rows ``(doc_id, held_out, score, predicted)``; rows whose hash leaves the remainder are held out."""
    held = held_out(F.col("doc_id"), modulus, remainder)
    scored = score(docs, labels, ~held)
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
