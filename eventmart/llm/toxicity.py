"""Toxicity by weak supervision: many lexicon and pattern voters, a generative label model, a linear classifier.

The voters are words and word beginnings that mark toxic texts, a short fixed lexicon, and patterns.
The label model estimates each voter's accuracy and the voters' correlations from how they agree; a
logistic model is then trained on the posterior labels, so that it can weigh voters without labels.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import held_out, stored, unit

SAMPLE_ROWS = 30_000  # labelled rows that the models are fitted on, about
MAX_TERMS = 300  # mined voters
STRONG = 0.75  # bound on the precision of a term that marks a text by itself
PREFIXES = (4, 5, 6, 7, 8)  # lengths of word beginnings that may be voters

# Common English insults, as prior knowledge where labels are few.
INSULTS = [
    "bastard", "clown", "coward", "creep", "cretin", "degenerate", "disgusting", "dumb", "dumbass", "fool", "freak",
    "garbage", "idiot", "idiotic", "imbecile", "jerk", "liar", "loser", "lunatic", "maggot", "moron", "parasite",
    "pathetic", "pig", "rat", "repulsive", "scum", "scumbag", "stupid", "trash", "ugly", "vermin", "vile", "worthless",
]

_WORD = re.compile(r"[^\W\d_]+")
_PATTERNS = [  # each a voter of its own
    re.compile(r"!{3,}|\?{3,}"),
    re.compile(r"\b(?:you|your|you're)\b", re.I),
    re.compile(r"\b(?:hate|kill|die)\b", re.I),
]


def words_of(text: Column) -> Column:
    return F.array_remove(F.array_distinct(F.split(F.lower(text), r"[^\p{L}]+")), "")


def _beginnings(words: Column, length: int) -> Column:
    """The beginnings of the longer words, each with a ``*``."""
    longer = F.filter(words, lambda w: F.length(w) > length)
    return F.transform(longer, lambda w: F.concat(F.substring(w, 1, length), F.lit("*")))


def mine_terms(sample: DataFrame) -> dict[str, bool]:
    """Words, and word beginnings written with a ``*``, that mark toxic rows of ``(text, toxic)``.

    A term counts if a one-sided bound on its precision (2.6 standard deviations) is above one half; it
    is strong, the value of the result, if the bound is above ``STRONG``.  Spark counts documents by
    term; the driver sees the ``MAX_TERMS`` best.
    """
    words = words_of(F.col("text"))
    begins = [_beginnings(words, n) for n in PREFIXES]
    terms = sample.select("toxic", F.explode(F.array_distinct(F.concat(words, *begins))).alias("term"))
    counts = terms.groupBy("term").agg(F.sum("toxic").cast("double").alias("p"), F.count("*").cast("double").alias("n"))
    z2 = 2.6**2
    share = F.col("p") / F.col("n")
    bound = (share + z2 / (2 * F.col("n")) - F.sqrt(z2 * (share * (1 - share) + z2 / (4 * F.col("n"))) / F.col("n"))) / (1 + z2 / F.col("n"))
    best = counts.filter("p >= 4").withColumn("bound", bound).filter("bound > 0.5")
    found = best.orderBy(F.desc(F.col("bound") > STRONG), F.desc("p"), F.length("term"), "term").limit(MAX_TERMS).collect()
    return {r["term"]: r["bound"] > STRONG for r in found}


class Voters:
    """Votes of a text: which terms and patterns it has."""

    def __init__(self, terms: dict[str, bool]):
        self.names = list(dict.fromkeys([*terms, *INSULTS])) + [p.pattern for p in _PATTERNS]
        place = {name: i for i, name in enumerate(self.names)}
        self._words = {t: place[t] for t in self.names[: -len(_PATTERNS)] if not t.endswith("*")}
        self._begins = {t[:-1]: place[t] for t in self.names[: -len(_PATTERNS)] if t.endswith("*")}
        self._lengths = sorted({len(b) for b in self._begins})
        self._starts = {b[: min(PREFIXES)] for b in self._begins}
        patterns = {p.pattern for p in _PATTERNS}
        self.strong = np.array([n not in patterns and terms.get(n, True) for n in self.names])

    def votes(self, text: str | None) -> list[int]:
        """Places of the voters that fire; none for a null or empty text."""
        if not text:
            return []
        found = {len(self.names) - len(_PATTERNS) + i for i, p in enumerate(_PATTERNS) if p.search(text)}
        words, starts, shortest = self._words, self._starts, min(PREFIXES)
        for word in set(_WORD.findall(text.lower())):
            if word in words:
                found.add(words[word])
            if word[:shortest] in starts:
                for n in self._lengths:
                    if len(word) > n and word[:n] in self._begins:
                        found.add(self._begins[word[:n]])
        return sorted(found)


def _correlations(votes: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Correlations of the voters within the classes, by the posterior."""
    total = np.zeros((votes.shape[1], votes.shape[1]))
    for weight in (toxic, 1 - toxic):
        if weight.sum() > 1:
            centred = votes - (weight @ votes) / weight.sum()
            total += (centred * weight[:, None]).T @ centred
    scale = np.sqrt(np.maximum(np.diag(total), 1e-9))
    return np.clip(total / np.outer(scale, scale), -1, 1)


def label_model(votes: np.ndarray, labels: np.ndarray, rounds: int = 12, trust: float = 0.99) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of the toxic class for each row, and the voters' discounts for correlation.

    Expectation-maximisation over the class balance and each voter's rates of firing in the two classes.
    The given label is one more voter, of accuracy ``trust``.  Voters that fire together beyond what
    the class explains share their evidence: each weighs 1 over the sum of its correlations.
    """
    given = np.where(labels == 1, np.log(trust / (1 - trust)), -np.log(trust / (1 - trust)))
    toxic = 1 / (1 + np.exp(-given))
    discount = np.ones(votes.shape[1])
    for turn in range(rounds):
        balance = np.clip(toxic.mean(), 1e-4, 1 - 1e-4)
        # a voter that has not been seen is taken for a weak sign of toxicity
        on_toxic = (toxic @ votes + 0.2) / (toxic.sum() + 1)
        on_clean = ((1 - toxic) @ votes + 0.05) / ((1 - toxic).sum() + 1)
        on_toxic, on_clean = (np.clip(x, 1e-6, 1 - 1e-6) for x in (on_toxic, on_clean))
        fires, silent = np.log(on_toxic / on_clean), np.log((1 - on_toxic) / (1 - on_clean))
        evidence = votes @ ((fires - silent) * discount) + (silent * discount).sum()
        odds = np.log(balance / (1 - balance)) + given + evidence
        toxic = 1 / (1 + np.exp(-np.clip(odds, -50, 50)))
        if turn == rounds // 2:
            related = np.maximum(_correlations(votes, toxic), 0)
            np.fill_diagonal(related, 0)
            discount = 1 / (1 + np.where(related > 0.1, related, 0).sum(axis=1))
    return toxic, discount


@dataclass
class Linear:
    weights: np.ndarray
    bias: float

    def probability(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(rows @ self.weights + self.bias, -50, 50)))


def _designed(votes: np.ndarray, strong: np.ndarray) -> np.ndarray:
    """The votes, whether any strong voter fires, and how many do by logarithm."""
    count = votes[:, strong].sum(axis=1, keepdims=True)
    return np.hstack([votes, count > 0, np.log1p(count)])


def fit_linear(rows: np.ndarray, posterior: np.ndarray, penalty: float = 0.3, steps: int = 25) -> Linear:
    """Penalised logistic regression on soft labels by Newton's method."""
    x = np.hstack([rows, np.ones((len(rows), 1))])
    ridge = np.full(x.shape[1], penalty)
    ridge[-3:] = 1e-2, 1e-2, 1e-6  # the two summaries and the bias
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(ridge), x.T @ (posterior - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return Linear(w[:-1], float(w[-1]))


def _dense(lists: list[list[int]], width: int) -> np.ndarray:
    out = np.zeros((len(lists), width))
    for row, places in zip(out, lists):
        row[places] = 1
    return out


def _fired(texts: DataFrame, voters: Voters, keep: str, kind: str) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({keep: batch[keep], "votes": [voters.votes(t) for t in batch["text"]]})

    return texts.select(keep, "text").mapInPandas(run, f"{keep} {kind}, votes array<int>")


def learn(docs: DataFrame, labels: DataFrame, learns_from: Column, label_col: str = "toxic") -> tuple[Voters, Linear] | None:
    """Voters and classifier from about ``SAMPLE_ROWS`` labelled rows drawn by a seeded hash; None without both classes.

    ``docs`` has ``(doc_id, text)``.  Labels for which ``learns_from`` does not hold are not looked at; an
    id with several label rows counts with its largest label, null labels and ids do not.
    """
    known = labels.filter(learns_from).filter(F.col("doc_id").isNotNull() & F.col(label_col).isin(0, 1))
    known = known.groupBy("doc_id").agg(F.max(label_col).cast("int").alias("toxic"))
    share = min(1.0, SAMPLE_ROWS / max(1, known.count()))
    drawn = known.filter(unit(F.col("doc_id"), seed=11) < share)
    sample = stored(docs.filter("text is not null").join(drawn, "doc_id").select("toxic", "text"))
    voters = Voters(mine_terms(sample))
    rows = _fired(sample, voters, "toxic", "int").collect()
    labels_ = np.array([r["toxic"] for r in rows])
    if len(set(labels_.tolist())) < 2:
        return None
    votes = _dense([r["votes"] for r in rows], len(voters.names))
    posterior, discount = label_model(votes, labels_)
    design = _designed(votes, voters.strong)
    scale = np.concatenate([np.sqrt(discount), [1, 1]])
    fitted = fit_linear(design * scale, posterior)
    return voters, Linear(fitted.weights * scale, fitted.bias)


def score(
    docs: DataFrame, labels: DataFrame, learns_from: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic"
) -> DataFrame:
    """Rows ``(doc_id, score)``: the probability of toxicity of each whole text, one row for each row of ``docs``.

    Null and empty texts have no votes and get the score of that.  Null ids are kept; repeated rows agree.  If
    the labels lack a class every score is 0.  An empty table gives no rows.
    """
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    model = learn(named, labels, learns_from, label_col)
    if model is None:
        return named.select("doc_id", F.lit(0.0).alias("score"))
    voters, linear = model

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                votes = _dense([voters.votes(t) for t in batch["text"]], len(voters.names))
                found = linear.probability(_designed(votes, voters.strong))
                yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "score": found})

    return named.mapInPandas(run, "doc_id long, score double")


def predict(docs: DataFrame, labels: DataFrame, modulus: int = 4, remainder: int = 2) -> DataFrame:
    """Rows ``(doc_id, held_out, score, predicted)``; ``predicted`` is 1 from a score of 0.3 on."""
    held = held_out(F.col("doc_id"), modulus, remainder)
    scored = score(docs, labels, ~held)
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
