"""Language model by subword lattice: the marginal probability of a text over all its segmentations.

A word with its leading space is a lattice.  Its arcs are the pieces of an existing vocabulary that match a
part of it, and, if training documents have it, the word itself.  A forward recursion in log space
sums over all paths.  Whole words have their discounted frequencies; the discounts are the
probability of spelling a word by pieces, whose scores are fitted to the training words by
expectation-maximisation.  No arc reaches over a space, so a text's probability is the product
over its words and the end.  There is such a model for each language of the training documents, and
a text's language is one more hidden choice that is summed over.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import held_out, stored

ROUNDS = 3  # of expectation-maximisation, each over all words
LANGUAGES = 12  # models of the most frequent languages; documents of all others share one more
BORROWED = 0.03  # probability that a word follows the mixture of all languages
FREQUENT = 200_000  # most frequent words, whose counts tasks get at once; the others' are joined
PRIOR = 0.01  # occurrences that each piece has before any is seen

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = bytes.maketrans(_UPPER.encode(), _UPPER.lower().encode())
_SPACES = r"[\x20\x09-\x0D]+"
_BASE = np.uint64(0x9E3779B97F4A7C15)
_CELLS = 1 << 21  # numbers of a block of words that are worked on together
_LETTERS = 1 << 20  # letters of words that are gathered for it


def vocabulary(path: str) -> list[bytes]:
    """Pieces of a SentencePiece model as bytes, ``▁`` as a space, and all single bytes, by rank of their scores."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    ids = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    ids.sort(key=lambda i: (-model.get_score(i), i))
    pieces = [model.id_to_piece(i).replace("▁", " ").encode() for i in ids]
    return list(dict.fromkeys([p for p in pieces if b" " not in p[1:]] + [bytes([b]) for b in range(256)]))


class Lattice:
    """Word probabilities, and expected piece counts, of many words at once.

    ``log_p`` has a number for each piece, or one for each piece and language; ``log_stop`` one, or one for each language.
    """

    def __init__(self, pieces: list[bytes], log_p: np.ndarray, log_stop: float | np.ndarray):
        self.log_p, self.log_stop = log_p, log_stop
        by_length: dict[int, list[int]] = defaultdict(list)
        for i, p in enumerate(pieces):
            by_length[len(p)].append(i)
        self._tables = []
        for length in sorted(by_length):
            keys = self._keys(np.frombuffer(b"".join(pieces[i] for i in by_length[length]), np.uint8).reshape(-1, length))[:, -1]
            order = np.argsort(keys)
            if (np.diff(keys[order]) == 0).any():
                raise ValueError("two pieces share a key")
            self._tables.append((length, keys[order], np.array(by_length[length])[order]))
        self._powers = np.cumprod(np.r_[np.uint64(1), np.full(max(by_length), _BASE)], dtype=np.uint64)

    @staticmethod
    def _keys(rows: np.ndarray) -> np.ndarray:
        """Polynomial keys of all beginnings of the rows."""
        keys = np.empty(rows.shape, np.uint64)
        last = np.zeros(len(rows), np.uint64)
        for j in range(rows.shape[1]):
            last = last * _BASE + rows[:, j] + np.uint64(1)
            keys[:, j] = last
        return keys

    def _arcs(self, rows: np.ndarray) -> tuple[np.ndarray, ...]:
        """``(starts, ends, rows, pieces)`` of all matches, by end and length."""
        keys = np.hstack([np.zeros((len(rows), 1), np.uint64), self._keys(rows)])
        found = []
        for length, known, ids in self._tables:
            if length >= keys.shape[1]:
                break
            key = keys[:, length:] - keys[:, :-length] * self._powers[length]
            place = np.minimum(np.searchsorted(known, key.ravel()), len(known) - 1)
            hits = np.flatnonzero(known[place] == key.ravel())
            at, start = np.divmod(hits, key.shape[1])
            found.append((start, start + length, at, ids[place[hits]]))
        starts, ends, at, pieces = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((starts, ends))
        return starts[order], ends[order], at[order], pieces[order]

    @staticmethod
    def _forward(rows: np.ndarray, arcs: tuple[np.ndarray, ...], log_p: np.ndarray) -> np.ndarray:
        """Log probabilities of all beginnings of the rows, summed over all ways to spell them."""
        starts, ends, at, pieces = arcs
        alpha = np.full((rows.shape[1] + 1, len(rows), *log_p.shape[1:]), -np.inf)
        alpha[0] = 0
        if len(rows) == 1:  # all arcs of an end at once: a long word costs as many steps as it has bytes
            bounds = np.searchsorted(ends, np.arange(1, rows.shape[1] + 2)).tolist()
            for end, (low, high) in enumerate(zip(bounds, bounds[1:]), 1):
                if high > low:
                    alpha[end, 0] = np.logaddexp.reduce(alpha[starts[low:high], 0] + log_p[pieces[low:high]], axis=0)
            return alpha
        for start, end, x, used in Lattice._spans(arcs):
            alpha[end, x] = np.logaddexp(alpha[end, x], alpha[start, x] + log_p[used])
        return alpha

    @staticmethod
    def _spans(arcs: tuple[np.ndarray, ...]) -> list[tuple]:
        """The arcs of one start and end together, by end; each row has one at most."""
        starts, ends, at, pieces = arcs
        cuts = np.flatnonzero((np.diff(ends) != 0) | (np.diff(starts) != 0)) + 1
        return [(starts[i], ends[i], at[i:j], pieces[i:j]) for i, j in zip([0, *cuts], [*cuts, len(ends)]) if j > i]

    def _blocks(self, words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        by_length = defaultdict(list)
        for i, w in enumerate(words):
            by_length[len(w)].append(i)
        for length, places in by_length.items():
            step = max(1, _CELLS // max(1, length * len(self._tables)))
            for low in range(0, len(places), step):
                part = places[low : low + step]
                yield np.array(part), np.frombuffer(b"".join(words[i] for i in part), np.uint8).reshape(len(part), length)

    def log_probability(self, words: list[bytes]) -> np.ndarray:
        """Natural logarithm of the probability that pieces spell each word, which includes its leading space."""
        out = np.zeros((len(words), *self.log_p.shape[1:]))
        for places, rows in self._blocks(words):
            out[places] = self._forward(rows, self._arcs(rows), self.log_p)[-1] + self.log_stop
        return out

    def expected(self, words: list[bytes], language: int | None = None) -> np.ndarray:
        """Expected number of uses of each piece in the words, by the weights of that language."""
        log_p = self.log_p if language is None else self.log_p[:, language]
        total = np.zeros(len(log_p))
        for _, rows in self._blocks(words):
            arcs = self._arcs(rows)
            alpha = self._forward(rows, arcs, log_p)
            beta = np.full(alpha.shape, -np.inf)
            beta[-1] = 0
            for start, end, x, used in reversed(self._spans(arcs)):
                through = log_p[used] + beta[end, x]
                beta[start, x] = np.logaddexp(beta[start, x], through)
                total += np.bincount(used, np.exp(alpha[start, x] + through - alpha[-1, x]), len(total))
        return total


def words_of(text: Column) -> Column:
    """Words of a text with A-Z in lower case."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _UPPER.lower()), _SPACES), "")


def _normalised(uses: np.ndarray, begins: np.ndarray, words: float) -> tuple[np.ndarray, float]:
    """Log probabilities of the pieces that begin a word, of those that go on, and of its stop, from their uses."""
    weights = uses + PRIOR
    going_on = weights[~begins].sum() + words + PRIOR
    log_p = np.log(weights / np.where(begins, weights[begins].sum(), going_on))
    return log_p, float(np.log((words + PRIOR) / going_on))


def fit(words: DataFrame, distinct: list[int], pieces: list[bytes], rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Log probabilities by piece and language, and of a word's stop by language, from rows ``(word, c)``.

    ``c`` has the counts by language, ``distinct`` how many words each has.  What is spelt is a word not yet
    seen, so each distinct word counts once.  The vocabulary's scores give the ranks of its pieces, and these the first weights.
    Each round sums expected uses within tasks and by piece in Spark; the driver sees as many rows as the
    vocabulary has, for each language.
    """
    begins = np.array([p[:1] == b" " for p in pieces])
    rank = 1.0 / (np.arange(len(pieces)) + 100.0)
    models = [_normalised(rank / rank.sum() * 4.0 * n, begins, n) for n in distinct]
    for _ in range(rounds):
        log_p, log_stop = (np.stack(x, axis=-1) for x in zip(*models))

        def run(batches: Iterator[pd.DataFrame], log_p=log_p, log_stop=log_stop) -> Iterator[pd.DataFrame]:
            lattice = Lattice(pieces, log_p, log_stop)
            total = np.zeros(log_p.shape)
            for batch in _gathered(batches):
                words, counts = _spaced(batch["word"]), np.array(batch["c"].tolist()).reshape(len(batch), -1)
                for z in range(total.shape[1]):
                    total[:, z] += lattice.expected([words[i] for i in np.flatnonzero(counts[:, z])], z)
            used, z = np.nonzero(total)
            yield pd.DataFrame({"language": z, "piece": used, "uses": total[used, z]})

        uses = np.zeros(log_p.shape)
        found = words.mapInPandas(run, "language int, piece int, uses double")
        for r in found.groupBy("language", "piece").agg(F.sum("uses").alias("uses")).collect():
            uses[r["piece"], r["language"]] = r["uses"]
        models = [_normalised(u, begins, n) for u, n in zip(uses.T, distinct)]
    log_p, log_stop = (np.stack(x, axis=-1) for x in zip(*models))
    return log_p, log_stop


def spelt(words: DataFrame, pieces: list[bytes], model: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """The rows with ``p``: by language the natural logarithm of the probability that pieces spell ``word``, over all segmentations."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lattice = Lattice(pieces, *model)
        for batch in _gathered(batches):
            yield batch.assign(p=list(lattice.log_probability(_spaced(batch["word"]))))

    return words.mapInPandas(run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in words.schema) + ", p array<double>")


def _gathered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rows in larger batches, since a lattice works on all words of a length at once."""
    held, letters = [], 0
    for batch in batches:
        held.append(batch)
        letters += int(batch["word"].str.len().sum())
        if letters > _LETTERS:
            yield pd.concat(held, ignore_index=True)
            held, letters = [], 0
    if held:
        yield pd.concat(held, ignore_index=True)


def _spaced(words) -> list[bytes]:
    return [b" " + w.encode("utf-8", "replace") for w in words]


class Model:
    """Log10 probabilities of words: by the add-one unigram model, and by each language's lattice."""

    def __init__(self, tokens: int, distinct: int, documents: list[int], words: list[int], forms: list[int], discounts: list[float]):
        self.divisor = math.log10(tokens + distinct + 1)
        self.discounts, self.masses = np.array(discounts), np.array(words) + np.array(documents) + 1.0
        # half of the additional occurrence is an end, half a new word
        self.spelt = np.log10((self.discounts * np.array(forms) + 0.5) / self.masses)
        self.ends = np.log10((np.array(documents) + 0.5) / self.masses)
        self.end_base = math.log10(sum(documents) + 1) - self.divisor
        self.shares = (np.array(documents) + 0.5) / (sum(documents) + 0.5 * len(documents))

    def words(self, counts: np.ndarray, by_pieces: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``base`` by word, and ``lattice`` by word and language, of words that occur so often by language and are spelt so likely."""
        base = np.log10(counts.sum(axis=1) + 1) - self.divisor
        whole = np.maximum(counts - self.discounts, 0) / self.masses
        own = np.logaddexp(np.log(np.maximum(whole, 1e-300)), by_pieces + self.spelt * math.log(10))
        mixed = np.logaddexp.reduce(own + np.log(self.shares), axis=1, keepdims=True)
        return base, np.logaddexp(own + math.log(1 - BORROWED), mixed + math.log(BORROWED)) / math.log(10)


def score(
    docs: DataFrame, learns: Column, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """Rows ``(doc_id, n_tokens, n_known, train_tokens, base_score, score)``, one for each row of ``docs``.

    ``learns`` is a condition on ``doc_id`` that picks the training documents, whose ``lang`` sorts their words;
    no other language is looked at.  Tokens are words with A-Z in lower case, and one end.
    ``base_score`` is the add-one unigram model's log10 probability, ``score`` the lattice's: a word of count
    c has (c - discount) / N for itself, and the discounts' share of what its pieces say.

    Null text: empty, the end alone.  Null ids are kept (``learns`` decides on them), repeated rows
    count each, a null language is one of its own.  Without training documents all words are spelt,
    with the first guess of the scores.  An empty table gives no rows.
    """
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    pieces = vocabulary(vocabulary_path)
    train = named.filter(learns)
    sizes = train.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).collect()
    total = train.count()
    documents = [r["count"] for r in sizes] + [total - sum(r["count"] for r in sizes)]
    classes = len(documents)
    place = F.coalesce(*[F.when(F.col("lang").eqNullSafe(F.lit(r["lang"])), F.lit(z)) for z, r in enumerate(sizes)], F.lit(classes - 1))
    if documents[-1] == 0 and sizes:
        documents, classes = documents[:-1], classes - 1
    by_class = [F.count(F.when(F.col("z") == z, 1)) for z in range(classes)]
    counts = train.select(place.alias("z"), F.explode(words_of(F.col("text"))).alias("word"))
    counts = stored(counts.groupBy("word").agg(F.array(*by_class).alias("c")))
    c = [F.col("c")[z] for z in range(classes)]
    seen = counts.agg(
        F.count("*").alias("v"),
        *[F.coalesce(F.sum(x), F.lit(0)).alias(f"n{z}") for z, x in enumerate(c)],
        *[F.count(F.when(x == i, 1)).alias(f"of{i}_{z}") for z, x in enumerate(c) for i in (0, 1, 2)],
    ).first()
    words, forms = ([seen[f"n{z}"] for z in range(classes)], [seen["v"] - seen[f"of0_{z}"] for z in range(classes)])
    discounts = [min(0.95, max(0.05, seen[f"of1_{z}"] / max(1, seen[f"of1_{z}"] + 2 * seen[f"of2_{z}"]))) for z in range(classes)]
    tokens = sum(words) + total
    model = Model(tokens, seen["v"] + (total > 0), documents, words, forms, discounts)
    spelling = fit(counts, forms, pieces)
    known = stored(spelt(counts, pieces, spelling))
    top = known.orderBy(F.desc(F.aggregate("c", F.lit(0).cast("long"), lambda a, x: a + x)), "word").limit(FREQUENT)
    top = top.toArrow()
    frequent = [w.encode("utf-8", "replace") for w in top["word"].to_pylist()]
    often, likely = (np.array(top[x].combine_chunks().flatten(), float).reshape(-1, classes) for x in ("c", "p"))
    sums = [f"s{z}" for z in range(classes)]

    def bags(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place = {w: i for i, w in enumerate(frequent)}
        base, own = model.words(often, likely)
        for batch in batches:
            heads, rare = [], ([], [], [])
            for key, doc_id, text in zip(batch["key"], batch["doc_id"], batch["text"]):
                bag = Counter((text or "").encode("utf-8", "replace").translate(_LOWER).split())
                at, times = [], []
                for w, n in bag.items():
                    i = place.get(w)
                    if i is None:
                        rare[0].append(key)
                        rare[1].append(w.decode())
                        rare[2].append(n)
                    else:
                        at.append(i)
                        times.append(n)
                times = np.array(times, float)
                sized = base[at] @ times if at else 0.0
                by_language = times @ own[at] if at else np.zeros(classes)
                heads.append((key, doc_id, sum(bag.values()) + 1, int(times.sum()) + (total > 0), sized + model.end_base, *by_language))
            if not heads:
                continue
            head = pd.DataFrame(heads, columns=["key", "doc_id", "n_tokens", "n_known", "base_score", *sums])
            more = pd.DataFrame({"key": rare[0], "word": pd.Series(rare[1], dtype=object), "n": rare[2]})
            both = pd.concat([head.assign(word=None), more]) if len(more) else head.assign(word=None, n=None)
            both = both.reindex(columns=[*head.columns, "word", "n"])
            both["word"] = both["word"].astype(object).where(both["word"].notna(), None)
            yield both.astype({"key": "int64"} | {x: "Int64" for x in ("doc_id", "n_tokens", "n_known", "n")})

    def rest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            table = np.array([np.zeros(classes) if c is None else c for c in batch["c"]], float).reshape(-1, classes)
            base, own = model.words(table, np.stack(batch["p"].to_list()))
            n = batch["n"].to_numpy(float)
            found = pd.DataFrame({"key": batch["key"], "n_known": n * (table.sum(axis=1) > 0), "base_score": n * base})
            found[sums] = n[:, None] * own
            yield found.groupby("key", as_index=False).sum().astype({"n_known": "int64"})

    by_class = ", ".join(f"{x} double" for x in sums)
    rows = stored(
        named.withColumn("key", F.monotonically_increasing_id()).mapInPandas(
            bags, f"key long, doc_id long, n_tokens long, n_known long, base_score double, {by_class}, word string, n long"
        )
    )
    rare = rows.filter("word is not null").select("key", "word", "n")
    unseen = rare.select("word").distinct().join(known, "word", "left_anti")
    unseen = spelt(unseen, pieces, spelling).select("word", F.lit(None).cast("array<bigint>").alias("c"), "p")
    more = rare.join(known.unionByName(unseen), "word").select("key", "n", "c", "p").mapInPandas(rest, f"key long, n_known long, base_score double, {by_class}")
    more = more.groupBy("key").agg(*[F.sum(x).alias(f"more_{x}") for x in ("n_known", "base_score", *sums)])
    joined = rows.filter("word is null").join(more, "key", "left")
    whole = {x: F.col(x) + F.coalesce(F.col(f"more_{x}"), F.lit(0)) for x in ("n_known", "base_score", *sums)}
    # log of the sum over the languages, from the largest term on
    terms = [whole[x] + F.lit(float(e + np.log10(p))) for x, e, p in zip(sums, model.ends, model.shares)]
    most = F.greatest(*terms) if classes > 1 else terms[0]
    over = sum((F.pow(F.lit(10.0), t - most) for t in terms[1:]), F.pow(F.lit(10.0), terms[0] - most))
    return joined.select(
        "doc_id",
        "n_tokens",
        whole["n_known"].alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        whole["base_score"].alias("base_score"),
        (most + F.log10(over)).alias("score"),
    )


def predict(docs: DataFrame, vocabulary_path: str, modulus: int = 7, remainder: int = 2) -> DataFrame:
    """``score`` with ``held_out``: rows whose hash leaves the remainder teach nothing."""
    held = held_out(F.col("doc_id"), modulus, remainder)
    found = score(docs, ~held, vocabulary_path).withColumn("held_out", held)
    return found.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
