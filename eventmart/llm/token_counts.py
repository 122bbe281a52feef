"""Token counts by count-only Viterbi over an existing unigram vocabulary.

Aho-Corasick enumerates the pieces that match; dynamic programming carries the best score and its number
of pieces, never the pieces.  Ties go to the earliest start, as in SentencePiece, so the counts are its
counts to the piece.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CACHED = 400_000  # stretches of text whose result a worker keeps; then it starts anew
LEAST = -1e8  # pieces of a lower score are out of use

_UNKNOWN = 10.0  # what an unknown character scores below the worst piece


class Viterbi:
    """Number of pieces and score of the best segmentation of a text.

    A text falls into stretches where no piece joins two characters.  If all scores are whole numbers,
    their sums are exact and a stretch has the same best path in any text, so its result is
    kept.  Otherwise sums are rounded along the text, and each text is one stretch.
    """

    def __init__(self, path: str):
        import ahocorasick
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        self._normalize = model.normalize
        plain = [
            i
            for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)) and model.get_score(i) > LEAST
        ]
        self._bytes = any(model.is_byte(i) for i in range(model.get_piece_size()))
        pieces = {model.id_to_piece(i): float(np.float32(model.get_score(i))) for i in plain}
        self._unknown = float(np.float32(min(pieces.values()) - _UNKNOWN))
        self._single = {p for p in pieces if len(p) == 1}
        self._matches = ahocorasick.Automaton()
        for p, score in pieces.items():
            self._matches.add_word(p, (len(p), score))
        self._matches.make_automaton()
        self._whole = all(s.is_integer() for s in [*pieces.values(), self._unknown])
        joined = {c for p in pieces if len(p) > 1 for c in p}
        inner = {c for p in pieces if len(p) > 1 for a, c in zip(p, p[1:]) if c == "▁" and a != "▁"}
        if not self._whole:
            self._stretches = re.compile(r".+", re.S)
        elif inner or "▁" not in joined:
            self._stretches = re.compile(f"[{re.escape(''.join(sorted(joined)))}]+|.", re.S)
        else:  # spaces stand only at the beginning of pieces
            letters = re.escape("".join(sorted(joined - {"▁"})))
            self._stretches = re.compile(f"▁+[{letters}]*|[{letters}]+|.", re.S)
        self._kept: dict[str, tuple[float, int]] = {}

    def best(self, text: str) -> tuple[float, int]:
        """Score of the best path and its number of pieces."""
        n = len(text)
        scores, counts, unknown = [0.0] + [None] * n, [0] * (n + 1), [False] * (n + 1)
        matches = self._matches.iter(text)
        found = next(matches, None)
        for end in range(1, n + 1):
            top = None
            while found is not None and found[0] == end - 1:  # longest first: the earliest start wins a tie
                length, score = found[1]
                value = scores[end - length] + score
                if top is None or value > top:
                    top, counts[end], unknown[end] = value, counts[end - length] + 1, False
                found = next(matches, None)
            if text[end - 1] not in self._single:
                value = scores[end - 1] + self._unknown
                if top is None or value > top:
                    more = len(text[end - 1].encode("utf-8", "replace")) if self._bytes else int(not unknown[end - 1])
                    top, counts[end], unknown[end] = value, counts[end - 1] + more, True
            scores[end] = top
        return scores[n], counts[n]

    def count(self, text: str | None) -> tuple[int, float]:
        """Number of pieces and score of a text; nothing for a null or empty one."""
        if not text:
            return 0, 0.0
        text = self._normalize(text)
        if not self._whole:
            score, count = self.best(text)
            return count, score
        if len(self._kept) > CACHED:
            self._kept = {}
        kept, total, sum_ = self._kept, 0, 0.0
        for stretch in self._stretches.findall(text):
            known = kept.get(stretch)
            if known is None:
                known = kept[stretch] = self.best(stretch)
            sum_ += known[0]
            total += known[1]
        return total, sum_


def count_tokens(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows ``(doc_id, n_tokens, score)``, one for each row of ``docs``, of whole texts.

    Null and empty texts have no token and score 0.  Unknown characters count as their UTF-8 bytes if
    the vocabulary has bytes, else a run of them as one token.  Null ids are kept; repeated rows
    agree; an empty table gives no rows.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        viterbi = Viterbi(vocabulary)
        for batch in batches:
            found = pd.DataFrame([viterbi.count(t) for t in batch["text"]], columns=["n_tokens", "score"])
            found.insert(0, "doc_id", batch["doc_id"].astype("Int64").to_numpy())
            yield found.astype({"doc_id": "Int64"})

    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return named.mapInPandas(run, "doc_id long, n_tokens long, score double")
