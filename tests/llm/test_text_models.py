from __future__ import annotations

import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from eventmart.llm import lattice_lm, token_counts

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def unigram():
    """SentencePiece itself, as a unigram model of the same pieces and scores."""
    pb = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    from sentencepiece import SentencePieceProcessor

    proto = pb.ModelProto()
    with open(VOCABULARY, "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = 1
    for piece in proto.pieces:
        if piece.score <= token_counts.LEAST:
            piece.type = pb.ModelProto.SentencePiece.UNUSED
    return SentencePieceProcessor(model_proto=proto.SerializeToString())


def test_counts_are_sentencepieces(odd, documents, unigram):
    both = odd.select("doc_id", "text").union(documents.select("doc_id", "text"))
    texts = {r.doc_id: r.text for r in both.collect()}
    for source in (odd, documents):
        rows = token_counts.count_tokens(source, VOCABULARY).collect()
        assert len(rows) == source.count()
    rows = token_counts.count_tokens(both.filter("doc_id > 9 or doc_id in (6, 7, 8) or doc_id is null"), VOCABULARY).collect()
    for r in rows:
        if r.doc_id not in (6, 7, 8):
            assert r.n_tokens == len(unigram.encode(texts[r.doc_id] or ""))


def test_counts_of_random_texts(unigram):
    viterbi, rng = token_counts.Viterbi(VOCABULARY), random.Random(4)
    for _ in range(300):
        text = "".join(rng.choice("ab eth\nñ日😀,.1A") for _ in range(rng.randint(0, 300)))
        assert viterbi.count(text)[0] == len(unigram.encode(text))
    long = "the end, of ab\n" * 4000
    assert viterbi.count(long)[0] == len(unigram.encode(long))
    assert viterbi.count(None) == viterbi.count("") == (0, 0.0)


def test_counts_of_fractional_scores_take_whole_texts(unigram):
    viterbi = token_counts.Viterbi(VOCABULARY)
    viterbi._whole = False
    for text in ("the cat sat", "  two  spaces\n", "ab" * 50):
        assert viterbi.count(text)[0] == len(unigram.encode(text))


# The lattice


def _all_segmentations(word, probability):
    total = 0.0
    for cuts in itertools.product([0, 1], repeat=len(word) - 1):
        parts, last = [], 0
        for i, cut in enumerate(cuts, 1):
            if cut:
                parts.append(word[last:i])
                last = i
        parts.append(word[last:])
        total += math.prod(probability.get(p, 0.0) for p in parts)
    return total


PIECES = [b" ", b" a", b" ab", b"a", b"b", b"ab", b"ba", b"bab"]


def test_forward_sums_over_all_segmentations():
    rng = np.random.default_rng(3)
    p = rng.dirichlet(np.ones(len(PIECES)))
    lattice = lattice_lm.Lattice(PIECES, np.log(p), math.log(0.25))
    words = [b" " + bytes(w) for n in range(0, 7) for w in itertools.product(b"ab", repeat=n)]
    got = lattice.log_probability(words)
    for word, value in zip(words, got):
        assert value == pytest.approx(math.log(_all_segmentations(word, dict(zip(PIECES, p))) * 0.25))


def test_expected_uses_are_the_derivative():
    p = np.full(len(PIECES), 1 / len(PIECES))
    words = [b" ab", b" ba", b" abab", b" babba"]
    uses = lattice_lm.Lattice(PIECES, np.log(p), 0.0).expected(words)
    for i in range(len(PIECES)):
        up, down = np.log(p), np.log(p)
        up[i] += 1e-5
        down[i] -= 1e-5
        slope = sum(lattice_lm.Lattice(PIECES, x, 0.0).log_probability(words).sum() * s for x, s in ((up, 1), (down, -1))) / 2e-5
        assert uses[i] == pytest.approx(slope, abs=1e-5)


def test_long_words_stay_finite():
    pieces = lattice_lm.vocabulary(VOCABULARY)
    lattice = lattice_lm.Lattice(pieces, np.full(len(pieces), -10.0), -1.0)
    assert np.isfinite(lattice.log_probability([b" " + b"x" * 5000, " 日本".encode(), b" \xff"])).all()


def _tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def test_base_score_and_counts_equal_brute_force(documents):
    rows = lattice_lm.predict(documents, VOCABULARY).collect()
    docs = {r.doc_id: _tokens(r.text) for r in documents.collect()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in docs}
    counts = Counter(w for i, ws in docs.items() if not held[i] for w in ws)
    ends = sum(not h for h in held.values())
    n, v = sum(counts.values()) + ends, len(counts) + 1
    assert len(rows) == len(docs)
    for r in rows:
        words = docs[r.doc_id]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[r.doc_id], len(words) + 1, n)
        assert r.n_known == 1 + sum(counts[w] > 0 for w in words)
        base = sum(math.log10((c + 1) / (n + v + 1)) for c in [ends, *(counts[w] for w in words)])
        assert r.base_score == pytest.approx(base)
        assert r.score < 0


def test_words_of_every_length_have_a_whole_probability(spark):
    """The words of a tiny language, known and not, share at most all probability."""
    rows = [(i, "ab ab a b" if i % 2 else "ab ba", "x") for i in range(40)]
    train = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    words = ["".join(w) for n in range(1, 6) for w in itertools.product("ab", repeat=n)]
    asked = spark.createDataFrame([(1000 + i, w, None) for i, w in enumerate(words)], train.schema)
    found = lattice_lm.score(train.union(asked), F.col("doc_id") < 1000, VOCABULARY).filter("doc_id >= 1000").collect()
    empty = lattice_lm.score(train.union(spark.createDataFrame([(1000, "", None)], train.schema)), F.col("doc_id") < 1000, VOCABULARY)
    end = 10 ** empty.filter("doc_id = 1000").first().score
    assert sum(10**r.score for r in found) / end + end <= 1 + 1e-9


def test_lattice_odd_rows(odd, none):
    rows = lattice_lm.predict(odd, VOCABULARY).collect()
    assert len(rows) == odd.count()
    assert all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in rows)
    by = {r.doc_id: r for r in rows}
    assert by[2].n_tokens == by[3].n_tokens == by[4].n_tokens == 1
    assert by[None].held_out
    assert lattice_lm.predict(none, VOCABULARY).count() == 0
    alone = lattice_lm.score(odd, F.lit(False), VOCABULARY).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and math.isfinite(r.score) for r in alone)
