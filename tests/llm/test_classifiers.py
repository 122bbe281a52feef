from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import functions as F

from eventmart.llm import language, quality, toxicity


def _held(doc_id, modulus, remainder):
    return True if doc_id is None else zlib.crc32(str(doc_id).encode()) % modulus == remainder


def _auc(scores, labels):
    ranks = np.argsort(np.argsort(scores)) + 1
    p = int(sum(labels))
    return (ranks[np.array(labels) == 1].sum() - p * (p + 1) / 2) / (p * (len(labels) - p))


# Quality


def test_discriminant_equals_densities(spark):
    rng = np.random.default_rng(1)
    d = len(quality.FEATURES)
    rows = [(k, (rng.normal(size=d) + 2 * k).tolist()) for k in (0, 1) for _ in range(120)]
    model = quality.fit(spark.createDataFrame(rows, "label int, features array<double>"), shrinkage=0.1, floor=1e-3)
    x = np.array([r[1] for r in rows])
    y = np.array([r[0] for r in rows])
    covariances = [np.cov(x[y == k].T, bias=True) for k in (0, 1)]
    pooled = sum(covariances) / 2
    logs = []
    for k in (0, 1):
        a = 0.1 + d / (120 + d)
        c = (1 - a) * covariances[k] + a * 0.5 * (np.diag(np.diag(covariances[k])) + pooled) + 1e-3 * np.eye(d)
        z = x - x[y == k].mean(axis=0)
        logs.append(-0.5 * (z @ np.linalg.inv(c) * z).sum(axis=1) - 0.5 * np.linalg.slogdet(c)[1] + np.log(0.5))
    assert np.allclose(model.log_odds(x), logs[1] - logs[0])


def test_statistics_are_finite():
    for text in (None, "", " ", "a", "|", "x" * 100_000, "\ud800", "A\n" * 1000):
        assert np.isfinite(quality.statistics(text)).all()
    assert quality.statistics("") == [0.0] * len(quality.FEATURES)


def test_quality_held_out(spark, sf):
    base = sf.replace("sf0.001", "sf0.01")
    docs, labels = (spark.read.parquet(f"{base}/{t}.parquet") for t in ("documents", "labels"))
    found = quality.predict(docs, labels)
    rows = found.join(labels, "doc_id").collect()
    assert found.count() == docs.count()
    assert all(r.held_out == _held(r.doc_id, 3, 1) and r.predicted == (r.score >= 0.5) for r in rows)
    held = [r for r in rows if r.held_out]
    assert _auc([r.score for r in held], [r.quality for r in held]) > 0.97


def test_quality_ignores_held_out_labels(documents, labels):
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = (sorted(quality.predict(documents, x).collect()) for x in (labels, turned))
    assert one == two


def test_quality_odd_rows(odd, none, labels):
    found = quality.predict(odd, labels).collect()
    assert len(found) == odd.count()
    assert all(0 <= r.score <= 1 for r in found)
    assert quality.predict(none, labels).count() == 0
    assert {r.score for r in quality.predict(odd, labels.limit(0)).collect()} == {1.0}
    assert quality.keep_good(odd, labels).columns == odd.columns


# Toxicity


def test_label_model_finds_the_accurate_voters():
    rng = np.random.default_rng(2)
    y = (rng.random(3000) < 0.2).astype(int)
    good = (rng.random((3000, 4)) < np.where(y[:, None] == 1, 0.5, 0.005)).astype(float)
    copies = np.repeat((rng.random((3000, 1)) < 0.1), 3, axis=1).astype(float)
    noisy = np.where(rng.random(3000) < 0.1, 1 - y, y)
    posterior, discount = toxicity.label_model(np.hstack([good, copies]), noisy, trust=0.9)
    assert ((posterior > 0.5) == y).mean() > (noisy == y).mean() + 0.02
    assert (discount[4:] < 0.5).all() and (discount[:4] > 0.8).all()


def test_linear_separates():
    x = np.array([[0.0], [0], [1], [1]])
    p = toxicity.fit_linear(np.hstack([x, x, x]), np.array([0.0, 0, 1, 1]), penalty=0.01).probability(np.hstack([x, x, x]))
    assert p[0] < 0.2 < 0.8 < p[3]


def test_mined_terms_and_votes(spark):
    rows = [(1, f"plain text {i} with grumblex and zorkanta{'abcdefghijkl'[i % 12]}") for i in range(40)] + [(0, f"plain text {i} with nothing") for i in range(200)]
    terms = toxicity.mine_terms(spark.createDataFrame(rows, "toxic int, text string"))
    assert terms["grumblex"] and terms["zorkan*"] and "plain" not in terms
    voters = toxicity.Voters(terms)
    fired = {voters.names[i] for i in voters.votes("Zorkantaq is an IDIOT!!!")}
    assert {"zorkan*", "idiot"} <= fired and "grumblex" not in fired
    assert voters.votes(None) == voters.votes("") == []


def test_toxicity_held_out(spark, sf):
    base = sf.replace("sf0.001", "sf0.1")
    docs, labels = (spark.read.parquet(f"{base}/{t}.parquet") for t in ("documents", "labels"))
    found = toxicity.predict(docs, labels)
    rows = found.join(labels, "doc_id").collect()
    assert all(r.held_out == _held(r.doc_id, 4, 2) and r.predicted == (r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.held_out]
    assert _auc([r.score for r in held], [r.toxic for r in held]) > 0.88
    clean = [r for r in held if not r.toxic]
    assert sum(r.predicted for r in clean) <= 0.02 * len(clean)


def test_toxicity_odd_rows(odd, none, labels):
    found = toxicity.predict(odd, labels).collect()
    assert len(found) == odd.count()
    assert all(0 <= r.score <= 1 for r in found)
    assert toxicity.predict(none, labels).count() == 0
    assert {r.score for r in toxicity.predict(odd, labels.limit(0)).collect()} == {0.0}


# Languages


def test_language_held_out(spark, sf):
    docs = spark.read.parquet(f"{sf.replace('sf0.001', 'sf0.01')}/documents.parquet")
    rows = language.predict(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == _held(r.doc_id, 5, 0) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) > 0.95 * len(held)


def test_language_odd_rows(odd, none):
    rows = language.predict(odd).collect()
    assert len(rows) == odd.count()
    told = {r.doc_id: r.lang_pred for r in rows}
    assert all(told[i] == "und" for i in (2, 3, 4, 5))
    assert all(told[i] != "und" for i in (1, 6, 7, 8, None))
    assert language.predict(none).count() == 0
    assert {r.lang_pred for r in language.identify(odd, {}).collect()} == {"und"}
    kept = language.keep_certain(odd)
    assert kept.columns == odd.columns and not {2, 3, 4, 5} & {r.doc_id for r in kept.collect()}


GERMAN = "Die Straße führt über den Fluss und durch das kleine Dorf hinter dem Wald"
ENGLISH = "The road leads over the river and through the little village behind the wood"


def test_a_language_of_one_copied_text_is_learnt(spark):
    """Thousands of copies of one text are one text, and it is never left out."""
    rows = [(i, GERMAN, "de") for i in range(3000)] + [(i, f"{ENGLISH} {i}", "en") for i in range(3000, 6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for seed in range(3):
        found = language.learn(docs, seed=seed)
        assert set(found) == {"de", "en"}
        assert len(found["de"]) < len(found["en"]) <= 120 * 100
    told = {r.lang_pred for r in language.predict(docs).filter("doc_id < 3000").collect()}
    assert told == {"de"}


def test_each_row_is_kept_by_its_own_text(spark):
    """Neither a shared id nor a missing one ties the fate of a clear text to that of an unclear one."""
    rows = [(None, GERMAN, "de"), (None, ENGLISH, "en"), (None, "!!! 123", "en"), (7, ENGLISH, "en"), (7, "???", "en"), (7, ENGLISH, "en")]
    docs = spark.createDataFrame([(*r, [1, None], 2.5) for r in rows], "doc_id long, text string, lang string, margin array<int>, certain double")
    kept = language.keep_certain(docs)
    assert kept.columns == docs.columns
    assert sorted(kept.collect(), key=str) == sorted((r for r in docs.collect() if r.text[0] not in "!?"), key=str)
    assert "Exchange" not in kept._jdf.queryExecution().executedPlan().toString()


def test_decide_breaks_ties_by_name_and_rejects_narrow_margins():
    assert language.decide([10, 10, 30], ["b", "a", "c"])[0] == "a"
    assert language.decide([10, 10], ["a", "b"])[1:] == (0.5, 0.0)
    assert language.decide([100, 150], ["a", "b"])[2] == 0.5
