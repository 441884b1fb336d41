"""Language, toxicity and quality: held-out results, and rows that are hard to score."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.tables import LABELS, documents, write_tables
from tidepool.llm import languages as L, quality as Q, toxicity as T
from tidepool.llm.queries import language_id, quality_classifier, toxicity_scores

LARGER = "/root/testdata/sf0.1"


def auc(rows, label: str) -> float:
    score = np.array([r["score"] for r in rows])
    good = np.array([r[label] == 1 for r in rows])
    return float(np.mean([(a > score[~good]) + 0.5 * (a == score[~good]) for a in score[good]]))


@pytest.mark.parametrize(("query", "label", "least"), [(toxicity_scores, "toxic", 0.98), (quality_classifier, "quality", 0.99)])
def test_held_out_labels(spark, query, label, least):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet").select("doc_id", F.crc32(F.col("doc_id").cast("string")).alias("c"))
    labels = spark.read.parquet(f"{LARGER}/labels.parquet")
    scored = query(spark, LARGER)
    rows = scored.join(docs, "doc_id").collect()
    assert len(rows) == docs.count()
    assert all(r["held_out"] == (r["c"] % 5 == 0) and 0 <= r["score"] <= 1 for r in rows)
    cut = 0.5 if label == "toxic" else 0.3
    assert all(r["predicted"] == (r["score"] >= cut) for r in rows)
    held = scored.join(labels, "doc_id").where("held_out").collect()
    assert auc(held, label) > least
    assert np.mean([r["predicted"] == r[label] for r in held]) > 0.97


def test_held_out_languages(spark):
    rows = language_id(spark, LARGER).join(
        spark.read.parquet(f"{LARGER}/documents.parquet").select("doc_id", "lang", F.crc32(F.col("doc_id").cast("string")).alias("c")), "doc_id").collect()
    assert all(r["held_out"] == (r["c"] % 4 == 2) and 0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang_pred"] == r["lang"] for r in held]) > 0.97


TWO = [(k, "the of and with that from this which there have " * 3, "en") for k in range(20)] + \
      [(100 + k, "der die und mit das von dieser welche nicht haben " * 3, "de") for k in range(20)]


def language_model(spark, rows=TWO):
    return L.train(spark.createDataFrame([(k, t, lang, "s", 1) for k, t, lang in rows], documents(spark, []).schema))


def test_mixtures(spark):
    model = language_model(spark)
    assert model.names == ("de", "en")
    assert model.predict("that this have from there which") == ("en", 1.0)
    both = model.mixture(("the of and with that from this which there have " * 4) + "der die und mit das von dieser welche " * 12)
    assert set(both) == {"de", "en"} and both["de"] > both["en"] > 0.1 and abs(sum(both.values()) - 1) < 1e-5
    long = "the of and with that " * 20_000
    assert model.predict(long) == ("en", 1.0)


def test_long_texts_count_like_short_ones(monkeypatch):
    text = "The of, and; with 12 that é漢字 from " * 300 + "end"
    whole = np.bincount(L.gram_counts(text)[0], minlength=L.BUCKETS)
    monkeypatch.setattr(L.texts, "BLOCK", 64)
    L.texts.powers.cache_clear()
    buckets, counts = L.gram_counts(text)
    parts = np.bincount(buckets, weights=counts, minlength=L.BUCKETS)
    L.texts.powers.cache_clear()
    assert (whole == parts).all()


def plain_em(chances: np.ndarray, counts: np.ndarray) -> np.ndarray:
    shares = np.full(chances.shape[1], 1 / chances.shape[1])
    for _ in range(2000):
        part = chances * shares
        shares = (counts[:, None] * part / part.sum(axis=1, keepdims=True)).sum(axis=0) / counts.sum()
    return shares


def test_expectation_maximisation_against_a_plain_one():
    draw = np.random.default_rng(0)
    chances = draw.dirichlet(np.ones(50), size=3).T.astype(np.float32)
    counts = draw.multinomial(5000, chances @ np.array([0.6, 0.3, 0.1]) / (chances @ np.array([0.6, 0.3, 0.1])).sum()).astype(np.float32)
    assert np.abs(L._proportions(chances, counts)[0] - plain_em(chances.astype(float), counts)).max() < 0.01


def test_awkward_languages(spark, awkward):
    model = language_model(spark, [*TWO, (1, None, "xx"), (2, "", "yy"), (3, "no lang", None), (4, "12", "zz")])
    assert model.names == ("de", "en")
    frame = documents(spark, [*awkward, (20, "12 34 !!"), (21, "a")])
    rows = {r["doc_id"]: r["p"] for r in frame.select("doc_id", L.predicted_column(spark, model, F.col("text")).alias("p")).collect()}
    assert all(rows[k]["lang"] == "und" and rows[k]["share"] == 0 for k in (1, 2, 3, 20))
    assert all(rows[k]["lang"] in model.names and 0 < rows[k]["share"] <= 1 for k in (4, 5, 7, 8, 9, 21))
    none = L.train(documents(spark, []))
    assert none.names == () and none.predict("some words") == ("und", 0.0)
    maps = frame.select(L.mixture_column(spark, model, F.col("text")).alias("m")).collect()
    assert all(r["m"] == {} or abs(sum(r["m"].values()) - 1) < 1e-5 for r in maps)


def labelled(spark, n: int = 60):
    docs = [(k, ("good plain words in a row and more of them " if k % 2 else "bad idiot words!! !! in a row ") * (1 + k % 5)) for k in range(n)]
    labels = [(k, k % 2, 1 - k % 2) for k in range(n)] + [(k, None, None) for k in range(3)] + [(5, 0, 1), (None, 1, 0)]
    return documents(spark, docs), spark.createDataFrame(labels, LABELS)


def test_small_classifiers_and_awkward_rows(spark, awkward):
    docs, labels = labelled(spark)
    tox, good = T.train(docs, labels), Q.train(docs, labels, 0.3)
    frame = documents(spark, [*awkward, (50, "idiot words here"), (51, "good plain words in a row")])
    rows = frame.select("doc_id", T.score_column(spark, tox, F.col("text")).alias("t"),
                        Q.score_column(spark, good, F.col("text")).alias("q")).collect()
    assert len(rows) == len(awkward) + 2 and all(0 <= r["t"] <= 1 and 0 <= r["q"] <= 1 for r in rows)
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[50]["t"] > 0.5 > by_id[51]["t"] and by_id[51]["q"] >= 0.3
    assert by_id[1]["t"] == by_id[2]["t"] and by_id[1]["q"] == by_id[2]["q"]
    kept = Q.good_documents(docs.withColumn("score", F.lit("x")), good)
    assert {r["doc_id"] % 2 for r in kept.collect()} == {1} and kept.columns == [*docs.columns, "score"]


@pytest.mark.parametrize("which", [0, 1, None])
def test_labels_of_one_class_or_none(spark, which):
    docs, labels = labelled(spark)
    some = labels.where(F.col("quality") == which) if which is not None else labels.where("false")
    good = Q.train(docs, some, 0.3)
    tox = T.train(docs, some, label="quality")
    n0, n1 = some.where("quality = 0").count(), some.where("quality = 1").count()
    assert good.score("anything") == (n1 + 1) / (n0 + n1 + 2)
    assert T.probability(tox.bias) == pytest.approx((n1 + 1) / (n0 + n1 + 2))


def test_ftrl_against_a_plain_loop():
    rows = [np.array([1, 5], dtype=np.int32), np.array([2], dtype=np.int32), np.array([1, 2, 7], dtype=np.int32)] * 8
    label = np.array([1, 0, 1] * 8)
    learner, again = T.Learner(0.1, 1.0, 0.01, 1.0), np.random.default_rng(7)
    for _ in range(2):
        for k in again.permutation(len(rows)):
            learner.learn(rows[k], label[k], 0.75 if label[k] else 1.5)
    every = learner.weights(np.arange((1 << T.HASH_BITS) + 1))
    numbers = np.flatnonzero(every[:-1])
    weights, bias = every[numbers], every[-1]
    z, n, w = {}, {}, {}
    draw = np.random.default_rng(7)
    size = 1 << T.HASH_BITS

    def weight(i):
        zi = z.get(i, 0.0)
        return 0.0 if abs(zi) <= 0.01 else (np.sign(zi) * 0.01 - zi) / ((1 + n.get(i, 0.0) ** 0.5) / 0.1 + 1.0)

    for _ in range(2):
        for k in draw.permutation(len(rows)):
            own = [*rows[k].tolist(), size]
            w = {i: weight(i) for i in own}
            slope = (1 / (1 + np.exp(-sum(w.values()))) - label[k]) * (0.75 if label[k] else 1.5)
            for i in own:
                step = ((n.get(i, 0.0) + slope * slope) ** 0.5 - n.get(i, 0.0) ** 0.5) / 0.1
                z[i] = z.get(i, 0.0) + slope - step * w[i]
                n[i] = n.get(i, 0.0) + slope * slope
    expected = {i: weight(i) for i in z if weight(i)}
    assert bias == pytest.approx(expected.pop(size))
    assert dict(zip(numbers.tolist(), weights.tolist())) == pytest.approx(expected)


def test_queries_on_empty_tables(spark, tmp_path):
    sf_dir = write_tables(spark, tmp_path / "none", documents(spark, []))
    for query in (toxicity_scores, quality_classifier, language_id):
        assert query(spark, sf_dir).collect() == []
    sf_dir = write_tables(spark, tmp_path / "unlabelled", documents(spark, [(1, "text"), (2, None)]))
    for query in (toxicity_scores, quality_classifier, language_id):
        assert sorted(r["doc_id"] for r in query(spark, sf_dir).collect()) == [1, 2]


def test_a_dirty_language_column_gives_the_frequent_languages(spark):
    rows = [(k, f"word{k % 7} text", f"l{k % 3}" if k < 90 else f"dirt{k}") for k in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert L.train(docs, most=3).names == ("l0", "l1", "l2")


def test_the_sample_is_bounded_by_its_features(spark):
    docs, labels = labelled(spark)
    whole = T.train(docs, labels, label="quality", l1=0.1)
    few = T.train(docs, labels, label="quality", l1=0.1, most=40)
    assert 0 < len(few.numbers) <= 40 < len(whole.numbers)


def test_l1_leaves_few_weights(spark):
    docs, labels = labelled(spark)
    many = T.train(docs, labels, label="quality", l1=0.01)
    few = T.train(docs, labels, label="quality", l1=4.0)
    assert 0 < len(few.numbers) < len(many.numbers)


def test_long_documents_are_learned_whole(spark):
    draw = np.random.default_rng(3)
    words = ["".join(x) for x in draw.choice(list("abcdefghijklmnopqrstuvwxyz"), size=(60_000, 6))]
    bad = next(x for x in words if T.numbers(x).min() > 0.97 * (1 << T.HASH_BITS))
    docs = [(k, " ".join([*draw.choice(words, 6000), bad] if k % 2 else draw.choice(words, 6000))) for k in range(60)]
    assert min(len(T.features(text)) for _, text in docs) > 20_000
    model = T.train(documents(spark, docs), spark.createDataFrame([(k, 0, k % 2) for k, _ in docs], LABELS), l1=4.0)
    assert set(T.features(bad)) <= set(model.numbers[model.weights > 0])


def test_quality_learns_from_every_labelled_document(spark):
    ids = [r[0] for r in spark.range(8600).orderBy(F.xxhash64("id")).collect()]
    # of label 1 the last ones by hash look like no other
    good, bad = ids[0::2], ids[1::2]
    texts = {k: f"plain words {k}" for k in good} | {k: f"plain, words {k}." for k in bad} | {k: "%% %% ## %% ##" for k in good[-150:]}
    labelled = [(k, 1, 0) for k in good] + [(k, 0, 0) for k in bad]
    docs, labels = documents(spark, list(texts.items())), spark.createDataFrame(labelled, LABELS)
    model = Q.train(docs, labels, 0.3)
    assert model.score("%% %% ## %% ##") > 0.3 > model.score("plain, words 5.")
    # small chunks: every one counts
    assert np.abs(Q.train(docs, labels, 0.3, chunk=2000).weights).sum() > 0
