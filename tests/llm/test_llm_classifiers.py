"""Classifiers learn from labels alone, score every text, and the trees' traversal is that of going down row by row."""

import zlib

import numpy as np
import pytest
import samples
from pyspark.sql import functions as F

from restock.llm import labelled, quality, toxicity

FOLDER = "/root/testdata/sf0.1"


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, text string, at string")


def test_folds(spark):
    rows = spark.sql("select explode(sequence(-50, 2000)) as doc_id union all select null")
    for r in rows.select("doc_id", labelled.in_fold("doc_id", 3, 1).alias("f")).collect():
        assert r.f == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)


def test_sample(spark):
    marks = labels(spark, [(0, 1, 0, "", ""), (0, 0, 1, "", ""), (5, 1, None, "", ""), (1, 0, 0, "", ""), (None, 1, 1, "", ""), (77, 1, 1, "", "")])
    found = labelled.sample(samples.awkward(spark), marks, "quality", F.lit(False))
    assert sorted((r.id, r.label, r.text[:9]) for r in found.collect()) == [(0, 1, "The quick"), (1, 0, ""), (5, 1, "the quick")]
    assert labelled.sample(samples.awkward(spark), marks, "quality", F.lit(False), bound=2).select("id").distinct().count() <= 2
    assert labelled.sample(samples.awkward(spark), marks, "quality", F.col("doc_id") == 5).filter("id = 5").count() == 0


def down(forest, row):
    total = forest.base
    for feature, threshold, leaf in zip(forest.feature, forest.threshold, forest.leaf, strict=True):
        node = 0
        while node < len(feature):
            node = 2 * node + 1 + int(row[feature[node]] > threshold[node])
        total += leaf[node - len(feature)]
    return total


def test_trees():
    rng = np.random.default_rng(1)
    x = np.round(rng.normal(size=(3000, 5)), 1)
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] * x[:, 2] > 0.2)).astype(float)
    forest = quality.fit(x[:2000], y[:2000], trees=60)
    assert np.allclose(forest.margin(x[:50]), [down(forest, r) for r in x[:50]])
    assert ((forest.score(x[2000:]) > 0.5) == (y[2000:] > 0)).mean() > 0.93
    assert np.array_equal(forest.margin(x), quality.fit(x[:2000], y[:2000], trees=60).margin(x))


def test_trees_of_few_rows():
    assert quality.fit(np.zeros((0, 3)), np.zeros(0)).score(np.zeros((2, 3))).tolist() == [0.5, 0.5]
    assert (quality.fit(np.zeros((9, 3)), np.ones(9)).score(np.zeros((2, 3))) > 0.9).all()
    one = quality.fit(np.array([[0.0], [1.0]] * 20), np.array([0.0, 1.0] * 20))
    low, high = one.score(np.array([[0.0], [1.0]]))
    assert low < 0.2 and high > 0.8


def test_statistics():
    assert quality.statistics("") == [0.0] * len(quality.NAMES)
    for _, text, _ in samples.TEXTS:
        found = quality.statistics(text or "")
        assert len(found) == len(quality.NAMES) and np.isfinite(found).all()
    found = dict(zip(quality.NAMES, quality.statistics("AA bb bb!\n\nAA bb bb!"), strict=True))
    assert found["distinct"] == 0.5 and found["distinct_lines"] == 0.5 and found["upper"] == pytest.approx(4 / 20)


@pytest.mark.parametrize("marks", [[], [(0, 1, 0, "", ""), (4, 0, 1, "", "")]])
def test_scores_of_awkward_texts(spark, marks):
    rows = samples.awkward(spark)
    learnt = labelled.sample(rows, labels(spark, marks), "quality", F.lit(False))
    forest = quality.train(learnt)
    model = toxicity.train(learnt)
    both = rows.select("doc_id", quality.score(F.col("text"), forest).alias("q"), toxicity.score(F.col("text"), model).alias("t"), toxicity.offending(F.col("text"), model).alias("o"))
    found = both.collect()
    assert len(found) == len(samples.TEXTS) and all(0 <= r.q <= 1 and 0 <= r.t <= 1 and r.o is not None for r in found)
    assert samples.none(spark).select(quality.score(F.col("text"), forest), toxicity.score(F.col("text"), model)).collect() == []


def test_quality_of_documents_held_out(spark):
    documents, marks = spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet")
    out = labelled.in_fold("doc_id", 3, 1)
    forest = quality.train(labelled.sample(documents, marks, "quality", out))
    right = marks.filter(out).join(documents, "doc_id").select("quality", (quality.score(F.col("text"), forest) >= 0.5).cast("int").alias("p")).collect()
    assert len(right) > 1000
    for label in (0, 1):
        own = [r.p == label for r in right if r.quality == label]
        assert sum(own) / len(own) > 0.97


def test_toxicity_of_documents_held_out(spark):
    documents, marks = spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet")
    out = labelled.in_fold("doc_id", 4, 2)
    model = toxicity.train(labelled.sample(documents, marks, "toxic", out))
    found = marks.filter(out).join(documents, "doc_id").select("toxic", toxicity.score(F.col("text"), model).alias("s")).collect()
    toxic, other = ([r.s >= 0.3 for r in found if r.toxic == x] for x in (1, 0))
    assert sum(toxic) / len(toxic) > 0.85 and sum(other) / len(other) < 0.01


def small_model():
    return toxicity.Model({"vile": 4.0, "foul~": 3.0, "mild": -5.0}, -2.0, 0.01)


def test_noisy_or():
    model = small_model()
    p = 1 / (1 + np.exp(-2.0))
    assert model.score("Nothing here. At all!") == pytest.approx(0.01)
    assert model.score("A VILE thing. And vile, again?") == pytest.approx(1 - 0.99 * (1 - p) ** 2)
    assert model.score("mild and vile") == pytest.approx(1 - 0.99 * (1 - 1 / (1 + np.exp(3.0))))


def test_offending_sentences(spark):
    text = "Fine. This is vile! İt is foulest\nThe end."
    row = spark.createDataFrame([(text,), (None,)], "text string").select(toxicity.offending(F.col("text"), small_model(), 0.6).alias("o")).collect()
    assert [text[s.start : s.end].strip() for s in row[0].o] == ["This is vile!", "İt is foulest"] and row[1].o == []


def test_weights_climb_the_likelihood(spark):
    rows = [(i, i % 3 == 0, f"plain words here. more of them {'with poison%d in' % (i % 2) if i % 3 == 0 else 'with sugar in'}. done number{i}.") for i in range(300)]
    learnt = spark.createDataFrame([(i, int(t), x) for i, t, x in rows], "id long, label int, text string")
    model = toxicity.train(learnt)
    assert {"poison0", "poison~", "poiso~", "pois~"} & set(model.weights) and "sugar" not in model.weights
    assert model.score("a drop of poison in it.") > 0.7 and model.score("a drop of sugar in it.") < 0.1
    (start, end, _), *more = [s for s in model.sentences("all good. but poison. fine.") if s[2] > 0.5]
    assert "all good. but poison. fine."[start:end].strip() == "but poison." and not more
