import zlib

import numpy as np
import pytest

from supportlens.llm import quality_gam as gam

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def scored(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    rows = gam.scored(docs, gam.train(docs, labels))
    return docs, labels, rows.select("doc_id", "held_out", "score", "predicted").collect()


def test_held_out_accuracy(scored):
    docs, labels, rows = scored
    truth = {r.doc_id: r.quality for r in labels.collect()}
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    assert len(held) > 50 and np.mean([a == b for a, b in held]) >= 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)


def test_training_leaves_the_held_out_fold_alone(spark, scored):
    docs, labels, _ = scored
    x, y = gam.training_rows(docs, labels)
    other = labels.selectExpr("doc_id", "IF(crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 3 = 1, 1 - quality, quality) AS quality")
    x2, y2 = gam.training_rows(docs, other)
    assert (x == x2).all() and (y == y2).all() and 200 < len(y) < 350
    assert len(gam.training_rows(docs, labels, rows=50)[1]) == 50


def test_scores_are_sums_of_tables():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, len(gam.FEATURES))).astype(np.float32)
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)  # an interaction alone
    model = gam.fit(x, y, rounds=10, pair_rounds=40, pairs=2)
    assert (0, 1) in model.pairs
    assert ((model.score(x) >= 0.5) == y).mean() > 0.93
    bins = model.binned(x[:5])
    for i in range(5):
        by_hand = model.intercept + sum(t[bins[i, f]] for f, t in enumerate(model.tables))
        by_hand += sum(t[bins[i, a] // model.fold, bins[i, b] // model.fold] for (a, b), t in model.pairs.items())
        assert np.isclose(by_hand, model.raw(bins)[i])


def test_odd_documents(spark, odd_docs, no_docs):
    labels = spark.createDataFrame(
        [(1, 0), (3, 1), (4, 1), (4, 1), (5, 0), (5, 1), (6, None), (None, 1), (7, 7), (8, 1)], "doc_id bigint, quality int"
    )
    model = gam.train(odd_docs, labels)
    rows = gam.scored(odd_docs.withColumn("score", odd_docs.doc_id), model)
    assert set(odd_docs.columns) < set(rows.columns)
    got = rows.collect()
    assert len(got) == 10 and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 2, 3)}) == 1
    assert [r.held_out for r in got if r.doc_id is None] == [False]
    assert gam.scored(no_docs, model).collect() == []
    empty = gam.train(no_docs, labels.limit(0))
    assert {r.score for r in gam.scored(odd_docs, empty).collect()} == {0.5}


def test_features_of_long_and_odd_texts():
    for text in (None, "", " \n", "a", "!" * 100_000, "word " * 100_000, "\ud800", "ß é 7"):
        x = gam.features(text)
        assert x.shape == (len(gam.FEATURES),) and np.isfinite(x).all()
