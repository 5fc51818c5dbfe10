import random

import numpy as np
from pyspark.sql import functions as F

from starloom.llm.toxicity import LABEL_CATEGORIES, fit_chain, reject_toxic, score_documents, train_chain

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    chain = train_chain(docs, labels.where("doc_id % 2 = 0"), LABEL_CATEGORIES)
    held = docs.join(labels.where("doc_id % 2 = 1 AND quality = 1"), "doc_id").select(
        "toxic", (chain.score(F.col("text"))["toxic"] >= 0.5).cast("int").alias("said")
    ).groupBy("toxic", "said").count().collect()
    count = {(r["toxic"], r["said"]): r["count"] for r in held}
    right = count.get((0, 0), 0) + count.get((1, 1), 0)
    assert sum(count.values()) > 1000 and right / sum(count.values()) > 0.99
    assert count.get((1, 1), 0) / (count.get((1, 1), 0) + count.get((1, 0), 0)) > 0.95


def test_later_models_use_the_earlier_category():
    rng = random.Random(0)
    rows, cols, first, second = [], [], [], []
    for i in range(600):
        a = rng.random() < 0.5
        b = a and rng.random() < 0.9
        rows += [i, i]
        cols += [int(a), 2 + rng.randrange(30)]
        first.append(float(a))
        second.append(float(b))
    terms = [b"no", b"yes"] + [b"w%d" % i for i in range(30)]
    held = np.array(rows), np.array(cols), np.ones(1200, dtype=np.int64)
    wanted = {"a": np.array(first), "b": np.array(second)}
    chain = fit_chain(terms, *held, wanted, np.arange(600) % 5)
    assert len(chain.models[0].earlier) == 0 and chain.models[1].earlier[0] > 0.1
    again = fit_chain(terms, *held, wanted, np.arange(600) % 5)
    assert all((x.weights == y.weights).all() for x, y in zip(chain.models, again.models))


def test_odd_documents(spark, odd_documents, no_documents):
    labels = spark.createDataFrame(
        [(i, i % 2, 1 if i % 5 == 0 else 0, "x") for i in range(40)] + [(3, None, None, "x"), (None, 1, 1, "x"), (7, 1, 1, "x"), (999, 0, 1, "x")],
        "doc_id long, quality int, toxic int, _text string",
    )
    scored = score_documents(odd_documents, labels)
    assert scored.count() == odd_documents.count()
    assert all(0 <= r["scores"][c] <= 1 for r in scored.collect() for c in ("junk", "toxic"))
    kept = reject_toxic(odd_documents, labels)
    assert kept.columns == odd_documents.columns
    assert kept.count() == scored.where("scores.toxic < 0.5").count()
    assert reject_toxic(no_documents, labels).count() == 0
    none = score_documents(odd_documents, labels.limit(0))
    assert {r["scores"]["toxic"] for r in none.collect()} == {0.5}


def test_without_labels_nothing_is_toxic(spark, odd_documents):
    for labels in ([], [(10_000, 0, 1)]):
        table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
        assert reject_toxic(odd_documents, table).count() == odd_documents.count()
        assert score_documents(odd_documents, table).where("trained").count() == 0
