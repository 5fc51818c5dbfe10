import math

import numpy as np
from pyspark.sql import functions as F

from starloom.llm.mixing import decide_block, flight, mix, mixed_rows, source_targets


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """Targets by source (None last): share by weight, stop at most * size, share the excess again."""
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    total, done = share * sum(sizes.values()), {}
    while len(done) < len(sizes):
        rest = total - sum(done.values())
        level = rest / sum(weight[s] for s in sizes if s not in done)
        over = [s for s in sizes if s not in done and weight[s] * level > most * sizes[s]]
        if not over:
            return done | {s: weight[s] * level for s in sizes if s not in done}
        done |= {s: most * sizes[s] for s in over}
    return done


def test_targets(spark):
    rows = [("a", 100), ("b", 5), ("b", 5), (None, 50), ("ü", 70), ("Z", 400), ("", 0), ("c", 30)]
    found = source_targets(spark.createDataFrame(rows, "source string, size long")).collect()
    sizes = {}
    for s, n in rows:
        sizes[s] = sizes.get(s, 0) + n
    expected = brute_targets(sizes)
    assert {r["source"] for r in found} == set(expected)
    assert all(math.isclose(r["target"], expected[r["source"]], abs_tol=1e-9) for r in found)


def test_flight_keeps_words_and_count():
    rng = np.random.default_rng(0)
    for _ in range(50):
        n = int(rng.integers(0, 200))
        chance, size = rng.random(n), rng.integers(0, 50, n)
        value = flight(chance, size)
        assert ((value > 0) & (value < 1)).sum() <= 2
        assert np.isclose(value.sum(), chance.sum()) and np.isclose(value @ size, chance @ size)
        assert set(decide_block(chance, size, last=True).tolist()) <= {0.0, 1.0}


def test_no_size_is_preferred():
    rng = np.random.default_rng(7)
    for wanted in (0.1, 0.25, 0.75):
        size = np.round(np.exp(rng.normal(5, 1, 20_000))).astype(np.int64)
        taken = np.concatenate([flight(np.full(2000, wanted), size[at: at + 2000], rng.integers(0, 1 << 62, 2000))
                                for at in range(0, len(size), 2000)])
        rates = [taken[tenth].mean() for tenth in np.array_split(np.argsort(size, kind="stable"), 10)]
        assert max(abs(rate - wanted) for rate in rates) < 0.03, rates


def test_mix_of_odd_documents(odd_documents, no_documents):
    rows = mix(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    assert all(r["times"] in (0, 1, 2) and r["taken"] == r["times"] * r["size"] <= 2 * r["size"] for r in rows)
    again = mix(odd_documents.repartition(7)).collect()
    key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["row_hash"], r["copy"])
    assert [tuple(r) for r in sorted(rows, key=key)] == [tuple(r) for r in sorted(again, key=key)]
    mixed = mixed_rows(odd_documents)
    assert mixed.columns == odd_documents.columns and mixed.count() == sum(r["times"] for r in rows)
    assert mix(no_documents).count() == 0 and mixed_rows(no_documents).count() == 0


def test_sources_come_near_their_targets(spark):
    docs = spark.range(6000).select(
        F.col("id").alias("doc_id"),
        F.concat(F.lit("s"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7)).alias("source"),
        F.repeat(F.lit("w "), (1 + F.col("id") % 50).cast("int")).alias("text"),
    )
    drawn = mix(docs).groupBy("source").agg(
        F.sum("taken").alias("taken"), F.first("target").alias("target"), F.sum("size").alias("size"),
        F.first("source_size").alias("source_size"),
    ).collect()
    for r in drawn:
        assert r["size"] == r["source_size"] and abs(r["taken"] - r["target"]) <= 50
