import math
import random

import numpy as np

from starloom.llm import neighbours
from starloom.llm.neighbours import balanced_parts, nearest, neighbour_graph

SCHEMA = "vec_id long, embedding array<float>, label int, part int, vector string"


def brute(rows, k=5, every=50):
    """Exact answers from (id, vector) with unique ids."""
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], dtype=np.float64)
    norm = np.sqrt((x * x).sum(axis=1))
    out = {}
    for at in np.flatnonzero(ids % every == 0):
        score = (x * x[at]).sum(axis=1) / (norm * norm[at])
        order = [j for j in np.lexsort((ids, -score)) if j != at][:k]
        out[int(ids[at])] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def answers(frame):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: (r["query_id"], r["rank"])):
        got = out.setdefault(r["query_id"], [])
        got.append((r["vec_id"], r["score"]))
        assert r["rank"] == len(got)
    return out


def test_recall_of_learned_partitions(spark):
    rng = np.random.default_rng(1)
    centers = rng.normal(size=(12, 16)) * 2
    rows = [(i, (centers[i % 12] + rng.normal(size=16)).astype(np.float32).tolist()) for i in range(3000)]
    frame = spark.createDataFrame([(i, v, 0, 0, "x") for i, v in rows], SCHEMA).repartition(4)
    got, expected = answers(nearest(frame, part_rows=300)), brute(rows)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in expected[q]}) for q in expected)
    assert set(got) == set(expected) and hits / (5 * len(expected)) >= 0.9


def test_odd_vectors_and_ties(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_BYTES", 8 * 3 * 7)  # blocks of seven rows
    rng = random.Random(2)
    usable = [(i, [float(rng.randrange(-2, 3)) for _ in range(3)]) for i in range(120)]
    usable = [(i, v if any(v) else [1.0, 0.0, 0.0]) for i, v in usable] + [(150, [1e-30, 0.0, 0.0]), (200, [3e38, 3e38, 0.0])]
    odd = [(300, None), (350, [0.0, 0.0, 0.0]), (301, [None, 1.0, 1.0]), (302, [math.nan, 1.0, 1.0]), (303, [math.inf, 1.0, 1.0]), (304, []), (305, [1.0]), (None, [1.0, 1.0, 1.0])]
    frame = spark.createDataFrame([(i, v, 0, 0, "x") for i, v in usable + odd + usable[:3]], SCHEMA).repartition(3)
    got = answers(nearest(frame))
    expected = brute(usable)
    assert set(got) == set(expected)
    for query, best in expected.items():
        assert [i for i, _ in got[query]] == [i for i, _ in best]
        assert np.allclose([s for _, s in got[query]], [s for _, s in best], rtol=0, atol=1e-15)
    few = answers(nearest(frame.where("vec_id IN (0, 1, 2)")))
    assert sorted(i for i, _ in few[0]) == [1, 2]
    assert nearest(frame.limit(0)).count() == 0
    assert nearest(frame.where("vec_id >= 300")).count() == 0


def test_scores_of_extreme_vectors(spark):
    rows = [(0, [1.0, 2.0]), (50, [2.0**-660, 2.0**-659]), (1, [2.0**-660, 2.0**-659]), (2, [2.0**660, 2.0**660]),
            (3, [2.0**1023, -(2.0**1023)]), (4, [2.0**-1074, 0.0]), (5, [3.0, 6.0]), (6, [-1.0, 1e-300])]
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, label int")
    got = answers(nearest(frame, k=8))
    small = {2: [1.0, 1.0], 1: [1.0, 2.0], 50: [1.0, 2.0], 3: [1.0, -1.0], 4: [1.0, 0.0], 6: [-1.0, 0.0]}
    expected = brute([(i, small.get(i, v)) for i, v in rows], k=8)
    for query, best in expected.items():
        assert [i for i, _ in got[query]] == [i for i, _ in best]
        assert np.allclose([s for _, s in got[query]], [s for _, s in best], rtol=0, atol=1e-15)


def test_levelling_keeps_every_bit_of_a_cosine():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(200, 12)) * 10.0 ** rng.integers(-8, 8, size=(200, 1))
    flat = neighbours._levelled(x)
    cosine = lambda v: (v[1:] * v[:-1]).sum(axis=1) / (np.sqrt((v[1:] ** 2).sum(axis=1)) * np.sqrt((v[:-1] ** 2).sum(axis=1)))
    assert (cosine(x) == cosine(flat)).all() and flat.max() < 1


def test_parts_are_balanced():
    rng = np.random.default_rng(3)
    unit = rng.normal(size=(500, 8))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    part = balanced_parts(neighbour_graph(unit), 6)
    assert np.bincount(part, minlength=6).max() <= math.ceil(1.05 * math.ceil(500 / 6))


def test_an_id_of_many_vectors_counts_once(spark):
    rows = [(0, [1.0, 0.0])] + [(7, [1.0, 0.001 * i]) for i in range(1, 7)] + [(i, [1.0, 0.1 * i]) for i in range(8, 15)]
    frame = spark.createDataFrame([(i, v, 0, 0, "x") for i, v in rows], SCHEMA)
    assert [i for i, _ in answers(nearest(frame))[0]] == [7, 8, 9, 10, 11]
