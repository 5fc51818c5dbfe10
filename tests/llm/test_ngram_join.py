import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.llm import ngram_join
from starloom.llm.ngram_join import Shingler, bitmap, choose_boundary, linked_documents, need, prefix_length, subset_keys

_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute_set(text):
    words = (text or "").translate(_LOWER).encode().split()
    return {tuple(words[i: i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    """{position: (size, smallest id reachable)} of rows (id, text)."""
    sets = [brute_set(text) for _, text in rows]
    label = list(range(len(rows)))
    for i, j in itertools.combinations(range(len(rows)), 2):
        common = len(sets[i] & sets[j])
        if common and 100 * common >= 80 * len(sets[i] | sets[j]) and label[i] != label[j]:
            label = [label[i] if x == label[j] else x for x in label]
    out = []
    for i, x in enumerate(label):
        ids = [rows[j][0] for j, y in enumerate(label) if y == x and rows[j][0] is not None]
        out.append((rows[i][0], len(sets[i]), min(ids) if ids else None))
    return sorted(out, key=repr)


def copies(seed=3, family=90):
    """Texts of 100 words changed in some places, copies of copies, short texts one word apart, and a shared passage."""
    rng = random.Random(seed)
    prose = lambda n: [f"w{rng.randrange(500)}" for _ in range(n)]
    passage, texts = prose(60), [prose(100) for _ in range(6)]
    for _ in range(family):
        words = list(rng.choice(texts))
        for _ in range(rng.randrange(1, 5)):
            words[rng.randrange(len(words))] = "changed"
        texts.append(words)
    texts += [passage + prose(rng.randrange(8, 30)) for _ in range(40)]
    for length in (6, 8, 9, 10, 14, 20, 30):
        base = prose(length)
        texts += [base, base + prose(1), base + prose(2), prose(1) + base, base[:-1] + prose(1), base[:-1]]
    return [(i, " ".join(words)) for i, words in enumerate(texts)] + [
        (900, None), (901, " \n"), (902, ""), (903, "a few"), (904, "A few"), (905, "few a"), (906, " ".join(texts[0]).upper())]


def answers(found):
    return sorted((tuple(r) for r in found.collect()), key=repr)


@pytest.mark.parametrize("options", [{}, {"boundary": 1}, {"boundary": 12, "block_rows": 7}])
def test_no_link_is_lost(spark, options):
    rows = copies()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert answers(linked_documents(docs, **options)) == brute(rows)


def test_frequent_shingles_only_change_the_order(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "SAMPLE", 1)
    monkeypatch.setattr(ngram_join, "FREQUENT", 8)
    rows = copies(9)
    assert answers(linked_documents(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_a_large_family_just_below_the_threshold(spark):
    """Pages of one template: three quarters are shared by all, so every pair is looked at and none links."""
    rng = random.Random(1)
    template = [f"t{i}" for i in range(204)]
    rows = [(i, " ".join(template + [f"x{rng.randrange(10**9)}" for _ in range(36)])) for i in range(150)]
    found = answers(linked_documents(spark.createDataFrame(rows, "doc_id long, text string"), block_rows=40))
    assert found == brute(rows) and all(r[0] == r[2] for r in found)


def test_odd_documents(spark, odd_documents, no_documents):
    rows = [(r["doc_id"], r["text"]) for r in odd_documents.select("doc_id", "text").collect()]
    assert answers(linked_documents(odd_documents)) == brute(rows)
    assert linked_documents(no_documents).collect() == []
    clashing = odd_documents.withColumn("th", F.lit(1)).withColumn("node", F.lit("x")).withColumn("size", F.lit(1)).withColumn("sid", F.lit(0))
    assert answers(linked_documents(clashing)) == brute(rows)


def test_need_and_prefix_agree_with_the_definition():
    for a in range(1, 60):
        partners = [b for b in range(1, 90) if any(100 * i >= 80 * (a + b - i) for i in range(min(a, b) + 1))]
        assert partners == list(range(-(-4 * a // 5), 5 * a // 4 + 1))
        for b in partners:
            assert need(a, b) == min(i for i in range(min(a, b) + 1) if 100 * i >= 80 * (a + b - i))
        assert prefix_length(a) == a - min(need(a, b) for b in partners) + 1


def test_light_sets_meet_exactly_when_similar():
    rng = np.random.default_rng(2)
    for _ in range(300):
        pool = rng.integers(0, 1 << 63, 14, dtype=np.uint64)
        a, b = (np.unique(rng.choice(pool, rng.integers(2, 12), replace=False)) for _ in range(2))
        if np.array_equal(a, b):
            continue
        common = len(np.intersect1d(a, b))
        sides = {0: 0, 1: 2, 2: 1}
        meet = bool(set(subset_keys(a, 13)) & {(key, sides[side]) for key, side in subset_keys(b, 13)})
        assert meet == (100 * common >= 80 * (len(a) + len(b) - common))


def test_bitmaps_never_exceed_the_difference():
    rng = np.random.default_rng(1)
    for _ in range(60):
        pool = rng.integers(0, 1 << 63, 900, dtype=np.uint64)
        a, b = (np.unique(rng.choice(pool, rng.integers(1, 800))) for _ in range(2))
        maps = np.array([bitmap(a), bitmap(b)], dtype=object)
        bits = ngram_join._Bitmaps(maps).differing(np.array([0]), np.array([1]))[0]
        assert bits <= len(np.setxor1d(a, b))


def test_the_boundary_follows_the_cost():
    assert choose_boundary({s: 100 for s in range(1, 40)}, 1.0) <= choose_boundary({s: 100 for s in range(1, 40)}, 10_000.0)


def test_blocks_of_words_do_not_change_the_set(monkeypatch):
    text = " ".join(f"Word{i % 97}" for i in range(2000)).encode()
    whole = Shingler()(text)
    monkeypatch.setattr("starloom.llm.common.word_blocks.__defaults__", (0, 64))
    assert len(whole) == 97 and np.array_equal(Shingler()(text), whole)
