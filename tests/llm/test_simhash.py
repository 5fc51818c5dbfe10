import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from starloom.llm import simhash
from starloom.llm.components import connected_components
from starloom.llm.simhash import BLOCKS, fingerprint, fingerprint_bytes, keep_one, link_group, links, near_duplicates


def brute_fingerprint(text):
    table = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    words = (text or "").translate(table).encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i: i + 4]) for i in range(len(words) - 3)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_roots(values, most=4):
    values = sorted(set(values))
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for i, a in enumerate(values):
        for b in values[i + 1:]:
            if ((a ^ b) & (2**64 - 1)).bit_count() <= most:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {v: find(v) for v in values}


def test_fingerprints(plain_documents):
    for row in plain_documents.select("text", fingerprint(F.col("text")).alias("f")).collect():
        assert row["f"] & (2**64 - 1) == brute_fingerprint(row["text"])


def test_blocks_of_words_do_not_change_the_fingerprint(monkeypatch):
    text = " ".join(f"Word{i % 97}" for i in range(2000))
    for block in (4, 7, 64):
        monkeypatch.setattr("starloom.llm.common.word_blocks.__defaults__", (0, block))
        assert fingerprint_bytes(text.encode()) == brute_fingerprint(text)


def test_every_close_pair_meets_at_a_home():
    rng = random.Random(2)
    tables = [code.tables() for code in BLOCKS]

    def places(value):
        for number, (code, (starts, lengths, patterns, columns)) in enumerate(zip(BLOCKS, tables)):
            part = value >> code.shift & ((1 << len(columns)) - 1)
            syndrome = 0
            for bit, column in enumerate(columns.tolist()):
                syndrome ^= column if part >> bit & 1 else 0
            own = patterns[starts[syndrome]: starts[syndrome] + lengths[syndrome]]
            yield number, part ^ int(own[0]), {part ^ int(p) for p in own}

    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), 4):
            b ^= 1 << bit
        assert any(home in ball for (_, home, _), (_, _, ball) in zip(places(a), places(b)))


def clustered(n, seed):
    rng = random.Random(seed)
    values = []
    for _ in range(n):
        value = rng.choice(values) if values and rng.random() < 0.7 else rng.getrandbits(64)
        for bit in rng.sample(range(64), rng.randrange(7)):
            value ^= 1 << bit
        values.append(value)
    return values


@pytest.mark.parametrize("home_rows", [8192, 1])
def test_links_match_brute_force(spark, home_rows):
    values = clustered(300, 4)
    signed = [(v - 2**64 if v >= 2**63 else v,) for v in set(values)]
    edges = links(spark.createDataFrame(signed, "fp long"), home_rows=home_rows)
    found = {r["node"]: r["root"] for r in connected_components(edges).collect()}
    groups, expected = {}, {}
    for (v,) in signed:
        groups.setdefault(found.get(v, v), set()).add(v)
    for v, root in brute_roots([v for v, in signed]).items():
        expected.setdefault(root, set()).add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_large_group_path(monkeypatch):
    values = np.array(clustered(200, 9), dtype=np.uint64).view(np.int64)
    home = np.arange(200) % 3 == 0
    small = link_group(0, values, home)
    monkeypatch.setattr(simhash, "PAIRS_AT_ONCE", 10)
    large = link_group(0, values, home)
    assert sorted(zip(*map(list, small))) == sorted(zip(*map(list, large)))


def test_near_duplicates_and_keep_one(odd_documents, no_documents):
    rows = near_duplicates(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    root = brute_roots([r["fp"] for r in rows])
    least = {}
    for r in rows:
        if r["id"] is not None:
            least[root[r["fp"]]] = min(r["id"], least.get(root[r["fp"]], 1 << 60))
    assert all(r["component_id"] == least.get(root[r["fp"]]) for r in rows)

    kept = keep_one(odd_documents)
    assert kept.columns == odd_documents.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert len(ids) == len(set(root.values())) and sorted(ids) == sorted(least.values())
    assert near_duplicates(no_documents).count() == 0 and keep_one(no_documents).count() == 0


def test_components_of_chains_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100), (7, 3), (3, 7), (200, 201), (202, 201)]
    found = connected_components(spark.createDataFrame(edges, "u long, v long")).collect()
    expected = {(i, 0) for i in range(1, 41)} | {(201, 200), (202, 200)}
    assert {tuple(r) for r in found} == expected
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0
