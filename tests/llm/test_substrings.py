import hashlib
import random

from starloom.llm import substrings
from starloom.llm.substrings import segment_runs, shard_matches, substring_dedup

import numpy as np


def brute(rows, window=20):
    """(n_words, n_removed, kept_sha256) by id, from (id, text) with unique ids."""
    seen, out = set(), {}
    for doc, text in sorted(rows):
        words = (text or "").encode().split()
        stays = [True] * len(words)
        for i in range(len(words) - window + 1):
            key = tuple(words[i: i + window])
            if key in seen:
                stays[i: i + window] = [False] * window
            seen.add(key)
        kept = b" ".join(w for w, s in zip(words, stays) if s)
        out[doc] = (len(words), len(words) - sum(stays), hashlib.sha256(kept).hexdigest())
    return out


def check(found, rows):
    got = {r["id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in found.collect()}
    assert got == brute(rows)


def test_matches_brute_force(plain_documents):
    check(substring_dedup(plain_documents), [(r["doc_id"], r["text"]) for r in plain_documents.collect()])


def test_shared_passages_and_hot_anchors(spark):
    rng = random.Random(3)
    word = lambda: f"v{rng.randrange(300)}"
    passages = [[word() for _ in range(rng.randrange(15, 60))] for _ in range(4)]
    rows = []
    for doc in range(60):
        words = [word() for _ in range(rng.randrange(5, 40))]
        for _ in range(rng.randrange(3)):
            passage = list(rng.choice(passages))
            if rng.random() < 0.5:
                passage[rng.randrange(len(passage))] = "changed"
            words += passage + [word() for _ in range(rng.randrange(30))]
        rows.append((doc, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    check(substring_dedup(docs), rows)
    check(substring_dedup(docs, hot_documents=2), rows)


def test_self_repeats_and_long_runs(spark, monkeypatch):
    monkeypatch.setattr(substrings, "LONGEST_RUN", 16)
    rows = [(0, "a " * 300), (1, "a b " * 100), (2, "b a " * 100), (3, "c " * 21), (4, "c " * 20), (5, "c " * 19)]
    check(substring_dedup(spark.createDataFrame(rows, "doc_id long, text string")), rows)


def test_repeated_rows_null_ids_and_empty_table(odd_documents, no_documents):
    rows = substring_dedup(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    five = {(r["n_removed"], r["kept_sha256"]) for r in rows if r["id"] == 5}
    assert five == {(0, hashlib.sha256(odd_documents.where("doc_id = 5").first()["text"].encode()).hexdigest())}
    stray = sorted((r["n_words"], r["n_removed"]) for r in rows if r["id"] is None)
    assert stray == [(0, 0), (60, 60)]  # null ids come last, so the copy of the passage goes
    assert substring_dedup(no_documents).count() == 0


def test_automaton_against_brute_force():
    rng = random.Random(1)
    for _ in range(200):
        segments = [[rng.choice([b"a", b"b"]) for _ in range(rng.randrange(3, 14))] for _ in range(rng.randrange(1, 6))]
        seen = set()
        for words, mask in zip(segments, shard_matches(segments, window=3)):
            for i in range(len(words) - 2):
                assert mask[i] == (tuple(words[i: i + 3]) in seen)
                seen.add(tuple(words[i: i + 3]))


def test_runs_are_cut_without_loss():
    anchors = np.array([1] * 10 + [2] * 3 + [1])
    starts, sizes = segment_runs(anchors, longest=4)
    assert starts.tolist() == [0, 4, 8, 10, 13] and sizes.tolist() == [4, 4, 2, 3, 1]
