import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from starloom.llm import periodic_runs as module
from starloom.llm.periodic_runs import analyse, periodic_runs


def brute_runs(words):
    """(start, length, period) by comparing all words at every distance."""
    found, n = [], len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            smaller = any(all(words[k] == words[k + p] for k in range(i, j + q - p)) for p in range(1, q))
            if length >= max(6, 4 * q) and not smaller:
                found.append((i, length, q))
            i = j
    return sorted(found, key=lambda r: (r[0], r[2]))


def changed(words, doc_id):
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def brute(doc_id, text, tails=True):
    words = (text or "").encode().split()
    words = changed(words, doc_id) if tails else words
    runs = brute_runs(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None, None, None)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    said = "".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()
    exponent = 1000 * best[1] // best[2] if runs else None
    return (doc_id, len(runs), *best, exponent, hashlib.sha256(said).hexdigest(), hashlib.sha256(kept).hexdigest(), len(dropped))


def runs_of(sequences):
    names = [str(i).encode() for i in range(max((max(s) for s in sequences if s), default=0) + 1)]
    return analyse([np.array(s, dtype=np.int64) for s in sequences], names)


def said(sequence):
    return hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in brute_runs(sequence)).encode()).hexdigest()


@pytest.mark.parametrize("seed", range(6))
def test_random_sequences(seed):
    """Few words, repeated blocks, blocks of repeated blocks, and borders between them."""
    rng = random.Random(seed)
    sequences = []
    for _ in range(60):
        kinds = rng.choice([2, 3, 5])
        word = lambda n: [rng.randrange(kinds) for _ in range(n)]
        out = []
        while len(out) < rng.choice([0, 5, 30, 120, 250]):
            block = word(rng.choice([1, 2, 3, 4, 7, 8, 9, 16, 31]))
            for _ in range(rng.randrange(3)):
                block = block * rng.choice([1, 2, 3, 4]) + word(rng.randrange(3))
            block = block * rng.choice([1, 1, 4, 5])
            out += block[: rng.randrange(1, len(block) + 1)] if rng.random() < 0.3 else block
        sequences.append(out[:400])
    for sequence, answer in zip(sequences, runs_of(sequences)):
        assert answer[5] == said(sequence), sequence


@pytest.mark.parametrize("period", [1, 2, 3, 4, 5, 7, 8, 12, 15, 16, 17, 31, 32, 33, 63, 64, 100])
def test_every_period_around_the_scales(period):
    """Runs of exactly four periods, one word more and one word less, between words of their own."""
    rng = random.Random(period)
    block = [rng.randrange(1000) for _ in range(period)]
    sequences = []
    for length in (4 * period - 1, 4 * period, 4 * period + 1, max(6, 4 * period), 9 * period):
        run = (block * (length // period + 1))[:length]
        sequences += [run, [5000, 5001] + run + [5002], run + [7000] + run]
    for sequence, answer in zip(sequences, runs_of(sequences)):
        assert answer[5] == said(sequence)


def test_thue_morse_and_fibonacci_words():
    """Words full of squares, without fourth powers; and one with nested ones."""
    thue = [bin(i).count("1") % 2 for i in range(512)]
    a, b = [0], [0, 1]
    while len(b) < 400:
        a, b = b, b + a
    nested = (([0] * 8 + [1]) * 5 + [2]) * 5
    for sequence, answer in zip([thue, b, nested], runs_of([thue, b, nested])):
        assert answer[5] == said(sequence)


def test_collapsed_texts_and_ties():
    assert runs_of([[]])[0][:5] == (0, None, None, None, None)
    sequence = [1, 2] * 4 + [3, 4] * 4 + [9] * 5
    assert runs_of([sequence])[0][:5] == (2, 0, 8, 2, 4000)


@pytest.mark.parametrize("batch_words", [1 << 18, 50])
def test_odd_documents(spark, odd_documents, no_documents, monkeypatch, batch_words):
    monkeypatch.setattr(module, "BATCH_WORDS", batch_words)
    rows = [(r["doc_id"], r["text"]) for r in odd_documents.select("doc_id", "text").collect()]
    for tails in (True, False):
        found = [tuple(r) for r in periodic_runs(odd_documents, repeat_tails=tails).collect()]
        assert sorted(found, key=repr) == sorted((brute(i, t if len(t or "") < 5000 else t, tails) for i, t in rows), key=repr)
    assert periodic_runs(no_documents).collect() == []


def test_blocks_of_words_do_not_change_the_answer(spark, monkeypatch):
    text = " ".join(["lead"] * 3 + [f"v{i % 11}" for i in range(300)] + ["tail"] * 7)
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    whole = periodic_runs(docs).collect()
    monkeypatch.setattr("starloom.llm.common.word_blocks.__defaults__", (0, 16))
    monkeypatch.setattr(module, "JOIN_WORDS", 4)
    assert periodic_runs(docs).collect() == whole and whole[0]["n_runs"] == 2
