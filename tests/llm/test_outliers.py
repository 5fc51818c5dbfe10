import random
import re
from collections import Counter

import numpy as np

from starloom.llm.outliers import FLOORS, SHARE, SHARE_QUANTILE, STEPS, judge_documents, minimum_covariance, repeat_words


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(tuple(words[i: i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if grams[tuple(words[i: i + 5])] > 1 for j in range(i, i + 5)}
    seen, same = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            same += line in seen
        seen.add(line)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return len(words), sum(map(len, words)), symbols, same, len(covered), failed


def test_counts(odd_documents, no_documents):
    texts = {r["doc_id"]: r["text"] for r in odd_documents.collect() if r["doc_id"] != 7}
    rows = judge_documents(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    for r in rows:
        if r["doc_id"] != 7 and r["doc_id"] is not None:
            got = tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"))
            assert got == brute(texts[r["doc_id"]])
        assert not (r["base_failed"] and r["kept"])
    assert judge_documents(no_documents).count() == 0


def test_repeat_words_with_many_distinct_words():
    rng = random.Random(3)
    for size in (5, 6, 40, 3000):
        words = [b"w%d" % rng.randrange(size) for _ in range(3 * size)]
        assert repeat_words(words) == brute(" ".join(w.decode() for w in words))[4]
    distinct = [b"%d" % i for i in range(9000)]
    assert repeat_words(distinct + distinct[:7]) == 14


def test_outliers_of_a_group_go_and_clean_documents_stay(spark):
    rng = random.Random(6)
    clean = [" ".join("".join(rng.choice("abcdefg") for _ in range(rng.randrange(2, 9))) for _ in range(rng.randrange(40, 400))) for _ in range(400)]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(clean)]
    rows += [(1000 + i, " ".join(f"{w}###$$$" for w in clean[i].split()), "en", "s", 0) for i in range(20)]
    rows += [(2000 + i, t, "fr", f"tiny{i}", 0) for i, t in enumerate(clean[:20])]
    rows.append((3000, rows[400][1], "fr", "tiny0", 0))
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, x int")
    verdict = {r["doc_id"]: (r["kept"], r["distance"]) for r in judge_documents(frame).collect()}
    assert all(verdict[i][0] for i in range(400))
    assert not any(verdict[1000 + i][0] for i in range(20))
    # Too few for estimates of their own, so the corpus judges them.
    assert all(verdict[2000 + i][0] and verdict[2000 + i][1] is not None for i in range(20))
    assert not verdict[3000][0]
    few = {r["doc_id"]: (r["kept"], r["distance"]) for r in judge_documents(frame.where("doc_id >= 2000")).collect()}
    assert set(few.values()) == {(True, None)}  # the whole corpus is too small


def test_estimate_matches_concentration_steps_in_numpy(spark):
    draw = np.random.default_rng(2)
    data = {}
    for g, n in (("a", 301), ("b", 57)):
        x = draw.normal(size=(n, 5)) @ draw.normal(size=(5, 5)) + draw.normal(size=5)
        x[: n // 10] += 30
        data[g] = x
    rows = [(g, i % 2, x.tolist()) for g, xs in data.items() for i, x in enumerate(xs)]
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    frame = spark.createDataFrame([(g, i % int(parts), x) for i, (g, _, x) in enumerate(rows)], "g string, salt int, x array<double>")
    got = {r["g"]: r for r in minimum_covariance(frame).collect()}
    # The sketches are exact at this size and give the smallest value that reaches the share.
    quantile = lambda v, share: np.sort(v, axis=0)[int(np.ceil(share * len(v))) - 1]
    for g, x in data.items():
        center, inverse = quantile(x, 0.5), np.diag(1 / np.square(FLOORS))
        away = lambda: np.einsum("ni,ij,nj->n", x - center, inverse, x - center)
        for _ in range(STEPS):
            near = x[away() <= quantile(away(), SHARE)]
            center, inverse = near.mean(axis=0), np.linalg.inv(np.cov(near.T, bias=True) + np.diag(np.square(FLOORS)))
        assert np.allclose(got[g]["model"], [*center, *inverse[np.triu_indices(5)]], rtol=1e-6, atol=1e-8)
        assert np.isclose(got[g]["scale"], quantile(away(), SHARE) / SHARE_QUANTILE)
        assert (away()[: len(x) // 10] > 75 * got[g]["scale"]).all()
