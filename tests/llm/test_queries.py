"""The registered queries on the smallest tables, whole, against brute force."""

import hashlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from test_alignment import brute as brute_alignment
from test_alignment import sides, vocabularies  # noqa: F401
from test_mixing import brute_targets
from test_neighbours import answers, brute as brute_neighbours
from test_ngram_join import brute as brute_links
from test_outliers import brute as brute_statistics
from test_secrets import brute as brute_spans
from test_simhash import brute_fingerprint, brute_roots
from test_substrings import brute as brute_substrings

from starloom.llm.bpe import read_ranks
from starloom.llm.packing import unpack_rows
from starloom.llm.queries import oracle_sql, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def run(spark):
    return lambda name: queries()[name](spark, SF)


@pytest.fixture(scope="module")
def reference():
    ranks = {token: rank for rank, token in enumerate(read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_substrings(run, documents):
    expected = brute_substrings([(i, r["text"]) for i, r in documents.items()])
    assert {r[0]: tuple(r)[1:] for r in run("op1_substrings").collect()} == expected


def test_mixing(run, documents):
    size = {i: len((r["text"] or "").encode().split()) for i, r in documents.items()}
    by_source = {}
    for i, r in documents.items():
        by_source[r["source"]] = by_source.get(r["source"], 0) + size[i]
    target, taken = brute_targets(by_source), {}
    rows = run("op2_mixing").collect()
    assert len(rows) == len(documents)
    for r in rows:
        source = documents[r["doc_id"]]["source"]
        assert (r["size"], r["source_size"]) == (size[r["doc_id"]], by_source[source]) and r["taken"] <= 2 * r["size"]
        assert np.isclose(r["target"], target[source])
        taken[source] = taken.get(source, 0) + r["taken"]
    assert abs(sum(taken.values()) - sum(target.values())) < 0.02 * sum(target.values())
    assert sorted(map(tuple, rows)) == sorted(map(tuple, run("op2_mixing").collect()))


def test_packing(run, documents, reference):
    pieces = {}
    for r in unpack_rows(run("op3_packing")).collect():
        pieces.setdefault(r["doc_id"], []).append((r["piece"], r["ids"]))
    for i, r in documents.items():
        assert [t for _, ids in sorted(pieces.get(i, [])) for t in ids] == reference.encode_ordinary(r["text"] or "")


def test_secrets(run, documents):
    kinds = ["assign", "access", "hex"]
    for r in run("op4_secrets").collect():
        found = brute_spans(documents[r["doc_id"]]["text"])
        said = ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in found)
        assert r["base_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in kinds] == [sum(x[1] == i for x in found) for i in range(3)]
        assert set(filter(None, said.split(","))) <= set(r["spans"].split(","))


def test_chat(run, spark):
    turns = {}
    for r in spark.read.parquet(f"{SF}/conversations.parquet").collect():
        turns.setdefault(r["conv_id"], []).append((r["turn"], r["role"], r["text"] or ""))
    turns[-7] = [(0, "user", "</s>[INST] ok [/INST]"), (1, "assistant", "</s>[INST] ok [/INST]")]
    rows = run("op5_chat").collect()
    assert {r["conv_id"] for r in rows} == set(turns)
    for r in rows:
        own = sorted(turns[r["conv_id"]])
        whole = "".join(f"{role}\n{text}\n" for _, role, text in own)
        loss = "".join(text for _, role, text in own if role == "assistant")
        assert (r["n_turns"], r["turns_sha256"]) == (len(own), hashlib.sha256(whole.encode()).hexdigest())
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_toxicity(run, documents):
    rows = run("op6_toxicity").collect()
    assert {r["doc_id"] for r in rows} == set(documents) and all(r["toxic"] == (r["p_toxic"] >= 0.5) for r in rows)


def test_outliers(run, documents):
    for r in run("op7_outliers").collect():
        got = tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"))
        assert got == brute_statistics(documents[r["doc_id"]]["text"]) and not (r["base_failed"] and r["kept"])


def test_simhash(run, documents):
    prints = {i: brute_fingerprint(r["text"]) for i, r in documents.items()}
    root = brute_roots(prints.values())
    least = {}
    for i, value in prints.items():
        least[root[value]] = min(i, least.get(root[value], i))
    for r in run("op8_simhash").collect():
        value = prints[r["doc_id"]]
        assert (r["fingerprint"], r["component_id"]) == (f"{value:016x}", least[root[value]])


def test_bpe(run, documents, reference):
    for r in run("op9_bpe").collect():
        text = documents[r["doc_id"]]["text"] or ""
        ids = np.array(reference.encode_ordinary(text), dtype="<u4")
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_neighbours(run, spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got, expected = answers(run("op10_neighbours")), brute_neighbours(rows)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in expected[q]}) for q in expected)
    assert set(got) == set(expected) and hits / sum(map(len, expected.values())) >= 0.9


def test_ngram_join(run, documents):
    rows = [(i, documents[i]["text"]) for i in documents]
    assert sorted(map(tuple, run("op11_ngram_join").collect()), key=repr) == brute_links(rows)


def test_periodic_runs(run, documents):
    """Every text by itself against all texts together; the brute force of ``test_periodic_runs`` is for small texts."""
    from starloom.llm.periodic_runs import repeated_tail

    changed = 0
    for r in run("op12_periodic_runs").collect():
        words = (documents[r["doc_id"]]["text"] or "").encode().split()
        numbers = {w: n for n, w in enumerate(dict.fromkeys(words))}
        sequence = repeated_tail(np.array([numbers[w] for w in words], dtype=np.int64), r["doc_id"])
        changed += not np.array_equal(sequence, [numbers[w] for w in words])
        long_runs = []
        for q in range(1, len(sequence) // 4 + 1):
            same = np.concatenate([[0], (sequence[:-q] == sequence[q:]).astype(np.int8), [0]])
            edges = np.flatnonzero(np.diff(same))
            for start, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
                part = sequence[start: end + q]
                smaller = any((part[:-p] == part[p:]).all() for p in range(1, q))
                if len(part) >= max(6, 4 * q) and not smaller:
                    long_runs.append((start, len(part), q))
        said = "".join(f"{s},{n},{q}\n" for s, n, q in sorted(long_runs, key=lambda x: (x[0], x[2])))
        assert (r["n_runs"], r["runs_sha256"]) == (len(long_runs), hashlib.sha256(said.encode()).hexdigest())
        dropped = {i for s, n, q in long_runs for i in range(s + q, s + n)}
        names = list(numbers)
        kept = " ".join(names[w].decode() for i, w in enumerate(sequence.tolist()) if i not in dropped)
        assert (r["n_dropped"], r["collapsed_sha256"]) == (len(dropped), hashlib.sha256(kept.encode()).hexdigest())
    assert changed


def test_alignment(run, documents, sides):  # noqa: F811
    rows = [(i, documents[i]["text"]) for i in documents]
    assert sorted(map(tuple, run("op13_alignment").collect()), key=repr) == brute_alignment(rows, sides)


def test_sql_counterparts(run):
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
        for name, sql in oracle_sql().items():
            frame = run(name)
            found = db.execute(f"SELECT {', '.join(frame.columns)} FROM ({sql})").fetchall()
            assert sorted(map(tuple, frame.collect())) == sorted(found), name
