import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from starloom.llm import alignment
from starloom.llm.alignment import Aligner, PerfectHash, Vocabularies, aligned_documents, cut_text, pair_table


@pytest.fixture(scope="module")
def vocabularies():
    return Vocabularies.read(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def sides(vocabularies):
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, vocabularies.b(), vocabularies.a_bytes(), vocabularies.b_bytes()


def groups_of(text, sides):
    """Groups (A ids, B ids) of a text by byte offsets of the whole text, None where the bytes differ."""
    a, b, a_bytes, b_bytes = sides
    if not text:
        return None
    ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    tokens = [a_bytes[i] for i in ids[0]], [b_bytes[i] for i in ids[1]]
    want = (" " + text).encode()
    if any(b"".join(side) != want for side in tokens):
        return None
    ends = [np.cumsum([len(t) for t in side]).tolist() for side in tokens]
    shared = sorted(set(ends[0]) & set(ends[1]))
    out, low = [], 0
    for end in shared:
        out.append(tuple([i for i, e in zip(side, at) if low < e <= end] for side, at in zip(ids, ends)))
        low = end
    return out


def brute(rows, sides):
    found = [(i, groups_of(text, sides)) for i, text in rows]
    counts = Counter((g[0][-1], g[1][-1]) for _, groups in found for g in groups or [])
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(n, best.get(b, 0))
    out = []
    for i, groups in found:
        if not groups:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        links = [(g[0][-1], g[1][-1]) for g in groups]
        said = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((i, sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups), len(links),
                    sum(counts[pair] == best[pair[1]] for pair in links), sum(counts[pair] for pair in links),
                    hashlib.sha256(said.encode()).hexdigest()))
    return sorted(out, key=repr)


def strange_texts():
    rng = random.Random(4)
    alphabet = ["a", "b", " ", "  ", "\n", "\t", "é", "日本", "▁", "'s", "I'll", "9", "12 345", "…", " ", "\x85", "​", "<s>",
                "</s>", "<unk>", "<0x41>", "<|endoftext|>", "the", "word", "x́", "ﬁ", "\x00", "🙂", "-", ".", "A", " "]
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 25))) for _ in range(400)]


def answers(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def test_pieces_give_what_the_whole_text_gives(vocabularies, sides):
    aligner = Aligner(vocabularies)
    for text in strange_texts():
        pieces = cut_text(text)
        assert " ".join(pieces) == text
        found, whole = aligner([text], [pieces]), groups_of(text, sides)
        assert found.a_ids.tolist() == [i for g in whole or [] for i in g[0]]
        assert found.b_ids.tolist() == [i for g in whole or [] for i in g[1]]
        assert len(found.a_last) == len(whole or [])


def test_the_rank_form_of_the_first_vocabulary_is_the_same_tokenizer(vocabularies, sides):
    """Every code point beside letters, digits and spaces (each tenth here; all were compared once)."""
    points = [c for c in range(0, 0x110000, 10) if not 0xD800 <= c < 0xE000] + list(range(0x3000))
    texts = [f" x{chr(c)}y 1{chr(c)}2 {chr(c)} .{chr(c)}" for c in points]
    fast, vocabulary = vocabularies.a(), sides[0]
    for at in range(0, len(texts), 5000):
        part = texts[at: at + 5000]
        for text, found in zip(part, vocabulary.encode_batch(part, add_special_tokens=False)):
            assert fast.encode_ordinary(text) == found.ids


@pytest.mark.parametrize("known", [1 << 17, 20])
def test_against_whole_texts(spark, vocabularies, sides, odd_documents, no_documents, monkeypatch, known):
    monkeypatch.setattr(alignment, "KNOWN_PIECES", known)
    monkeypatch.setattr(alignment, "PIECES_AT_ONCE", 64 if known == 20 else 1 << 16)
    rows = [(r["doc_id"], r["text"]) for r in odd_documents.select("doc_id", "text").collect()]
    assert answers(aligned_documents(odd_documents, vocabularies)) == brute(rows, sides)
    rows = list(enumerate(strange_texts()))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert answers(aligned_documents(docs, vocabularies)) == brute(rows, sides)
    assert aligned_documents(no_documents, vocabularies).collect() == []


def test_the_vocabularies_bound_the_pairs(spark, vocabularies, odd_documents):
    bound = vocabularies.pair_bound()
    a_bytes, b_bytes = vocabularies.a_bytes(), vocabularies.b_bytes()
    table = pair_table(odd_documents.select("text"), vocabularies)
    pairs = np.concatenate(list(table.keys.values()))
    assert 0 < len(pairs) <= bound <= alignment.MOST_PAIRS
    for pair in pairs.tolist():
        x, y = a_bytes[pair >> 32], b_bytes[pair & 0xFFFFFFFF]
        assert x.endswith(y) or y.endswith(x)


def test_perfect_hashes_are_minimal_and_keys_are_verified(spark, vocabularies, odd_documents):
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 63, 1000, 20_000):
        keys = np.unique(rng.integers(-(1 << 62), 1 << 62, n))
        assert sorted(PerfectHash.build(keys).slots(keys).tolist()) == list(range(len(keys)))
    table = pair_table(odd_documents.select("text"), vocabularies)
    with pytest.raises(RuntimeError):
        table.look_up(np.array([(50_000 << 32) | 7], dtype=np.int64))


def test_both_tokenizers_run_on_a_piece_once(vocabularies, sides):
    aligner = Aligner(vocabularies)
    seen = {"a": [], "b": []}

    class Heard:
        def __init__(self, side, inner):
            self.side, self.inner = side, inner

        def encode(self, texts, **options):
            seen[self.side] += texts if isinstance(texts, list) else [texts]
            return self.inner.encode(texts, **options)

        def encode_to_numpy(self, text, **options):
            seen[self.side].append(text)
            return self.inner.encode_to_numpy(text, **options)

    aligner.a, aligner.b = Heard("a", aligner.a), Heard("b", aligner.b)
    text = "One text\n of several pieces, said again: one text"
    for _ in range(2):
        found = aligner([text] * 30, [cut_text(text)] * 30)
        whole = groups_of(text, sides)
        assert found.a_ids.tolist() == [i for g in whole for i in g[0]] * 30
        assert found.b_ids.tolist() == [i for g in whole for i in g[1]] * 30
        assert np.diff(found.link_from).tolist() == [len(whole)] * 30
    for side in "ab":
        assert sum(map(len, seen[side])) <= len(text) + 1


def test_pieces_of_texts_that_cannot_be_aligned(spark, vocabularies, sides):
    """Their pairs are in no count, also where the same pieces stand in other texts."""
    rows = [(1, "zyxqword quorvex ▁ zyxqword plain"), (2, "plain words"), (3, None), (4, " led ▁"), (5, "plain quorvex\t end ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    assert answers(aligned_documents(docs, vocabularies)) == brute(rows, sides)
