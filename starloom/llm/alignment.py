"""Cross-tokenizer alignment: which tokens of two vocabularies end together, and how often in the whole corpus.

Both tokenizers cut the bytes of a space and the text.  Where a token of A and a token of B end at the same byte, a group
ends and the two tokens are linked.  A first pass aligns all texts and writes every task's pairs; the distinct pairs get a
minimal perfect hash, built in slices; the counts become dense vectors indexed by that hash, one vector per task and slice,
and are summed in a tree.  A second pass aligns the texts again and looks the counts up, each key verified against the
pair stored in its slot.

Linked tokens end together, so the bytes of one are a suffix of the other's.  The vocabularies alone therefore bound the
number of pairs (``pair_bound``), whatever the corpus: hash, keys and counts are a few megabytes and are broadcast.

A is read from its JSON file and run as the rank file it amounts to (merges in the order of their ids, which is checked),
because that is several times faster.  Both run on pieces of the text, cut at a space between a character that is no space
and an ASCII letter: no token of B holds a space after another character, which is checked, so no merge reaches over such
a place, and A's pattern begins a pre-token there, whatever white space is before it.  A group therefore never reaches over
it either.  A task aligns each piece when it first meets it, remembers tokens and links by the number of the piece, and
puts texts together from these; offsets, groups and links of many pieces are found together, in arrays.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import ragged, stream_groups
from starloom.session import materialise

SLICES = 16  # parts of the pair table, built and summed by tasks of their own
BRANCHES = 64  # first level of the tree: tasks whose vectors are summed together
MOST_PAIRS = 1 << 22  # pairs that two vocabularies may admit at most; 17 bytes each are broadcast
BITS_PER_KEY = 2.0  # of a level of the perfect hash; levels go on until every key has a slot
KNOWN_PIECES = 1 << 19
KNOWN_CHARS = 1 << 24  # of the pieces that a task remembers; texts without spaces are one piece
PIECES_AT_ONCE = 1 << 16

_CUT = re.compile(r"(?<=[^ ]) (?=[A-Za-z])")


def _mixed(values: np.ndarray) -> np.ndarray:
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        values = (values ^ (values >> np.uint64(shift))) * np.uint64(factor)
    return values ^ (values >> np.uint64(33))


# --- the two vocabularies ---------------------------------------------------------------------------------


def byte_level_alphabet() -> dict[str, int]:
    """The bytes that the characters of a byte-level vocabulary stand for: printable characters for themselves, the others,
    in order, for the characters from U+0100 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + n): b for n, b in enumerate(rest)}}


@dataclass(frozen=True)
class Vocabularies:
    """The files of both tokenizers, read once on the driver, and the pattern of A's pre-tokens; tasks get their bytes."""

    a_json: str
    b_model: bytes
    pattern: str

    @classmethod
    def read(cls, a_path: str, b_path: str, pattern: str) -> "Vocabularies":
        with open(a_path, encoding="utf-8") as a, open(b_path, "rb") as b:
            return cls(a.read(), b.read(), pattern)

    def a_bytes(self) -> list[bytes]:
        """Bytes of A's tokens by id; an added token stands for its own text."""
        described = json.loads(self.a_json)
        alphabet = byte_level_alphabet()
        entries = {i: bytes(alphabet[c] for c in token) for token, i in described["model"]["vocab"].items()}
        entries |= {t["id"]: t["content"].encode() for t in described["added_tokens"] if t["id"] not in entries}
        return [entries.get(i, b"") for i in range(max(entries) + 1)]

    def b_bytes(self, processor=None) -> list[bytes]:
        """Bytes of B's tokens by id."""
        processor = processor or self.b()
        out = []
        for i in range(processor.vocab_size()):
            piece = processor.id_to_piece(i)
            out.append(bytes([int(piece[3:5], 16)]) if processor.is_byte(i) else piece.replace("▁", " ").encode())
        return out

    def a(self, tokens: list[bytes] | None = None):
        """A as ranks of byte strings; its added tokens, which follow the others, are never made from text."""
        import tiktoken

        described = json.loads(self.a_json)
        added = {t["id"] for t in described["added_tokens"]} - set(described["model"]["vocab"].values())
        ranks = {token: i for i, token in enumerate(tokens or self.a_bytes()) if i not in added}
        return tiktoken.Encoding("a", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={})

    def b(self):
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_proto=self.b_model)

    def check(self) -> None:
        """What the short cuts of this module rely on."""
        model = json.loads(self.a_json)["model"]
        first = len(model["vocab"]) - len(model["merges"])
        for i, merge in enumerate(model["merges"], first):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            if model["vocab"][left + right] != i:
                raise ValueError("the merges of the first vocabulary are not in the order of their ids")
        crossing = [b for b in self.b_bytes() if b" " in b.lstrip(b" ")]
        if crossing:
            raise ValueError(f"tokens of the second vocabulary reach over spaces: {crossing[:3]}")

    def pair_bound(self) -> int:
        """Number of (A, B) tokens of which one's bytes are a suffix of the other's: no text can link other pairs."""
        def by_bytes(tokens: list[bytes]) -> dict[bytes, int]:
            counts: dict[bytes, int] = {}
            for token in filter(None, tokens):
                counts[token] = counts.get(token, 0) + 1
            return counts

        a, b = by_bytes(self.a_bytes()), by_bytes(self.b_bytes())
        in_a = sum(n * b.get(token[at:], 0) for token, n in a.items() for at in range(len(token)))
        in_b = sum(n * a.get(token[at:], 0) for token, n in b.items() for at in range(1, len(token)))
        return in_a + in_b


def cut_text(text: str) -> list[str]:
    return _CUT.split(text)


class Decimals:
    """Numbers as decimal digits, each followed by a separator, in one array of bytes."""

    def __init__(self, most: int):
        digits = [str(i).encode() for i in range(most)]
        self.length = np.array([len(d) for d in digits], dtype=np.int64)
        self.digit = np.zeros((most, int(self.length.max())), dtype=np.uint8)
        for i, d in enumerate(digits):
            self.digit[i, : len(d)] = list(d)

    def written(self, numbers: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes, and where each number begins (one entry more than there are numbers)."""
        length = self.length[numbers]
        begins = np.concatenate([[0], np.cumsum(length + 1)])
        out = np.empty(int(begins[-1]), dtype=np.uint8)
        for d in range(self.digit.shape[1]):
            has = np.flatnonzero(length > d)
            out[begins[has] + d] = self.digit[numbers[has], d]
        out[begins[:-1] + length] = separators
        return out, begins


@dataclass
class Aligned:
    """Several texts, aligned.  ``a_from``, ``b_from`` and ``link_from`` say where the tokens and links of each text begin
    (one entry more than there are texts); a text that cannot be aligned has none."""

    a_ids: np.ndarray
    b_ids: np.ndarray
    a_from: np.ndarray
    b_from: np.ndarray
    link_from: np.ndarray
    a_last: np.ndarray  # place of the last token of A, and of B, in each group
    b_last: np.ndarray

    @classmethod
    def none(cls) -> "Aligned":
        ids, start = np.zeros(0, dtype=np.int32), np.zeros(1, dtype=np.int64)
        return cls(ids, ids, start, start, start, start[1:], start[1:])

    def followed_by(self, other: "Aligned") -> "Aligned":
        def shifted(mine: np.ndarray, its: np.ndarray, ids: np.ndarray) -> np.ndarray:
            return np.concatenate([mine, its + len(ids)])

        return Aligned(
            np.concatenate([self.a_ids, other.a_ids]), np.concatenate([self.b_ids, other.b_ids]),
            shifted(self.a_from, other.a_from[1:], self.a_ids), shifted(self.b_from, other.b_from[1:], self.b_ids),
            shifted(self.link_from, other.link_from[1:], self.a_last),
            shifted(self.a_last, other.a_last, self.a_ids), shifted(self.b_last, other.b_last, self.b_ids))

    def put_together(self, texts: np.ndarray, ends: np.ndarray) -> "Aligned":
        """Its texts as listed, repeats included, put together to new texts that end before the places ``ends``."""
        many = [np.diff(begins)[texts] for begins in (self.a_from, self.b_from, self.link_from)]
        first = [np.concatenate([[0], np.cumsum(m)]) for m in many]
        a, b, links = (ragged(begins[texts], m) for begins, m in zip((self.a_from, self.b_from, self.link_from), many))
        moved = [np.repeat(now[:-1] - begins[texts], many[2]) for now, begins in zip(first, (self.a_from, self.b_from))]
        begins = np.concatenate([[0], ends])
        return Aligned(self.a_ids[a], self.b_ids[b], *(now[begins] for now in first),
                       self.a_last[links] + moved[0], self.b_last[links] + moved[1])

    def pairs(self, texts: np.ndarray | None = None) -> np.ndarray:
        """One code a << 32 | b per link, of all texts or, text after text, of the given ones."""
        links = slice(None) if texts is None else ragged(self.link_from[texts], self.link_from[texts + 1] - self.link_from[texts])
        return self.a_ids[self.a_last[links]].astype(np.int64) << 32 | self.b_ids[self.b_last[links]]

    def written(self, decimals: Decimals) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3;`` of each text, b"" for one without tokens."""
        total = len(self.a_ids) + len(self.b_ids)
        numbers, separators = np.empty(total, dtype=np.int64), np.full(total, ord(","), dtype=np.uint8)
        places = []
        for ids, last, other, shift in ((self.a_ids, self.a_last, self.b_last, 0), (self.b_ids, self.b_last, self.a_last, 1)):
            ends = np.zeros(len(ids) + 1, dtype=np.int64)
            ends[last + 1] = 1
            group = np.cumsum(ends)[:-1]
            before = np.concatenate([[0], other + 1])  # tokens of the other side in the groups before, or up to this one
            places.append(np.arange(len(ids)) + before[group + shift])
            numbers[places[-1]] = ids
        separators[places[0][self.a_last]] = ord("|")
        separators[places[1][self.b_last]] = ord(";")
        written, begins = decimals.written(numbers, separators)
        raw, at = written.tobytes(), begins[self.a_from + self.b_from].tolist()
        return [raw[x:y] for x, y in zip(at, at[1:])]


class Aligner:
    """Aligns texts by their pieces.  Both tokenizers run on a piece when it is first met; its alignment, numbered in
    ``known``, is remembered until there are too many; then all are forgotten, and numbers start again."""

    def __init__(self, vocabularies: Vocabularies):
        a_bytes = vocabularies.a_bytes()
        self.a, self.b = vocabularies.a(a_bytes), vocabularies.b()
        self.b_bytes = vocabularies.b_bytes(self.b)
        self.a_length = np.array([len(t) for t in a_bytes], dtype=np.int64)
        self.b_length = np.array([len(t) for t in self.b_bytes], dtype=np.int64)
        self.forgotten = 0  # times
        self._forget()

    def _forget(self) -> None:
        fresh: list[str] = []

        class Numbers(dict):
            def __missing__(self, piece: str) -> int:
                self[piece] = number = len(self)
                fresh.append(piece)
                return number

        self.fresh, self.numbers = fresh, Numbers()
        self.known, self.chars = Aligned.none(), 0
        self.unlike = np.zeros(0, dtype=bool)  # pieces of which B's tokens give other bytes

    def _gives(self, ids: list[int], text: str) -> bool:
        return b"".join([self.b_bytes[i] for i in ids]) == b" " + text.encode()

    def _a_ids(self, pieces: list[str]) -> np.ndarray:
        """A's tokens of all pieces.  Where no space meets the one between two pieces, A cuts there, so they run as one text."""
        parts = [np.zeros(0, dtype=np.uint32)]
        for bare, run in itertools.groupby(pieces, lambda p: p.strip() == p != ""):
            parts += [self.a.encode_to_numpy(" " + text, disallowed_special=()) for text in ([" ".join(run)] if bare else run)]
        return np.concatenate(parts).astype(np.int32)

    def _align(self, pieces: list[str]) -> tuple[Aligned, np.ndarray]:
        """The pieces, aligned, and which of them are unlike what B's tokens give; those have no tokens."""
        made = self.b.encode(pieces, num_threads=1)
        wanted = [b" " + p.encode() for p in pieces]
        size = np.fromiter(map(len, wanted), dtype=np.int64, count=len(wanted))
        unlike = np.zeros(len(pieces), dtype=bool)
        many = np.fromiter(map(len, made), dtype=np.int64, count=len(made))
        b_ids = np.fromiter(itertools.chain.from_iterable(made), dtype=np.int32, count=int(many.sum()))
        b_from = np.concatenate([[0], np.cumsum(many)])
        length = np.diff(np.concatenate([[0], np.cumsum(self.b_length[b_ids])])[b_from])
        alike = np.array_equal(length, size)
        if not alike or b"".join(map(self.b_bytes.__getitem__, b_ids.tolist())) != b"".join(wanted):
            unlike = np.array([not self._gives(ids, p) for p, ids in zip(pieces, made)], dtype=bool)
            b_ids = b_ids[np.repeat(~unlike, many)]
            b_from = np.concatenate([[0], np.cumsum(np.where(unlike, 0, many))])
            size = np.where(unlike, 0, size)
            pieces = list(itertools.compress(pieces, ~unlike))
        a_ids = self._a_ids(pieces)
        a_end, b_end = np.cumsum(self.a_length[a_ids]), np.cumsum(self.b_length[b_ids])
        starts = np.concatenate([[0], np.cumsum(size)])
        a_from = np.searchsorted(a_end, starts, side="right")
        if not np.array_equal(np.concatenate([[0], a_end])[a_from], starts):
            raise RuntimeError("tokens of the first vocabulary reach over pieces")
        place = np.searchsorted(b_end, a_end)  # both sides of every piece have the same bytes
        together = b_end[place] == a_end if len(b_end) else np.zeros(0, dtype=bool)
        link_from = np.concatenate([[0], np.cumsum(together)])[a_from]
        return Aligned(a_ids, b_ids, a_from, b_from, link_from, np.flatnonzero(together), place[together]), unlike

    def _learn(self) -> None:
        if not self.fresh:
            return
        self.chars += sum(map(len, self.fresh))
        aligned, unlike = self._align(self.fresh)
        self.fresh.clear()
        self.known = self.known.followed_by(aligned)
        self.unlike = np.concatenate([self.unlike, unlike])

    def numbered(self, texts: list[str | None], cut: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the known pieces that make up the texts, one text after the other, and where each text ends."""
        if len(self.numbers) > KNOWN_PIECES or self.chars > KNOWN_CHARS:
            self._forget()
            self.forgotten += 1
        ends = np.cumsum([len(pieces) for pieces in cut], dtype=np.int64)
        many = int(ends[-1]) if len(ends) else 0
        found = np.fromiter(map(self.numbers.__getitem__, itertools.chain.from_iterable(cut)), dtype=np.int64, count=many)
        self._learn()
        strange = np.unique(np.searchsorted(ends, np.flatnonzero(self.unlike[found]), side="right"))
        if len(strange):  # such a text is one piece, if B gives back the whole of it, or cannot be aligned
            rows = np.split(found, ends[:-1])
            for row in strange.tolist():
                rows[row] = np.array([self.numbers[texts[row]]], dtype=np.int64)
            self._learn()
            rows = [row[~self.unlike[row]] for row in rows]
            found, ends = np.concatenate(rows), np.cumsum([len(row) for row in rows])
        return found, ends

    def __call__(self, texts: list[str | None], cut: list[list[str]]) -> Aligned:
        found, ends = self.numbered(texts, cut)
        return self.known.put_together(found, ends)


def _text_groups(column: pa.Array) -> Iterator[tuple[list[str | None], list[list[str]]]]:
    """Texts and their pieces, about ``PIECES_AT_ONCE`` pieces at a time."""
    texts, cut, held = [], [], 0
    for value in column:
        text = value.as_py()
        texts.append(text)
        cut.append(cut_text(text) if text else [])
        held += len(cut[-1])
        if held >= PIECES_AT_ONCE:
            yield texts, cut
            texts, cut, held = [], [], 0
    if texts:
        yield texts, cut


# --- first pass: pairs of every task -----------------------------------------------------------------------


def task_pairs(texts: DataFrame, vocabularies: Vocabularies) -> DataFrame:
    """(pair, n): the linked pairs of every task with their number."""
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(vocabularies)
        pairs, n = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        for batch in batches:
            for texts, cut in _text_groups(batch.column(0)):
                found, _ = aligner.numbered(texts, cut)
                times = np.bincount(found)
                met = np.flatnonzero(times)
                links = np.diff(aligner.known.link_from)[met]
                pairs, at = np.unique(np.concatenate([pairs, aligner.known.pairs(met)]), return_inverse=True)
                total = np.zeros(len(pairs), dtype=np.int64)
                np.add.at(total, at, np.concatenate([n, np.repeat(times[met], links)]))
                n = total
        yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(n)], names=["pair", "n"])

    return texts.mapInArrow(count, "pair long, n long")


# --- minimal perfect hash and dense vectors ----------------------------------------------------------------


class PerfectHash:
    """A minimal perfect hash of distinct 64-bit keys: levels of bit arrays, in which a bit stands for the one key that
    falls on it, and keys that share a place go on to the next level.  The slot of a key is the number of bits before
    its own.  ``words`` holds the levels one after the other."""

    def __init__(self, sizes: list[int], words: np.ndarray):
        self.sizes, self.words = sizes, words
        counts = np.bitwise_count(words).astype(np.int64)
        self.before = np.cumsum(counts) - counts

    @classmethod
    def build(cls, keys: np.ndarray) -> "PerfectHash":
        sizes, levels = [], []
        while len(keys):
            size = -(-max(64, int(len(keys) * BITS_PER_KEY)) // 64) * 64
            place = cls._places(keys, len(sizes), size)
            alone = np.bincount(place, minlength=size) == 1
            levels.append(np.packbits(alone, bitorder="little").view(np.uint64))
            sizes.append(size)
            keys = keys[~alone[place]]
        return cls(sizes, np.concatenate([np.zeros(0, dtype=np.uint64), *levels]))

    @staticmethod
    def _places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        seed = np.uint64((level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        return (_mixed(keys.view(np.uint64) + seed) % np.uint64(size)).astype(np.int64)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of every key; -1 or any slot for a key that was not built in."""
        found = np.full(len(keys), -1, dtype=np.int64)
        rest = np.arange(len(keys))
        base = 0
        for level, size in enumerate(self.sizes):
            if not len(rest):
                break
            place = self._places(keys[rest], level, size)
            word, bit = base + place // 64, (place % 64).astype(np.uint64)
            hit = (self.words[word] >> bit & np.uint64(1)).astype(bool)
            low = self.words[word[hit]] & ((np.uint64(1) << bit[hit]) - np.uint64(1))
            found[rest[hit]] = self.before[word[hit]] + np.bitwise_count(low)
            rest = rest[~hit]
            base += size // 64
        return found


def _slice_of(pairs: np.ndarray) -> np.ndarray:
    return (_mixed(pairs.view(np.uint64)) >> np.uint64(8)) % np.uint64(SLICES)


class PairTable:
    """Hash, keys and, once summed, counts of all linked pairs."""

    def __init__(self, slices: dict[int, tuple[list[int], bytes, bytes]]):
        self.hashes = {s: PerfectHash(sizes, np.frombuffer(words, dtype=np.uint64)) for s, (sizes, words, _) in slices.items()}
        self.keys = {s: np.frombuffer(keys, dtype=np.int64) for s, (_, _, keys) in slices.items()}
        self.counts: dict[int, np.ndarray] = {}
        self.best = np.zeros(0, dtype=np.int64)

    def by_slice(self, pairs: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(slice, places in ``pairs``, slots); raises for a pair that the first pass did not see."""
        slices = _slice_of(pairs)
        for s in np.unique(slices).tolist():
            mine = np.flatnonzero(slices == s)
            slots = self.hashes[s].slots(pairs[mine]) if s in self.hashes else np.full(len(mine), -1)
            if (slots < 0).any() or (self.keys[s][slots] != pairs[mine]).any():
                raise RuntimeError("a linked pair is not in the table; the documents changed between the passes")
            yield s, mine, slots

    def with_counts(self, counts: dict[int, bytes]) -> "PairTable":
        self.counts = {s: np.frombuffer(c, dtype=np.int64) for s, c in counts.items()}
        targets = [keys & 0xFFFFFFFF for keys in self.keys.values()]
        self.best = np.zeros(1 + max((int(t.max()) for t in targets if len(t)), default=-1), dtype=np.int64)
        for s, target in zip(self.keys, targets):
            np.maximum.at(self.best, target, self.counts[s])
        return self

    def look_up(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count of every pair, and whether it is the highest of its B token."""
        counts = np.zeros(len(pairs), dtype=np.int64)
        for s, mine, slots in self.by_slice(pairs):
            counts[mine] = self.counts[s][slots]
        return counts, counts == self.best[pairs & 0xFFFFFFFF]


def _hashed(counted: DataFrame) -> PairTable:
    """The perfect hash of the distinct pairs; every slice is built by a task, and what the driver collects is bounded by
    ``pair_bound``."""
    def slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = batch.column(0).to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(_slice_of(pairs).astype(np.int32)), pa.array(pairs)], names=["slice", "pair"])

    def build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in stream_groups(batches, ["slice"]):
            pairs = np.ascontiguousarray(group["pair"])
            made = PerfectHash.build(pairs)
            keys = np.empty_like(pairs)
            keys[made.slots(pairs)] = pairs
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(group["slice"][0])], type=pa.int32()), pa.array([made.sizes], type=pa.list_(pa.int32())),
                 pa.array([made.words.tobytes()], type=pa.binary()), pa.array([keys.tobytes()], type=pa.binary())],
                names=["slice", "sizes", "words", "keys"])

    sliced = counted.select("pair").distinct().mapInArrow(slices, "slice int, pair long")
    built = sliced.repartition("slice").sortWithinPartitions("slice", "pair").mapInArrow(
        build, "slice int, sizes array<int>, words binary, keys binary")
    return PairTable({r["slice"]: (list(r["sizes"]), bytes(r["words"]), bytes(r["keys"])) for r in built.collect()})


def _summed(counted: DataFrame, table: PairTable, shared) -> dict[int, bytes]:
    """Dense count vectors per slice: one of every task, added up in a tree of two levels, each a stream of vectors."""
    schema = "branch int, slice int, counts binary"

    def rows(branch: int, vectors: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for s, vector in vectors.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([branch], type=pa.int32()), pa.array([s], type=pa.int32()), pa.array([vector.tobytes()], type=pa.binary())],
                names=["branch", "slice", "counts"])

    def vectors(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, made = shared.value, {}
        for batch in batches:
            pairs, n = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for s, mine, slots in table.by_slice(pairs):
                if s not in made:
                    made[s] = np.zeros(len(table.keys[s]), dtype=np.int64)
                np.add.at(made[s], slots, n[mine])
        yield from rows(TaskContext.get().partitionId() % BRANCHES, made)

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for branch, s, counts in zip(*(batch.column(c) for c in range(3))):
                key, vector = (branch.as_py(), s.as_py()), np.frombuffer(counts.as_buffer(), dtype=np.int64)
                if key not in held:  # sorted: the groups before are complete
                    for done, total in held.items():
                        yield from rows(done[0], {done[1]: total})
                    held = {key: vector.copy()}
                else:
                    held[key] += vector
        for done, total in held.items():
            yield from rows(done[0], {done[1]: total})

    level = counted.mapInArrow(vectors, schema)
    for keys in (["branch", "slice"], ["slice"]):
        level = level.withColumn("branch", F.col("branch") if "branch" in keys else F.lit(0))
        level = level.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(add, schema)
    return {r["slice"]: bytes(r["counts"]) for r in level.collect()}


# --- second pass -------------------------------------------------------------------------------------------


_FIELDS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


class DescribedPieces:
    """What the result says of texts, added up from what it says of their pieces.  A piece is described when the first text
    that can be aligned has it: the first pass has counted the pairs of such texts only."""

    def __init__(self, aligner: Aligner, table: PairTable):
        self.aligner, self.table = aligner, table
        self.decimals = Decimals(max(len(aligner.a_length), len(aligner.b_length)))
        self.forgotten = -1

    def _describe(self, found: np.ndarray) -> None:
        if self.forgotten != self.aligner.forgotten:
            self.forgotten = self.aligner.forgotten
            self.facts, self.written = np.zeros((0, len(_FIELDS)), dtype=np.int64), []
            self.done = np.zeros(0, dtype=bool)
        more = len(self.aligner.numbers) - len(self.written)
        self.facts = np.concatenate([self.facts, np.zeros((more, len(_FIELDS)), dtype=np.int64)])
        self.done = np.concatenate([self.done, np.zeros(more, dtype=bool)])
        self.written += [b""] * more
        fresh = np.unique(found[~self.done[found]])
        pieces = self.aligner.known.put_together(fresh, np.arange(1, len(fresh) + 1))
        pairs, at = np.unique(pieces.pairs(), return_inverse=True)
        counts, best = self.table.look_up(pairs)
        sums = [np.concatenate([[0], np.cumsum(values[at])])[pieces.link_from] for values in (best.astype(np.int64), counts)]
        columns = [pieces.a_from, pieces.b_from, pieces.link_from, pieces.link_from, *sums]
        self.facts[fresh] = np.stack([np.diff(c) for c in columns], axis=1)
        for piece, written in zip(fresh.tolist(), pieces.written(self.decimals)):
            self.written[piece] = written
        self.done[fresh] = True

    def __call__(self, texts: list[str | None], cut: list[list[str]]) -> tuple[np.ndarray, list[str]]:
        """The numbers of ``_FIELDS``, a line for each text, and SHA-256 of ``a1,a2|b1;a3|b2,b3``, '' without tokens."""
        found, ends = self.aligner.numbered(texts, cut)
        self._describe(found)
        begins = np.concatenate([[0], ends])
        total = np.concatenate([np.zeros((1, len(_FIELDS)), dtype=np.int64), np.cumsum(self.facts[found], axis=0)])
        pieces, digests = found.tolist(), []
        for x, y in itertools.pairwise(begins.tolist()):
            whole = b"".join([self.written[i] for i in pieces[x:y]])
            digests.append(hashlib.sha256(memoryview(whole)[:-1]).hexdigest() if whole else "")
        return np.diff(total[begins], axis=0), digests


def _aligned(text: Column, vocabularies: Vocabularies, shared) -> Column:
    schema = "struct<" + ",".join(f"{name}:long" for name in _FIELDS) + ",groups_sha256:string>"

    @F.arrow_udf(schema)
    def aligned(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        described = DescribedPieces(Aligner(vocabularies), shared.value)
        for column in texts:
            facts, digests = [np.zeros((0, len(_FIELDS)), dtype=np.int64)], []
            for group, cut in _text_groups(column):
                found, said = described(group, cut)
                facts.append(found)
                digests += said
            columns = np.concatenate(facts)
            yield pa.StructArray.from_arrays(
                [*[pa.array(np.ascontiguousarray(columns[:, c])) for c in range(len(_FIELDS))], pa.array(digests, type=pa.string())],
                names=[*_FIELDS, "groups_sha256"])

    return aligned(text)


def pair_table(texts: DataFrame, vocabularies: Vocabularies) -> PairTable:
    """Counts of all linked pairs of the texts (the first column)."""
    bound = vocabularies.pair_bound()
    if bound > MOST_PAIRS:
        raise ValueError(f"the vocabularies admit {bound} pairs, more than may be broadcast ({MOST_PAIRS})")
    vocabularies.check()
    context = texts.sparkSession.sparkContext
    counted = materialise(task_pairs(texts, vocabularies), "alignment-pairs")
    table = _hashed(counted)
    shared = context.broadcast(table)
    table = table.with_counts(_summed(counted, table, shared))
    shared.unpersist()
    return table


def aligned_documents(docs: DataFrame, vocabularies: Vocabularies, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, tokens of A and B, groups, links, links whose pair has the highest count of its B
    token in the corpus (ties included), the sum of the counts over the links, and a digest of the groups.

    Null and empty texts, and texts of which either tokenizer does not give back the bytes, have zeros and the digest ''.
    Every row counts, repeated ones too; other columns are ignored; an empty table gives an empty result.
    """
    table = pair_table(docs.select(F.col(text_col)), vocabularies)
    shared = docs.sparkSession.sparkContext.broadcast(table)
    return docs.select(F.col(id_col).alias("id"), _aligned(F.col(text_col), vocabularies, shared).alias("found")).select("id", "found.*")
