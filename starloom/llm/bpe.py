"""Byte-level BPE encoding and decoding on length-bucketed padded matrices.

The distinct pre-tokens of a stretch of text are put into padded numpy matrices by length.  In every round every row
merges its leftmost pair of least rank; ranks come from a hash table of pairs, and the rows close up behind the merge.
Rows without a pair left are taken out.  Results go to a pool that later texts of the same task look up.

Where the pattern allows it, texts are cut at spaces and newlines first; the ids of a piece, put together from those of its
pre-tokens, are remembered too, and the pattern runs on new pieces only.

Pre-tokens over ``WIDE`` bytes merge all occurrences of their least pair in one round, from the left, where no merge
of the new token can have a smaller rank; that gives what one merge at a time gives and keeps long runs affordable.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import ragged, text_bytes

NONE = np.int32(2**31 - 1)
WIDE = 64
CELLS = 1 << 20  # of one matrix
GROUP_CHARS = 1 << 21  # of the texts whose new pre-tokens are merged together
POOL_WORDS = 300_000  # pre-tokens that a task remembers; beyond, it starts anew
POOL_PIECES = 1 << 19  # and pieces,
POOL_CHARS = 1 << 24  # and their characters; texts without spaces are one piece
#: Patterns of which no pre-token holds white space after another character or looks beyond white space.
CUT_AT_SPACES = {r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""}
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def read_ranks(path: str) -> list[bytes]:
    """Tokens by rank from a file of lines ``base64 rank``."""
    with open(path, "rb") as lines:
        found = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, lines)}
    if sorted(found) != list(range(len(found))):
        raise ValueError("ranks are not 0, 1, 2, …")
    return [found[i] for i in range(len(found))]


def pair_table(tokens: list[bytes]) -> dict[str, np.ndarray]:
    """Hash table (open addressing) from pairs of token ids to the rank of their concatenation, and for every token
    whether no pair with it has a smaller rank than itself.  A few MB, whatever the data: bounded by the vocabulary."""
    rank_of = {token: rank for rank, token in enumerate(tokens)}
    found = [
        (rank_of[token[:cut]], rank_of[token[cut:]], rank)
        for rank, token in enumerate(tokens)
        for cut in range(1, len(token))
        if token[:cut] in rank_of and token[cut:] in rank_of
    ]
    a, b, rank = np.array(found, dtype=np.int64).reshape(-1, 3).T
    safe = np.ones(len(tokens), dtype=bool)
    safe[a[a > rank]] = False
    safe[b[b > rank]] = False
    bits = max(4, int(4 * len(rank) + 1).bit_length())
    keys = np.full(1 << bits, -1, dtype=np.int64)
    values = np.full(1 << bits, NONE, dtype=np.int32)
    key = a << 32 | b
    slot = _slots(key, bits)
    waiting = np.arange(len(key))
    while len(waiting):
        free = keys[slot[waiting]] == -1
        keys[slot[waiting[free]]] = key[waiting[free]]  # of several claims to one slot the last one stays
        placed = keys[slot[waiting]] == key[waiting]
        values[slot[waiting[placed]]] = rank[waiting[placed]]
        waiting = waiting[~placed]
        slot[waiting] = (slot[waiting] + 1) & ((1 << bits) - 1)
    return {"keys": keys, "values": values, "safe": safe}


def _slots(key: np.ndarray, bits: int) -> np.ndarray:
    return ((key.astype(np.uint64) * _MULTIPLIER) >> np.uint64(64 - bits)).astype(np.int64)


class Encoder:
    """Encodes pre-tokens and remembers them; one per task."""

    def __init__(self, tokens: list[bytes], table: dict[str, np.ndarray], pattern: str):
        self.rank_of = {token: rank for rank, token in enumerate(tokens)}
        self.byte_ids = np.array([self.rank_of[bytes([i])] for i in range(256)], dtype=np.int32)
        self.table, self.bits = table, len(table["keys"]).bit_length() - 1
        self.split = regex.compile(pattern)
        self.by_pieces = pattern in CUT_AT_SPACES
        self.token_bytes = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        self.token_lengths = np.array([len(token) for token in tokens], dtype=np.int64)
        self.token_starts = np.cumsum(self.token_lengths) - self.token_lengths
        self._forget()
        self._forget_pieces()

    def _forget(self) -> None:
        fresh: list[str] = []

        class Numbers(dict):
            def __missing__(self, word: str) -> int:
                self[word] = number = len(self)
                fresh.append(word)
                return number

        self.fresh, self.numbers = fresh, Numbers()
        self.pool: list[np.ndarray] = []
        self.flat = np.zeros(0, dtype=np.int32)
        self.starts = self.lengths = np.zeros(0, dtype=np.int64)

    def _forget_pieces(self) -> None:
        new: list[str] = []

        class Pieces(dict):
            def __missing__(self, piece: str) -> int:
                """-1 for a piece whose white space meets that of the next one, or begins a text: the text decides how it is
                split."""
                if not piece or piece[-1].isspace() or piece.startswith("\n\n") and piece[2].isspace():
                    self[piece] = -1
                    return -1
                number = self[piece] = self.many
                self.many += 1
                new.append(piece)
                return number

        self.new, self.pieces = new, Pieces()
        self.pieces.many = self.piece_chars = 0
        self.piece_flat = np.zeros(0, dtype=np.int32)
        self.piece_starts = self.piece_lengths = np.zeros(0, dtype=np.int64)

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, NONE where there is none or a side is padding."""
        out = np.full(a.shape, NONE, dtype=np.int32)
        real = (a >= 0) & (b >= 0)
        key = a[real].astype(np.int64) << 32 | b[real]
        slot = _slots(key, self.bits)
        result = np.full(len(key), NONE, dtype=np.int32)
        open_ = np.arange(len(key))
        mask = (1 << self.bits) - 1
        while len(open_):
            there = self.table["keys"][slot[open_]]
            hit = there == key[open_]
            result[open_[hit]] = self.table["values"][slot[open_[hit]]]
            open_ = open_[~hit & (there != -1)]
            slot[open_] = (slot[open_] + 1) & mask
        out[real] = result
        return out

    def merge(self, ids: np.ndarray, all_at_once: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(rows, their ids with padding -1) as they come to rest."""
        rows = np.arange(len(ids))
        rank = self.ranks(ids[:, :-1], ids[:, 1:])
        while len(rows):
            best = rank.min(axis=1) if rank.shape[1] else np.full(len(rows), NONE)
            rests = best == NONE
            if rests.any():
                yield rows[rests], ids[rests]
                rows, ids, rank, best = rows[~rests], ids[~rests], rank[~rests], best[~rests]
                if not len(rows):
                    return
            at = rank.argmin(axis=1)  # the leftmost
            if not all_at_once:
                lines = np.arange(len(rows))
                ids[lines, at] = best
                column = np.arange(ids.shape[1] - 1)
                ids = np.take_along_axis(ids, column + (column > at[:, None]), axis=1)
                column = column[:-1]
                rank = np.take_along_axis(rank, column + (column >= at[:, None]), axis=1)
                left, right = at > 0, at < rank.shape[1]
                rank[lines[left], at[left] - 1] = self.ranks(ids[lines[left], at[left] - 1], best[left])
                rank[lines[right], at[right]] = self.ranks(best[right], ids[lines[right], at[right] + 1])
                continue
            column = np.arange(rank.shape[1])
            hit = (rank == best[:, None]) & (self.table["safe"][best][:, None] | (column == at[:, None]))
            begins = hit.copy()
            begins[:, 1:] &= ~hit[:, :-1]
            begun = np.maximum.accumulate(np.where(begins, column, 0), axis=1)
            hit &= (column - begun) % 2 == 0  # aaa: the first two a merge, the pair after them is gone
            ids[:, :-1][hit] = np.broadcast_to(best[:, None], hit.shape)[hit]
            stays = np.ones(ids.shape, dtype=bool)
            stays[:, 1:] = ~hit
            stays &= ids >= 0
            many = stays.sum(axis=1)
            closed = np.full((len(rows), int(many.max())), -1, dtype=np.int32)
            closed[np.repeat(np.arange(len(rows)), many), ragged(np.zeros(len(rows), dtype=np.int64), many)] = ids[stays]
            ids = closed
            rank = self.ranks(ids[:, :-1], ids[:, 1:])

    def _learn(self) -> None:
        """Encode the pre-tokens that are new, by length buckets, into the pool."""
        words = [word.encode("utf-8", "replace") for word in self.fresh]
        self.fresh.clear()
        if not words:
            return
        lengths = np.ones(len(words), dtype=np.int64)
        starts = np.zeros(len(words), dtype=np.int64)
        whole = np.fromiter((self.rank_of.get(word, -1) for word in words), dtype=np.int32, count=len(words))
        parts, filled = [whole], len(whole)
        starts[:] = np.arange(len(words))
        rest = np.flatnonzero(whole < 0)
        size = np.fromiter((len(words[i]) for i in rest.tolist()), dtype=np.int64, count=len(rest))
        width = 1 << np.ceil(np.log2(np.maximum(size, 2))).astype(np.int64)
        for wide in np.unique(width).tolist():
            bucket = rest[width == wide]
            step = max(1, CELLS // wide)
            for first in range(0, len(bucket), step):
                some = bucket[first: first + step]
                long = np.fromiter((len(words[i]) for i in some.tolist()), dtype=np.int64, count=len(some))
                raw = np.frombuffer(b"".join(words[i] for i in some.tolist()), dtype=np.uint8)
                ids = np.full((len(some), int(long.max())), -1, dtype=np.int32)
                line = np.repeat(np.arange(len(some)), long)
                ids[line, ragged(np.zeros(len(some), dtype=np.int64), long)] = self.byte_ids[raw]
                for rows, done in self.merge(ids, wide > WIDE):
                    many = (done >= 0).sum(axis=1)
                    lengths[some[rows]] = many
                    starts[some[rows]] = filled + np.cumsum(many) - many
                    flat = done[done >= 0]
                    parts.append(flat)
                    filled += len(flat)
        base = len(self.flat)
        self.flat = np.concatenate([self.flat, *parts])
        self.starts = np.concatenate([self.starts, starts + base])
        self.lengths = np.concatenate([self.lengths, lengths])

    def _numbered(self, text: str) -> np.ndarray:
        number = self.numbers.__getitem__
        if len(text) <= GROUP_CHARS:
            words = self.split.findall(text)
            return np.fromiter(map(number, words), dtype=np.int32, count=len(words))
        return np.fromiter((number(found.group()) for found in self.split.finditer(text)), dtype=np.int32)

    def _cuttable(self, text: str) -> bool:
        """Spares ``_cut`` texts with frequent kinds of white space that it would return as None, and very long ones."""
        return self.by_pieces and len(text) <= GROUP_CHARS and not any(run in text for run in ("  ", "\n\n", "\n ", " \n"))

    def _cut(self, texts: list[str]) -> list[np.ndarray | None]:
        """Pieces of each text by number, None for a text that cannot be split piece by piece.

        A piece starts at a space, which is left out, or at a newline; the first of a text is marked by two newlines."""
        try:
            marked = pa.array(["\n\n" + text.replace("\n", " \n") for text in texts], type=pa.string())
        except UnicodeEncodeError:  # lone surrogates, which columns cannot hold
            return [None] * len(texts)
        cut = pc.split_pattern(marked, " ")
        coded = cut.flatten().dictionary_encode()
        pieces = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        numbers = np.fromiter(map(self.pieces.__getitem__, pieces), dtype=np.int32, count=len(pieces))
        found, offsets = numbers[coded.indices.to_numpy()], cut.offsets.to_numpy()
        whole = set(np.searchsorted(offsets, np.flatnonzero(found < 0), side="right").tolist())
        return [found[x:y] if i not in whole else None for i, (x, y) in enumerate(zip(offsets, offsets[1:]), 1)]

    def _learn_pieces(self) -> None:
        if not self.new:
            return
        # Every piece begins with white space, the first of a text with the second newline of its mark, and ends without:
        # so they are split as one text, and that newline is a pre-token.
        first = np.array([p.startswith("\n\n") for p in self.new])
        said = [p if p[0] == "\n" else " " + p for p in self.new]
        said = [p[1:] if marked else p for p, marked in zip(said, first.tolist())] if first.any() else said
        self.new.clear()
        words = self.split.findall("".join(said))
        ends = np.cumsum(np.fromiter(map(len, said), dtype=np.int64, count=len(said)))
        self.piece_chars += int(ends[-1])
        word_ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)))
        begins = np.concatenate([[0], np.searchsorted(word_ends, ends, side="right")])
        many = np.diff(begins) - first
        flat = np.fromiter(map(self.numbers.__getitem__, words), dtype=np.int64, count=len(words))[ragged(begins[:-1] + first, many)]
        ends = np.cumsum(many)
        self._learn()
        lengths = self.lengths[flat]
        upto = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], ends])]
        self.piece_starts = np.concatenate([self.piece_starts, upto[:-1] + len(self.piece_flat)])
        self.piece_lengths = np.concatenate([self.piece_lengths, np.diff(upto)])
        self.piece_flat = np.concatenate([self.piece_flat, self.flat[ragged(self.starts[flat], lengths)]])

    def encode(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """Token ids (int32) of each text; null is empty."""
        group: list[str] = []
        chars = 0

        def finished() -> Iterator[np.ndarray]:
            apart = [self._cuttable(text) for text in group]
            cut = iter(self._cut([text for text, may in zip(group, apart) if may]) if any(apart) else [])
            pieces = [next(cut) if may else None for may in apart]
            words = [self._numbered(text) if own is None else None for text, own in zip(group, pieces)]
            self._learn_pieces()
            self._learn()
            for own, text_words in zip(pieces, words):
                if own is None:
                    yield self.flat[ragged(self.starts[text_words], self.lengths[text_words])]
                else:
                    yield self.piece_flat[ragged(self.piece_starts[own], self.piece_lengths[own])]
            group.clear()
            if len(self.numbers) > POOL_WORDS:
                self._forget()
            if len(self.pieces) > POOL_PIECES or self.piece_chars > POOL_CHARS:
                self._forget_pieces()

        for text in texts:
            group.append(text or "")
            chars += len(text or "")
            if chars >= GROUP_CHARS:
                yield from finished()
                chars = 0
        yield from finished()

    def decode(self, ids: np.ndarray) -> bytes:
        return self.token_bytes[ragged(self.token_starts[ids], self.token_lengths[ids])].tobytes()


_DIGESTS = "n_tokens: bigint, ids_sha256: string, decoded_sha256: string"


def _encoded(encoder: Encoder, texts: pa.Array) -> list[np.ndarray]:
    return list(encoder.encode(raw.decode("utf-8", "replace") for raw in text_bytes(texts)))


def _lists(rows: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(rows) + 1, dtype=np.int32)
    np.cumsum([len(row) for row in rows], out=offsets[1:])
    flat = np.concatenate(rows) if rows else np.zeros(0, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, type=pa.int32()))


def _digests(encoder: Encoder, rows: Iterable[np.ndarray]) -> dict[str, pa.Array]:
    """The columns ``_DIGESTS`` of ids."""
    many, packed, text = [], [], []
    for own in rows:
        many.append(len(own))
        packed.append(hashlib.sha256(own.astype("<u4").tobytes()).hexdigest())
        text.append(hashlib.sha256(encoder.decode(own)).hexdigest())
    return {
        "n_tokens": pa.array(many, type=pa.int64()),
        "ids_sha256": pa.array(packed, type=pa.string()),
        "decoded_sha256": pa.array(text, type=pa.string()),
    }


class Tokenizer:
    """Column functions for one vocabulary.  The file is read by the driver alone; tasks get it by broadcast, which
    is bounded by the vocabulary (50,256 tokens: under 10 MB)."""

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        tokens = read_ranks(path)
        shared = spark.sparkContext.broadcast((tokens, pair_table(tokens), pattern))
        self._encoder = lambda: Encoder(*shared.value)

    def encode(self, text: Column) -> Column:
        """Token ids of a text as ARRAY<INT>; null and empty texts give an empty array."""
        make = self._encoder

        @F.arrow_udf("array<int>")
        def bpe_encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            encoder = make()
            for texts in batches:
                yield _lists(_encoded(encoder, texts))

        return bpe_encode(text)

    def encode_and_digest(self, text: Column) -> Column:
        """STRUCT ids, n_tokens, ids_sha256, decoded_sha256: ``encode`` and ``digest`` of its ids in one pass.  Where a query
        returns both as columns of their own, Spark encodes every text twice, in two Python workers per task."""
        make = self._encoder

        @F.arrow_udf(f"struct<ids: array<int>, {_DIGESTS}>")
        def bpe_encode_and_digest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            encoder = make()
            for texts in batches:
                rows = _encoded(encoder, texts)
                said = _digests(encoder, rows)
                yield pa.StructArray.from_arrays([_lists(rows), *said.values()], names=["ids", *said])

        return bpe_encode_and_digest(text)

    def decode(self, ids: Column) -> Column:
        """Bytes of an array of token ids as BINARY; null gives null."""
        make = self._encoder

        @F.arrow_udf("binary")
        def bpe_decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            encoder = make()
            for rows in batches:
                yield pa.array(
                    [encoder.decode(row.values.to_numpy()) if row.is_valid else None for row in rows], type=pa.binary()
                )

        return bpe_decode(ids)

    def digest(self, ids: Column) -> Column:
        """STRUCT n_tokens, ids_sha256 (ids as little-endian unsigned 32-bit integers), decoded_sha256."""
        make = self._encoder

        @F.arrow_udf(f"struct<{_DIGESTS}>")
        def bpe_digest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            encoder = make()
            none = np.zeros(0, dtype=np.int32)
            for rows in batches:
                said = _digests(encoder, (row.values.to_numpy() if row.is_valid else none for row in rows))
                yield pa.StructArray.from_arrays(list(said.values()), names=list(said))

        return bpe_digest(ids)
