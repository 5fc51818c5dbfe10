"""Periodic run detection in word sequences by string synchronising sets.

A run is a stretch of words with smallest period q, at least ``max(6, 4 * q)`` words long, that neither neighbour extends.

At every dyadic scale t, from 4 on, runs of the periods t to 2t - 1 are sought.  A position is *selected* if the hash of
the t words from it is the least, or the hash at its right end, among the positions of the next t words.  The choice
depends on 2t words only, so inside a run selected positions repeat with its period.  A selected position and the next
one with the same 2t words propose their distance as a period; the nearest equal context in a run lies one smallest
period away, because two shorter overlapping periods would force a still smaller one (Fine and Wilf).

Positions whose t words have a period of t / 4 or less are never selected, or highly periodic regions would be full of
them.  Every such stretch lies in a run found at a smaller scale, since it holds at least four periods.  The periods
below the first scale are supplied by comparing every word with its first, second and third successor.

Proposals of one distance whose contexts overlap form one chain.  A chain is compared word by word and extended at both
ends, so what is reported is exact; hashes only choose where to look.

The texts of a batch are laid end to end, the longest first, with a word of its own after each, so that no period
crosses a border, all texts are worked on together, and a scale reads only the texts that are long enough for it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from fractions import Fraction
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import text_bytes, word_blocks

LEAST_WORDS, LEAST_REPEATS = 6, 4
FIRST_SCALE = 4
BATCH_WORDS = 1 << 18  # texts are laid end to end up to about this many words
NOT_SELECTED = np.uint64(0xFFFFFFFFFFFFFFFF)
JOIN_WORDS = 1 << 16

Run = tuple[int, int, int]  # start, length, period


def _mixed(values: np.ndarray) -> np.ndarray:
    for shift, factor in ((32, 0xD6E8FEB86659FD93), (32, 0xD6E8FEB86659FD93)):
        values = (values ^ (values >> np.uint64(shift))) * np.uint64(factor)
    return values ^ (values >> np.uint64(32))


def _stretches(equal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal stretches of True."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], equal.view(np.int8), [0]])))
    return edges[0::2], edges[1::2]


def _has_smaller_period(words: np.ndarray, start: int, end: int, period: int) -> bool:
    """Whether a stretch of four periods or more has a smaller one; that would divide ``period``."""
    rest, divisor = period, 2
    while rest > 1:
        if rest % divisor:
            divisor = divisor + 1 if divisor * divisor <= rest else rest
            continue
        while rest % divisor == 0:
            rest //= divisor
        step = period // divisor
        if (words[start: end - step] == words[start + step: end]).all():
            return True
        divisor = divisor + 1 if divisor * divisor <= rest else max(rest, 2)
    return False


def _extended(words: np.ndarray, low: int, high: int, period: int) -> tuple[int, int]:
    """The stretch [low, high) lengthened at both ends as long as words ``period`` apart agree."""
    step = 64
    while high < len(words):
        upto = min(high + step, len(words))
        differs = np.flatnonzero(words[high:upto] != words[high - period: upto - period])
        if len(differs):
            high += int(differs[0])
            break
        high, step = upto, step * 2
    step = 64
    while low > 0:
        back = max(low - step, 0)
        differs = np.flatnonzero(words[back:low] != words[back + period: low + period])
        if len(differs):
            low = back + int(differs[-1]) + 1
            break
        low, step = back, step * 2
    return low, high


def _small_periods(words: np.ndarray) -> set[Run]:
    """Runs of the periods below the first scale, straight from the words."""
    found: set[Run] = set()
    for period in range(1, FIRST_SCALE):
        if len(words) <= period:
            break
        starts, ends = _stretches(words[:-period] == words[period:])
        lengths = ends - starts + period
        for at in np.flatnonzero(lengths >= max(LEAST_WORDS, LEAST_REPEATS * period)).tolist():
            start, length = int(starts[at]), int(lengths[at])
            if not _has_smaller_period(words, start, start + length, period):
                found.add((start, length, period))
    return found


def _selected(hashes: np.ndarray, scale: int, periodic: np.ndarray) -> np.ndarray:
    """Selected positions: the least hash of a window of ``scale`` + 1 positions is the first or the last one."""
    ranks = np.where(periodic[: len(hashes)], NOT_SELECTED, hashes)
    least, width = ranks, 1
    while width < scale:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if len(least) < 2:
        return np.zeros(0, dtype=np.int64)
    least = np.minimum(least[:-1], least[1:])
    first, last = ranks[: len(least)], ranks[scale: scale + len(least)]
    return np.flatnonzero((least != NOT_SELECTED) & ((least == first) | (least == last)))


def _proposed(hashes: np.ndarray, scale: int, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and distances of neighbouring equal contexts of two times ``scale`` words, by distance and position."""
    places = places[places + 2 * scale <= len(hashes) + scale - 1]
    contexts = _mixed(hashes[places] * np.uint64(0x9E3779B97F4A7C15) + hashes[places + scale])
    order = np.argsort(contexts, kind="stable")
    same = contexts[order][1:] == contexts[order][:-1]
    start = places[order][:-1][same]
    distance = places[order][1:][same] - start
    keep = (distance >= scale) & (distance < 2 * scale)
    start, distance = start[keep], distance[keep]
    order = np.lexsort((start, distance))
    return start[order], distance[order]


def _runs_of_scale(words: np.ndarray, scale: int, start: np.ndarray, distance: np.ndarray) -> set[Run]:
    found: set[Run] = set()
    if not len(start):
        return found
    fresh = np.concatenate([[True], (distance[1:] != distance[:-1]) | (start[1:] - start[:-1] > 2 * scale)])
    first = np.flatnonzero(fresh)
    last = np.concatenate([first[1:], [len(start)]]) - 1
    for low, high, period in zip(start[first].tolist(), start[last].tolist(), distance[first].tolist()):
        end = min(high + 2 * scale + period, len(words))
        low, end = _extended(words, low, end, period)
        begins, ends = _stretches(words[low: end - period] == words[low + period: end])
        for begin, stop in zip(begins.tolist(), ends.tolist()):  # one stretch, unless hashes collided
            run = (low + begin, stop - begin + period, period)
            if run[1] >= max(LEAST_WORDS, LEAST_REPEATS * period) and run not in found:
                if not _has_smaller_period(words, run[0], run[0] + run[1], period):
                    found.add(run)
    return found


def find_runs(words: np.ndarray, longest: int, reach: list[tuple[int, int]]) -> list[Run]:
    """All runs of an integer sequence.  ``longest`` bounds the length of a run; ``reach`` holds (text length, end of the
    texts at least that long), longest text first, so that a scale reads only the texts it can concern."""
    found = _small_periods(words)
    hashes, scale = _mixed(words.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)), 1
    while LEAST_REPEATS * scale <= longest:
        if scale >= FIRST_SCALE:
            end = max((stop for length, stop in reach if length >= LEAST_REPEATS * scale), default=0)
            part = words[:end]
            hashes = hashes[: max(end - scale + 1, 0)]
            change = np.zeros(len(part) + 1, dtype=np.int32)
            for start, length, period in found:
                if LEAST_REPEATS * period <= scale <= length and start < end:
                    change[start] += 1
                    change[min(start + length - scale + 1, len(part))] -= 1
            places = _selected(hashes, scale, np.cumsum(change)[:-1] > 0)
            found |= _runs_of_scale(part, scale, *_proposed(hashes, scale, places))
        if len(hashes) <= scale:
            break
        hashes = _mixed(hashes[:-scale] * np.uint64(0x9E3779B97F4A7C15) + hashes[scale:])
        scale *= 2
    return sorted((start, period, length) for start, length, period in found)


def repeated_tail(words: np.ndarray, doc_id: int | None) -> np.ndarray:
    """The stated change to every tenth document (by CRC-32 of its id): from some word on it repeats itself."""
    n = len(words)
    if doc_id is None or not n:
        return words
    h = crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    out = words.copy()
    out[a:] = words[a + np.arange(n - a) % p]
    return out


class _Words(dict):
    """Numbers of the words of one batch, in the order of their first use."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _answer(words: np.ndarray, runs: list[Run], names: list[bytes]) -> tuple:
    """Columns of one text from its runs (start, period, length)."""
    listed = hashlib.sha256()
    change = np.zeros(len(words) + 1, dtype=np.int64)
    best = None
    for start, period, length in runs:
        listed.update(f"{start},{length},{period}\n".encode())
        change[start + period] += 1
        change[start + length] -= 1
        rank = (-Fraction(length, period), start, period)
        if best is None or rank < best[0]:
            best = (rank, start, length, period)
    kept = words[np.cumsum(change)[:-1] == 0]
    collapsed = hashlib.sha256()
    for at in range(0, len(kept), JOIN_WORDS):
        collapsed.update(b" " * (at > 0) + b" ".join([names[w] for w in kept[at: at + JOIN_WORDS].tolist()]))
    start, length, period = best[1:] if best else (None, None, None)
    exponent = 1000 * length // period if best else None
    return len(runs), start, length, period, exponent, listed.hexdigest(), collapsed.hexdigest(), len(words) - len(kept)


def analyse(texts: list[np.ndarray], names: list[bytes]) -> list[tuple]:
    """Answers for several texts (arrays of word numbers) worked on together."""
    order = sorted(range(len(texts)), key=lambda t: -len(texts[t]))
    total = sum(map(len, texts)) + len(texts)
    laid = np.empty(total, dtype=np.int64)
    starts, reach, at = [], [], 0
    for border, t in enumerate(order):
        starts.append(at)
        laid[at: at + len(texts[t])] = texts[t]
        at += len(texts[t])
        laid[at] = -1 - border  # a word that occurs nowhere else
        at += 1
        if reach and reach[-1][0] == len(texts[t]):
            reach.pop()
        reach.append((len(texts[t]), at))
    runs: list[list[Run]] = [[] for _ in texts]
    begins = np.array(starts, dtype=np.int64)
    for start, period, length in find_runs(laid, max(map(len, texts), default=0), reach):
        place = int(np.searchsorted(begins, start, side="right")) - 1
        runs[order[place]].append((start - starts[place], period, length))
    return [_answer(words, own, names) for words, own in zip(texts, runs)]


_SCHEMA = ("n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string,"
           " collapsed_sha256 string, n_dropped long")


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repeat_tails: bool = False) -> DataFrame:
    """One row per row of ``docs``: id, number of runs, the run with the greatest length / period (ties: smallest start,
    then period; NULL without runs), digests of all runs and of the text without its repeats, and the words dropped.

    A word is dropped if some run holds it after that run's first period.  ``repeat_tails`` first applies
    ``repeated_tail`` to every text (a null id changes nothing).  Null, empty and wordless texts have no runs; repeated
    rows and ids keep one result row each; other columns are ignored; an empty table gives an empty result.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def detect(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            numbers, texts, held, first = _Words(), [], 0, 0

            def flush(upto: int) -> pa.RecordBatch:
                answers = analyse(texts, list(numbers)) if texts else []
                kinds = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.int64()]
                columns = [pa.array([a[c] for a in answers], type=kind) for c, kind in enumerate(kinds)]
                return pa.RecordBatch.from_arrays(
                    [ids.slice(first, upto - first), *columns],
                    names=["id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "n_dropped"])

            for at, raw in enumerate(text_bytes(batch.column(1))):
                parts = [np.fromiter(map(numbers.__getitem__, block), dtype=np.int64, count=len(block)) for block in word_blocks(raw)]
                words = parts[0] if len(parts) == 1 else np.concatenate(parts)
                texts.append(repeated_tail(words, ids[at].as_py()) if repeat_tails else words)
                held += len(words)
                if held >= BATCH_WORDS:
                    yield flush(at + 1)
                    numbers, texts, held, first = _Words(), [], 0, at + 1
            yield flush(batch.num_rows)

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(detect, f"id {id_type}, {_SCHEMA}")
