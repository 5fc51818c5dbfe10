"""Substring dedup of a corpus against itself with suffix automata of reference shards.

A word goes if it lies in a window of ``WINDOW`` words that also starts earlier.  Every window has an anchor, the least
hash of its ``GRAM``-word grams, and equal windows have equal anchors.  A document is cut into segments: maximal runs of
windows with one anchor.  An anchor's segments are its reference shard.  In the order of the corpus they stream through
a suffix automaton of what came before; after each word the length of its suffix link is the matching statistic, and
from ``WINDOW`` words on the window that ends there was seen.

What keeps it small at any size: anchors that occur once are dropped by a narrow aggregation, before any text moves; of
equal documents only the first takes part; equal segments are one entry of a shard, merged in each task before the
shuffle; and the windows of an anchor that many documents share are dealt by their own hash.  A shard's automaton lives
where its segments meet.  It is not broadcast to all tasks, because the reference is the corpus and its automata have no
bound.  Texts travel compressed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import stream_groups, text_bytes
from starloom.session import materialise

WINDOW = 20
GRAM = 5
LONGEST_RUN = 256  # windows of one segment; longer runs are cut, windows are not
HOT_DOCUMENTS = 5_000  # an anchor in more documents has its windows dealt one by one
TASK_SEGMENTS = 40_000  # distinct segments that a task merges at a time
_LAST_ID = 2**63 - 1  # null ids come last


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


_FACTORS = np.array([pow(0x9E3779B97F4A7C15, i + 1, 1 << 64) for i in range(64)], dtype=np.uint64)


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` word hashes."""
    out = np.zeros(len(words) - size + 1, dtype=np.uint64)
    for i in range(size):
        out += words[i: i + len(out)] * _FACTORS[i]
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def window_anchors(grams: np.ndarray, wanted: int) -> np.ndarray:
    """Least of every ``wanted`` gram hashes in a row, which are the grams of one window."""
    least, reach = grams, 1
    while reach < wanted:  # minima over runs of doubling length
        step = min(reach, wanted - reach)
        least = np.minimum(least[:-step], least[step:])
        reach += step
    return least


def segment_runs(anchors: np.ndarray, longest: int = LONGEST_RUN) -> tuple[np.ndarray, np.ndarray]:
    """First window and number of windows of every maximal run of equal anchors, long ones cut."""
    starts = np.flatnonzero(np.concatenate([[True], anchors[1:] != anchors[:-1]]))
    sizes = np.diff(np.append(starts, len(anchors)))
    if len(sizes) and sizes.max() > longest:
        cut = [np.arange(a, a + n, longest) for a, n in zip(starts.tolist(), sizes.tolist())]
        starts = np.concatenate(cut)
        sizes = np.diff(np.append(starts, len(anchors)))
    return starts, sizes


def shard_matches(segments: Iterable[list[bytes]], window: int = WINDOW) -> Iterator[np.ndarray]:
    """For every segment, in corpus order, a mask of its windows that also start earlier in the shard.

    A suffix automaton grows word by word over all segments.  Before a word's state is linked, its suffix link is the
    longest suffix that was read before; that is the matching statistic at this word.
    """
    step: list[dict[bytes, int]] = [{}]
    link, length = [-1], [0]
    for words in segments:
        seen = np.zeros(len(words) - window + 1, dtype=bool)
        last = 0
        for at, word in enumerate(words):
            known = step[last].get(word)
            if known is not None and length[known] == length[last] + 1:
                last, statistic = known, length[known]
            else:
                if known is None:
                    current = len(length)
                    step.append({})
                    link.append(0)
                    length.append(length[last] + 1)
                    p = last
                    while p != -1 and word not in step[p]:
                        step[p][word] = current
                        p = link[p]
                    target = 0 if p == -1 else step[p][word]
                else:
                    current, p, target = -1, last, known
                if p != -1 and length[target] != length[p] + 1:
                    clone = len(length)
                    step.append(dict(step[target]))
                    link.append(link[target])
                    length.append(length[p] + 1)
                    while p != -1 and step[p].get(word) == target:
                        step[p][word] = clone
                        p = link[p]
                    link[target] = clone
                    target = clone
                if current == -1:
                    last, statistic = target, length[target]
                else:
                    link[current] = target
                    last, statistic = current, length[target]
            if statistic >= window:
                seen[at - window + 1] = True
        yield seen


def _word_hashes(words: list[bytes], memo: _Hashes) -> np.ndarray:
    return np.fromiter(map(memo.__getitem__, words), dtype=np.uint64, count=len(words))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """A document is its id (null: the last) and the hash of its text; rows equal in both are one document."""
    return docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST_ID)).alias("id"),
        F.xxhash64(F.col(text_col)).alias("tie"),
        F.col(text_col).alias("text"),
    )


def _packed(keyed: DataFrame) -> DataFrame:
    @F.arrow_udf("binary")
    def pack(texts: pa.Array) -> pa.Array:
        packer = zstandard.ZstdCompressor(level=3)
        return pa.array([packer.compress(raw) for raw in text_bytes(texts)], type=pa.binary())

    return keyed.select("id", "tie", pack(F.col("text")).alias("z"))


def profiles(keyed: DataFrame) -> DataFrame:
    """(id, tie, content, n_words, sha256) of every document; ``content`` is equal for equal word sequences."""

    @F.arrow_udf("struct<content: binary, n_words: bigint, sha256: string>")
    def profile(texts: pa.Array) -> pa.Array:
        content, count, digest = [], [], []
        for raw in text_bytes(texts):
            words = raw.split()
            joined = b" ".join(words)
            content.append(xxhash.xxh3_128_digest(joined))
            count.append(len(words))
            digest.append(hashlib.sha256(joined).hexdigest())
        return pa.StructArray.from_arrays(
            [pa.array(content, type=pa.binary()), pa.array(count, type=pa.int64()), pa.array(digest, type=pa.string())],
            names=["content", "n_words", "sha256"],
        )

    return keyed.select("id", "tie", profile(F.col("text")).alias("p")).select("id", "tie", "p.*")


def anchor_posts(keyed: DataFrame, window: int, gram: int) -> DataFrame:
    """(anchor, content, twice): the anchors of every document, once each; ``twice`` if the gram occurs again in it."""

    def post(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _Hashes()
        for batch in batches:
            parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for raw in text_bytes(batch.column(0)):
                words = raw.split()
                if len(words) < window:
                    continue
                content = int.from_bytes(xxhash.xxh3_128_digest(b" ".join(words))[:8], "big", signed=True)
                grams = gram_hashes(_word_hashes(words, memo), gram)
                found = np.unique(window_anchors(grams, window - gram + 1))
                every, many = np.unique(grams, return_counts=True)
                twice = many[np.searchsorted(every, found)] > 1  # equal windows have their anchor in two places
                parts.append((found, np.full(len(found), content), twice))
            if parts:
                anchor, content, twice = (np.concatenate(column) for column in zip(*parts))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor.view(np.int64)), pa.array(content), pa.array(twice)],
                    names=["anchor", "content", "twice"],
                )

    return keyed.select("text").mapInArrow(post, "anchor long, content long, twice boolean")


_SEGMENTS = "anchor long, segment binary, id long, tie long, start int, windows int, words binary"


def candidate_segments(flagged: DataFrame, window: int, gram: int) -> DataFrame:
    """Segments of ``flagged(id, tie, z, flags)`` at flagged anchors.

    Every occurrence is a row without words; every distinct segment of a task is another row with its words and its
    first place in that task.
    """

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, unpacker = _Hashes(), zstandard.ZstdDecompressor()
        rows: list[tuple] = []
        merged: dict[bytes, tuple] = {}

        def flush(all_: bool) -> Iterator[pa.RecordBatch]:
            if all_ or len(merged) >= TASK_SEGMENTS:
                rows.extend(merged.values())
                merged.clear()
            if rows and (all_ or len(rows) >= 20_000):
                kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
                names = ["anchor", "segment", "id", "tie", "start", "windows", "words"]
                for at in range(0, len(rows), 20_000):
                    columns = zip(*rows[at: at + 20_000])
                    yield pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(columns, kinds)], names=names)
                rows.clear()

        for batch in batches:
            for id_, tie, z, flags in zip(*(batch.column(i) for i in range(4))):
                id_, tie = id_.as_py(), tie.as_py()
                words = unpacker.decompress(z.as_py()).split()
                hashes = _word_hashes(words, memo)
                anchors = window_anchors(gram_hashes(hashes, gram), window - gram + 1)
                starts, sizes = segment_runs(anchors)
                hot = {flag["anchor"]: flag["hot"] for flag in flags.as_py()}
                own = anchors[starts].view(np.int64).tolist()
                whole = gram_hashes(hashes, window).view(np.int64) if any(hot.values()) else None
                for anchor, start, size in zip(own, starts.tolist(), sizes.tolist()):
                    if anchor not in hot:
                        continue
                    if hot[anchor]:  # each window by itself
                        pieces = [(int(whole[i]), i, 1) for i in range(start, start + size)]
                    else:
                        pieces = [(anchor, start, size)]
                    for key, at, many in pieces:
                        text = b" ".join(words[at: at + many + window - 1])
                        segment = hashlib.md5(text, usedforsecurity=False).digest()
                        rows.append((key, segment, id_, tie, at, many, None))
                        before = merged.get(segment)
                        if before is None or (id_, tie, at) < before[2:5]:
                            merged[segment] = (key, segment, id_, tie, at, many, text)
                yield from flush(False)
        yield from flush(True)

    return flagged.select("id", "tie", "z", "flags").mapInArrow(cut, _SEGMENTS)


def shard_spans(references: DataFrame, window: int) -> DataFrame:
    """(id, tie, start, end) in words: what the first place of each distinct segment repeats of earlier ones."""

    def match(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int, int, int]] = []

        def ready() -> pa.RecordBatch:
            columns = list(zip(*out))
            out.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, type=k) for c, k in zip(columns, [pa.int64(), pa.int64(), pa.int32(), pa.int32()])],
                names=["id", "tie", "start", "end"],
            )

        for group in stream_groups(batches, ["anchor"], chunk_rows=1 << 14):
            first: dict[bytes, tuple] = {}
            columns = (group[name].tolist() for name in ("words", "id", "tie", "start"))
            for words, *place in zip(*columns):
                if words not in first or place < first[words]:
                    first[words] = place
            if len(first) == 1 and len(next(iter(first)).split()) == window:
                continue
            order = sorted(first, key=first.__getitem__)
            for words, seen in zip(order, shard_matches((words.split() for words in order), window)):
                if seen.any():
                    id_, tie, start = first[words]
                    edges = np.flatnonzero(np.diff(np.concatenate([[0], seen.view(np.int8), [0]])))
                    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
                        out.append((id_, tie, start + a, start + b + window - 1))
            if len(out) >= 20_000:
                yield ready()
        if out:
            yield ready()

    placed = references.repartition("anchor").sortWithinPartitions("anchor")
    return placed.select("anchor", "words", "id", "tie", "start").mapInArrow(
        match, "id long, tie long, start int, end int"
    )


def remove_spans(packed: DataFrame) -> DataFrame:
    """(id, tie, n_removed, kept) of ``packed(id, tie, z, spans)``; ``kept``: the words left, joined by one space."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            removed, kept = [], []
            for z, spans in zip(batch.column(2), batch.column(3)):
                words = unpacker.decompress(z.as_py()).split()
                edge = np.zeros(len(words) + 1, dtype=np.int64)
                np.add.at(edge, spans.values.field("start").to_numpy(), 1)
                np.add.at(edge, spans.values.field("end").to_numpy(), -1)
                stays = np.cumsum(edge[:-1]) == 0
                removed.append(len(words) - int(stays.sum()))
                kept.append(b" ".join([words[i] for i in np.flatnonzero(stays).tolist()]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(removed, type=pa.int64()),
                 pa.array(kept, type=pa.binary())],
                names=["id", "tie", "n_removed", "kept"],
            )

    return packed.select("id", "tie", "z", "spans").mapInArrow(
        cut, "id long, tie long, n_removed long, kept binary"
    )


def repeated_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM,
    hot_documents: int = HOT_DOCUMENTS,
) -> tuple[DataFrame, DataFrame]:
    """(profiles, spans): per document its profile and whether it is a ``copy`` of an earlier document's words, and
    (id, tie, start, end) in words for the others."""
    keyed = _keyed(docs, id_col, text_col)
    profile = materialise(profiles(keyed).dropDuplicates(["id", "tie"]), "substring-profiles")
    firsts = profile.where(F.col("n_words") >= window).groupBy("content").agg(F.min(F.struct("id", "tie")).alias("f"))
    firsts = materialise(firsts, "substring-firsts")  # so that the join below can split the rows of a large group
    marked = profile.join(firsts, "content", "left").withColumn(
        "copy", F.coalesce((F.col("f.id") != F.col("id")) | (F.col("f.tie") != F.col("tie")), F.lit(False))
    ).drop("f")
    marked = materialise(marked, "substring-marked")

    posts = materialise(anchor_posts(keyed, window, gram), "substring-posts")
    repeated = posts.groupBy("anchor").agg(
        F.min("content").alias("low"), F.max("content").alias("high"), F.max("twice").alias("twice"),
        F.count(F.lit(1)).alias("n"),
    ).where("low <> high OR twice").select("anchor", (F.col("n") > hot_documents).alias("hot"))
    flags = posts.select("anchor", "content").join(repeated, "anchor").groupBy("content").agg(
        F.collect_set(F.struct("anchor", "hot")).alias("flags")
    )
    half = F.conv(F.hex(F.substring("content", 1, 8)), 16, -10).cast("long")
    origin = marked.where("NOT copy AND n_words >= " + str(window)).select("id", "tie", half.alias("content"))
    wanted = origin.join(flags, "content").select("id", "tie", "flags")
    packed = _packed(keyed)
    segments = materialise(
        candidate_segments(packed.join(wanted, ["id", "tie"]), window, gram), "substring-segments"
    )
    inside = shard_spans(segments.where("words IS NOT NULL"), window)
    places = segments.where("words IS NULL").select("segment", "id", "tie", "start", "windows")
    first = places.groupBy("segment").agg(F.min(F.struct("id", "tie", "start")).alias("f"))
    later = places.join(first, "segment").where(F.struct("id", "tie", "start") != F.col("f")).select(
        "id", "tie", "start", (F.col("start") + F.col("windows") + window - 1).alias("end")
    )
    return marked, inside.unionByName(later)


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(id, n_words, n_removed, kept_sha256, kept) with one row per row of ``docs``.

    ``kept`` holds the words that stay, joined by one space, for documents that lost a part; it is null where nothing
    went (the document's own words) and where everything did (``n_removed`` = ``n_words``).  Null and short texts lose
    nothing.  Of one id with several texts the one with the smaller text hash is earlier; rows equal in id and text
    are one document and get the same result; null ids come last.  Other columns are ignored; an empty table gives an
    empty result.
    """
    marked, spans = repeated_spans(docs, id_col, text_col, **options)
    keyed = _keyed(docs, id_col, text_col)
    listed = spans.groupBy("id", "tie").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    cut = remove_spans(_packed(keyed).join(listed, ["id", "tie"])).dropDuplicates(["id", "tie"])
    cut = materialise(cut.withColumn("cut_sha256", F.sha2("kept", 256)), "substring-cut")
    empty = hashlib.sha256(b"").hexdigest()
    joined = marked.join(cut, ["id", "tie"], "left")
    result = joined.select(
        "id", "tie", "n_words",
        F.when(F.col("copy"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(F.col("copy"), F.lit(empty)).otherwise(F.coalesce("cut_sha256", "sha256")).alias("kept_sha256"),
        F.when(~F.col("copy") & (F.col("n_removed") < F.col("n_words")), F.col("kept")).alias("kept"),
    )
    rows = docs.select(F.col(id_col).alias("own_id"), F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST_ID)).alias("id"),
                       F.xxhash64(F.col(text_col)).alias("tie"))
    return rows.join(result, ["id", "tie"]).select(
        F.col("own_id").alias("id"), "n_words", "n_removed", "kept_sha256", "kept"
    )
