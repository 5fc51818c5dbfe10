"""N-gram Jaccard join: documents whose sets of word shingles have a Jaccard similarity of 0.8 or more.

A size-aware heavy-light join over the *distinct* sets of the corpus.

* Light sets (fewer shingles than a boundary) are linked by enumeration.  Sets of sizes a and b link when they share
  ``need(a, b)`` shingles, so each light set emits all its subsets of that size under the key (a, b, subset), and sets
  of the one and of the other size that meet at a key link.
* Heavy sets scan inverted lists.  Similar sets share a shingle among the first ``size - need + 1`` of each, in any
  common order (here by hash, frequent shingles last), so lists hold those only.  Lists with the same members are
  scanned once.  In a list, sizes, positions and parity bitmaps bound the overlap from above; what passes is counted.

The boundary is chosen by cost: subsets to emit against list entries to scan, both from the sizes and list lengths of a
sample.  Boundary, order and frequent shingles decide the work, never the result.

Near copies would make a square of pairs.  So the first scan takes, for every heavy set, the nearest of the sets before
it in (size, number) order, and a second scan all pairs that the components found by then leave apart.
"""

from __future__ import annotations

import itertools
import math
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import ragged, stream_groups, text_bytes, word_blocks
from starloom.llm.components import connected_components
from starloom.session import materialise

SHINGLE_WORDS = 5
SEED = 42
SAMPLE = 16  # one of so many texts is looked at for sizes and frequent shingles
FREQUENT = 200  # sets at one shingle that put it last in the order
MOST_FREQUENT = 100_000  # shingles put last
MOST_LIGHT = 16  # the boundary is at most this
BLOCK_ROWS = 4_096  # members of a list that one task compares with each other; longer lists are cut into blocks
PAIRS_AT_ONCE = 1 << 19
LEAST_BITS, MOST_BITS = 512, 1 << 16
PAIRS_HELD = 1 << 18  # candidates that a task holds back to say repeated ones once
KNOWN_WORDS = 1 << 18

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def need(a, b):
    """Shingles that sets of sizes a and b must share: 100 * i >= 80 * (a + b - i) for the intersection size i."""
    return -(-4 * (a + b) // 9)


def prefix_length(size: int) -> int:
    """A similar partner has at least 4/5 of the size, so it shares a shingle with the first this many."""
    return size - need(size, -(-4 * size // 5)) + 1 if size else 0


def _mixed(values: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit values (multiplications wrap)."""
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        values = (values ^ (values >> np.uint64(shift))) * np.uint64(factor)
    return values ^ (values >> np.uint64(33))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = found = xxhash.xxh64_intdigest(word, SEED)
        return found


class Shingler:
    """Sorted distinct 64-bit hashes of the word shingles of a text; a shorter text is one shingle, one without words
    none.  Words are hashed once per task."""

    def __init__(self, width: int = SHINGLE_WORDS):
        self.width = width
        self.hashes = _WordHashes()

    def __call__(self, raw: bytes) -> np.ndarray:
        if len(self.hashes) > KNOWN_WORDS:
            self.hashes.clear()
        parts = []
        for words in word_blocks(raw.translate(_LOWER), overlap=self.width - 1):
            if not words:
                continue
            hashed = np.fromiter(map(self.hashes.__getitem__, words), dtype=np.uint64, count=len(words))
            width = min(self.width, len(words))
            rolled = np.full(len(words) - width + 1, width, dtype=np.uint64)
            for k in range(width):
                rolled = _mixed(rolled * np.uint64(31) + hashed[k: len(words) - width + 1 + k])
            parts.append(np.unique(rolled))
        if not parts:
            return np.zeros(0, dtype=np.uint64)
        return parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))


def node(shingles: np.ndarray) -> bytes:
    """128 bits that name a set."""
    return xxhash.xxh128_digest(shingles.tobytes(), SEED)


def in_order(shingles: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, int]:
    """The shingles in the common order, by hash, those in ``last`` (sorted) after all others; and how many others."""
    if not len(last) or not len(shingles):
        return shingles, len(shingles)
    late = last[np.minimum(np.searchsorted(last, shingles), len(last) - 1)] == shingles
    return np.concatenate([shingles[~late], shingles[late]]), len(shingles) - int(late.sum())


def bitmap(shingles: np.ndarray) -> bytes:
    """Parity of the number of shingles per bit.  Two sets differ in at least as many shingles as their bitmaps in bits.
    The number of bits is the power of two from twice the size on; a longer bitmap is folded onto a shorter one."""
    bits = min(max(LEAST_BITS, 2 << (len(shingles) - 1).bit_length() if len(shingles) else 0), MOST_BITS)
    at = (shingles >> np.uint64(20) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


EQUAL, SMALL, LARGE = 0, 1, 2  # what a set is at a key


def subset_keys(shingles: np.ndarray, boundary: int) -> Iterator[tuple[bytes, int]]:
    """Keys at which a light set meets every similar light set that is not equal to it, and its side there: of two sizes
    only sets of different sides link."""
    size = len(shingles)
    for partner in range(-(-4 * size // 5), min(5 * size // 4, boundary - 1) + 1):
        common = need(size, partner)
        if partner == size == common:
            continue  # only the set itself
        head = struct.pack("<2I", min(size, partner), max(size, partner))
        for chosen in itertools.combinations(shingles.tolist(), common):
            side = EQUAL if size == partner else SMALL if size < partner else LARGE
            yield xxhash.xxh128_digest(head + struct.pack(f"<{common}Q", *chosen), SEED), side


def n_subsets(size: int, boundary: int) -> int:
    return sum(math.comb(size, need(size, p)) for p in range(-(-4 * size // 5), min(5 * size // 4, boundary - 1) + 1))


def choose_boundary(sizes: dict[int, int], scanned: float) -> int:
    """The size from which on sets are heavy: least sum of subsets emitted by light sets and list entries scanned for the
    others.  ``sizes`` counts sets by size, ``scanned`` is the mean number of entries behind one list entry.  A light
    set that may have a heavy partner is in the lists as well."""
    def cost(boundary: int) -> float:
        light = sum(n * n_subsets(s, boundary) for s, n in sizes.items() if s < boundary)
        listed = sum(n * prefix_length(s) * scanned for s, n in sizes.items() if 5 * s >= 4 * boundary)
        return light + listed

    return min(range(1, MOST_LIGHT + 1), key=lambda boundary: (cost(boundary), boundary))


# --- sets -------------------------------------------------------------------------------------------------


def _sampled(docs: DataFrame, width: int) -> tuple[np.ndarray, int]:
    """Frequent shingles (sorted) and the boundary, from every sixteenth distinct text (by hash)."""
    def sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, seen = Shingler(width), set()
        for batch in batches:
            for raw in text_bytes(batch.column(0)):
                found = shingler(raw)
                name = node(found)
                if len(found) and name not in seen:
                    seen.add(name)
                    flat = pa.array(found.view(np.int64))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([len(found)], type=pa.int32()), pa.ListArray.from_arrays([0, len(found)], flat)],
                        names=["size", "shingles"])

    text = docs.where(F.pmod("th", F.lit(SAMPLE)) == 0).select("text")
    sample = materialise(text.mapInArrow(sets, "size int, shingles array<long>"), "ngram-sample")
    rows = sample.groupBy(F.least("size", F.lit(2 * MOST_LIGHT)).alias("size")).agg(F.count(F.lit(1)).alias("n")).collect()
    lists = sample.select(F.explode("shingles").alias("shingle")).groupBy("shingle").agg(F.count(F.lit(1)).alias("n"))
    lists = materialise(lists.where("n > 1"), "ngram-sample-lists")  # most shingles occur once
    is_frequent = F.col("n") >= max(2, FREQUENT // SAMPLE)
    scanned = lists.where(~is_frequent).agg(F.sum(F.col("n").cast("double") * F.col("n"))).first()[0] or 0.0
    posts = sample.agg(F.sum("size")).first()[0] or 1
    frequent = lists.where(is_frequent).orderBy(F.desc("n"), "shingle").limit(MOST_FREQUENT).select("shingle")
    last = np.sort(np.array([r[0] for r in frequent.collect()], dtype=np.int64).view(np.uint64))
    return last, choose_boundary({r["size"]: r["n"] for r in rows}, 1.0 + SAMPLE * scanned / posts)


def _described(docs: DataFrame, width: int, last: np.ndarray, boundary: int) -> DataFrame:
    """(id, th, node, size, rare, bits, first): ``first`` holds the shingles of a light set and the list prefix of a heavy
    one, NULL for a set that the task has seen before; the first ``rare`` shingles of a set are not frequent ones."""
    id_type = docs.schema["id"].dataType.simpleString()

    def describe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, seen = Shingler(width), set()
        for batch in batches:
            nodes, sizes, rare, maps, firsts = [], [], [], [], []
            for raw in text_bytes(batch.column("text")):
                found = shingler(raw)
                name = node(found)
                nodes.append(name)
                sizes.append(len(found))
                if name in seen or not len(found):
                    rare.append(None)
                    maps.append(None)
                    firsts.append(None)
                    continue
                if len(seen) >= 1 << 20:
                    seen.clear()
                seen.add(name)
                maps.append(bitmap(found))
                ordered, before = in_order(found, last)
                rare.append(before)
                firsts.append(ordered if len(found) < boundary else ordered[: prefix_length(len(found))])
            lengths = [0 if f is None else len(f) for f in firsts]
            flat = np.concatenate([np.zeros(0, dtype=np.uint64), *[f for f in firsts if f is not None]]).view(np.int64)
            first = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)), pa.array(flat),
                mask=pa.array([f is None for f in firsts], type=pa.bool_()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("th"), pa.array(nodes, type=pa.binary()), pa.array(sizes, type=pa.int32()),
                 pa.array(rare, type=pa.int32()), pa.array(maps, type=pa.binary()), first],
                names=["id", "th", "node", "size", "rare", "bits", "first"])

    schema = f"id {id_type}, th long, node binary, size int, rare int, bits binary, first array<long>"
    return docs.mapInArrow(describe, schema)


def _light_links(sets: DataFrame, boundary: int) -> DataFrame:
    """Links between light sets: at each key, every set to the least one of the other side."""
    def keys(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for sid, first in zip(batch.column("sid").to_pylist(), batch.column("first")):
                found = np.sort(np.asarray(first.values, dtype=np.int64).view(np.uint64))
                emitted = list(subset_keys(found, boundary))
                if emitted:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([key for key, _ in emitted], type=pa.binary()),
                         pa.array([side for _, side in emitted], type=pa.int32()),
                         pa.array([sid] * len(emitted), type=pa.int64())], names=["key", "side", "sid"])

    keyed = sets.where(F.col("size") < boundary).select("sid", "first").mapInArrow(keys, "key binary, side int, sid long")
    of = lambda side: F.min(F.when(F.col("side") == side, F.col("sid"))).alias(f"of{side}")
    least = keyed.groupBy("key").agg(of(EQUAL), of(SMALL), of(LARGE), F.count(F.lit(1)).alias("n"))
    least = least.where((F.col("n") > 1) & (F.col("of0").isNotNull() | (F.col("of1").isNotNull() & F.col("of2").isNotNull())))
    least = materialise(least, "ngram-light")
    other = F.when(F.col("side") == EQUAL, F.col("of0")).when(F.col("side") == SMALL, F.col("of2")).otherwise(F.col("of1"))
    linked = keyed.join(least, "key").select(F.col("sid").alias("u"), other.alias("v"))
    return linked.where("u <> v").distinct()


# --- lists ------------------------------------------------------------------------------------------------


def _members(sets: DataFrame, boundary: int, block_rows: int) -> DataFrame:
    """Rows of the inverted lists that need a scan; a list of more than ``block_rows`` is cut into blocks, and every pair
    of blocks (i <= j) gets its own copy of both.

    Most shingles occur in one set.  Their rows go out with the one shuffle of the list entries; frequent shingles, whose
    lists are long, are not part of it.  What is left is small.
    """
    at = F.posexplode("first").alias("pos", "shingle")
    posts = sets.where(5 * F.col("size") >= 4 * boundary).select("sid", "size", "rare", at)
    listed = -F.floor(-4 * (F.col("size") + F.ceil(4 * F.col("size") / 5)) / 9)  # need(size, smallest partner)
    posts = posts.where(F.col("pos") <= F.col("size") - listed)  # of a light set all shingles are at hand
    entry = ["shingle", "sid", "size", "pos"]
    same = Window.partitionBy("shingle")
    often = posts.where("pos < rare").select(
        *entry, F.count(F.lit(1)).over(same).alias("n"), F.max("size").over(same).alias("most"))
    often = often.where((F.col("n") > 1) & (F.col("most") >= boundary)).select(*entry)
    often = materialise(often.union(posts.where("pos >= rare").select(*entry)), "ngram-entries")
    lists = often.groupBy("shingle").agg(
        F.count(F.lit(1)).alias("n"), F.max("size").alias("most"), F.bit_xor(F.xxhash64("sid")).alias("h"),
        F.bit_xor(F.xxhash64("sid", F.lit(SEED))).alias("g"))
    lists = lists.where((F.col("n") > 1) & (F.col("most") >= boundary)).groupBy("n", "h", "g").agg(F.min("shingle").alias("shingle"))
    lists = materialise(lists.select("shingle", F.ceil(F.col("n") / block_rows).cast("int").alias("blocks")), "ngram-lists")
    return often.join(lists, "shingle")


def _dealt(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Members with their bitmaps, dealt to blocks."""
    own = F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    held = members.join(sets.select("sid", "bits").hint("merge"), "sid").withColumn("block", own).withColumn("other", other)
    return held.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other")).drop("blocks", "other")


class _Bitmaps:
    """Bitmaps of the members of one list, by number of bits; differing bits of pairs of neighbouring lengths."""

    def __init__(self, bits: np.ndarray):
        lengths = np.fromiter(map(len, bits), dtype=np.int64, count=len(bits))
        self.kind = lengths
        self.row = np.zeros(len(bits), dtype=np.int64)
        self.lanes = {}
        for kind in np.unique(lengths).tolist():
            mine = np.flatnonzero(lengths == kind)
            self.row[mine] = np.arange(len(mine))
            self.lanes[kind] = np.frombuffer(b"".join(bits[mine]), dtype=np.uint64).reshape(len(mine), -1)

    def _at(self, kind: int, wanted: int) -> np.ndarray:
        lanes = self.lanes[kind]
        while lanes.shape[1] * 8 > wanted:
            half = lanes.shape[1] // 2
            lanes = lanes[:, :half] ^ lanes[:, half:]
        return lanes

    def differing(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.zeros(len(a), dtype=np.int64)
        kinds = self.kind[a] << 32 | self.kind[b]
        for pair in np.unique(kinds).tolist():
            mine = np.flatnonzero(kinds == pair)
            wanted = min(pair >> 32, pair & 0xFFFFFFFF)
            left, right = self._at(pair >> 32, wanted), self._at(pair & 0xFFFFFFFF, wanted)
            step = max(1, (1 << 25) // wanted)
            for at in range(0, len(mine), step):
                part = mine[at: at + step]
                out[part] = np.bitwise_count(left[self.row[a[part]]] ^ right[self.row[b[part]]]).sum(axis=1)
        return out


def scan_list(group: dict[str, np.ndarray], boundary: int, nearest: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (later, earlier in (size, sid) order; share of differing bits) of one list or pair of blocks that may be
    similar: of each heavy set the nearest one, or all pairs of different labels.  With ``nearest`` the earlier set of any
    such pair has a row too, with -1 for its partner, so that every set with a candidate is named."""
    order = np.lexsort((group["sid"], group["size"]))
    sid, size, pos, block = (group[c][order].astype(np.int64) for c in ("sid", "size", "pos", "block"))
    bits = _Bitmaps(group["bits"][order])
    label = None if nearest else group["label"][order]
    apart = int(group["i"][0]) != int(group["j"][0])
    low = np.searchsorted(size, -(-4 * size // 5), side="left")
    many = np.where(size >= boundary, np.arange(len(size)) - low, 0)
    total = np.cumsum(many)
    found = ([], [], [])
    at = 0
    while at < len(size):
        upto = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + PAIRS_AT_ONCE)))
        a = np.repeat(np.arange(at, upto), many[at:upto])
        b = ragged(low[at:upto], many[at:upto])
        at = upto
        keep = np.ones(len(a), dtype=bool)
        if apart:
            keep &= block[a] != block[b]
        if label is not None:
            keep &= label[a] != label[b]
        both = size[a] + size[b]
        wanted = need(both, 0)
        bound = np.minimum(pos[a], pos[b]) + 1 + np.minimum(size[a] - pos[a], size[b] - pos[b]) - 1
        keep &= bound >= wanted
        a, b, both, wanted = a[keep], b[keep], both[keep], wanted[keep]
        differing = bits.differing(a, b)
        keep = differing <= both - 2 * wanted
        a, b, share = a[keep], b[keep], differing[keep] / both[keep]
        if nearest and len(a):
            named = np.unique(b)
            for kept, values in zip(found, (sid[named], np.full(len(named), -1), np.full(len(named), 2.0))):
                kept.append(values)
            best = np.lexsort((b, share, a))
            best = best[np.concatenate([[True], a[best][1:] != a[best][:-1]])]
            a, b, share = a[best], b[best], share[best]
        for kept, values in zip(found, (sid[a], sid[b], share)):
            kept.append(values)
    return tuple(np.concatenate(part) if part else np.zeros(0, dtype=np.int64) for part in found)


def _candidates(dealt: DataFrame, boundary: int, nearest: bool) -> DataFrame:
    keys = ["shingle", "i", "j"]

    def said(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        u, v, share = (np.concatenate([part[c] for part in held]) for c in range(3))
        order = np.lexsort((share, v, u))
        u, v, share = u[order], v[order], share[order]
        once = np.concatenate([[True], (u[1:] != u[:-1]) | (v[1:] != v[:-1])])
        return pa.RecordBatch.from_arrays([pa.array(u[once]), pa.array(v[once]), pa.array(share[once])], names=["u", "v", "share"])

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for group in stream_groups(batches, keys, chunk_rows=1 << 14):
            if len(group["sid"]) > 1:
                found = scan_list(group, boundary, nearest)
                if len(found[0]):
                    held.append(found)
                    rows += len(found[0])
            if rows >= PAIRS_HELD:
                yield said(held)
                held, rows = [], 0
        if rows:
            yield said(held)

    found = dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(scan, "u long, v long, share double")
    if not nearest:
        return found.select("u", "v").distinct()
    return found.groupBy("u").agg(F.min(F.struct("share", "v")).alias("best")).select("u", "best.v")


# --- verification -----------------------------------------------------------------------------------------


def _contents(docs: DataFrame, live: DataFrame, width: int) -> DataFrame:
    """(sid, shingles) of the sets ``live(sid, node, th)``; only their texts are read into tasks.  ``live`` is a written
    table, so Catalyst broadcasts it when its size allows and shuffles otherwise."""
    def sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, seen = Shingler(width), set()
        for batch in batches:
            for raw in text_bytes(batch.column(0)):
                found = shingler(raw)
                name = node(found)
                if name not in seen:
                    seen.add(name)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name], type=pa.binary()), pa.array([found.tobytes()], type=pa.binary())], names=["node", "shingles"])

    texts = docs.select("text", "th").join(live.select("th").distinct(), "th", "left_semi").select("text")
    named = texts.mapInArrow(sets, "node binary, shingles binary").join(live.select("sid", "node"), "node")
    return materialise(named.dropDuplicates(["sid"]).select("sid", "shingles"), "ngram-contents")


def _similar(left: Column, right: Column) -> Column:
    @F.arrow_udf("boolean")
    def similar(a: pa.Array, b: pa.Array) -> pa.Array:
        out = []
        for x, y in zip(a, b):
            x, y = (np.frombuffer(side.as_buffer(), dtype=np.uint64) for side in (x, y))
            if len(x) > len(y):
                x, y = y, x
            common = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
            out.append(common >= need(len(x), len(y)))
        return pa.array(out, type=pa.bool_())

    return similar(left, right)


def _verified(pairs: DataFrame, contents: DataFrame) -> DataFrame:
    sides = [contents.select(F.col("sid").alias(c), F.col("shingles").alias(f"{c}_shingles")) for c in ("u", "v")]
    joined = pairs.join(sides[0], "u").join(sides[1], "v")
    return joined.where(_similar(F.col("u_shingles"), F.col("v_shingles"))).select("u", "v")


# --- the join ---------------------------------------------------------------------------------------------


def distinct_sets(docs: DataFrame, width: int = SHINGLE_WORDS, boundary: int | None = None) -> tuple[DataFrame, DataFrame, int]:
    """(rows, sets, boundary) of ``docs(id, text, th)``: every row's set, and every distinct non-empty set once, numbered."""
    last, chosen = _sampled(docs, width)
    boundary = chosen if boundary is None else boundary
    rows = materialise(_described(docs, width, last, boundary), "ngram-rows")
    once = rows.where("first IS NOT NULL").dropDuplicates(["node"]).select("node", "th", "size", "rare", "bits", "first")
    return rows, materialise(once.select(F.monotonically_increasing_id().alias("sid"), "*"), "ngram-sets"), boundary


def similar_sets(docs: DataFrame, sets: DataFrame, boundary: int, width: int = SHINGLE_WORDS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Links (u, v) between ``sets`` whose components are those of all similar pairs."""
    light = materialise(_light_links(sets, boundary), "ngram-light-links")
    members = materialise(_members(sets, boundary, block_rows), "ngram-members")
    first = materialise(_candidates(_dealt(members, sets), boundary, True), "ngram-nearest")
    live = materialise(sets.select("sid", "node", "th").join(first.select(F.col("u").alias("sid")), "sid"), "ngram-live")
    contents = _contents(docs, live, width)
    first = first.where("v >= 0")
    links = materialise(light.union(_verified(first, contents)), "ngram-links")
    # The first scan names every set that has a candidate, so the second reads the rows of these only.
    roots = connected_components(links, "ngram-found").withColumnRenamed("node", "sid")
    labels = live.select("sid").join(roots, "sid", "left").select("sid", F.coalesce("root", "sid").alias("label"))
    labels = materialise(labels, "ngram-labels")
    rest = materialise(_candidates(_dealt(members.join(labels, "sid"), sets), boundary, False), "ngram-rest")
    return links.union(_verified(rest, contents))


def linked_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE_WORDS,
    boundary: int | None = None, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(id, n_shingles, component_id) for every row: the size of its set and the smallest id reachable over links, own id
    included.

    Null, empty and wordless texts have no shingles and stand alone; equal texts, and texts with equal sets, link at
    similarity 1.  Repeated rows and ids keep one result row each; null ids are results but name no component that has
    other ids; other columns are ignored; an empty table gives an empty result.
    """
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(F.col(text_col)).alias("th"))
    rows, sets, boundary = distinct_sets(docs, width, boundary)
    links = similar_sets(docs, sets, boundary, width, block_rows)
    roots = connected_components(links, "ngram-components").withColumnRenamed("node", "sid")
    rooted = sets.select("sid", "node").join(roots, "sid", "left").select("node", F.coalesce("root", "sid").alias("root"))
    least = materialise(rows.where("size > 0").groupBy("node").agg(F.min("id").alias("least")).join(rooted, "node"), "ngram-least")
    named = materialise(least.groupBy("root").agg(F.min("least").alias("component_id")), "ngram-named")
    classes = materialise(least.join(named, "root").select("node", "component_id"), "ngram-classes")
    found = rows.select("id", "node", "size").join(classes, "node", "left")
    component = F.when(F.col("size") == 0, F.col("id")).otherwise(F.col("component_id"))
    return found.select("id", F.col("size").cast("long").alias("n_shingles"), component.alias("component_id"))
