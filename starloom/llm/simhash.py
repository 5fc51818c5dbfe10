"""SimHash near-duplicates by anchor-point covering.

A fingerprint has 64 bits; two fingerprints link when they differ in at most four.  The bits are cut into blocks of
23, 23 and 18; of four differing bits at most one falls into some block.  In every block the anchors are the words of
a linear code with a small covering radius R (the perfect Golay code for 23 bits, a Hamming code and three free bits
for 18).  A fingerprint goes to every anchor within R + 1 of its block.  Linked fingerprints then meet at the anchor
nearest to one of them, so each anchor compares the fingerprints at home there with all that it received.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import ragged, row_struct, stream_groups, text_bytes, word_blocks
from starloom.llm.components import connected_components
from starloom.session import materialise

BITS = 64
MAX_DIFFERENCE = 4
SHINGLE_WORDS = 4
SEED = 42
HOME_ROWS = 8192  # fingerprints at home at one anchor that one task compares; more are split
PAIRS_AT_ONCE = 1 << 21

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def fingerprint_bytes(raw: bytes, shingle: int = SHINGLE_WORDS) -> int:
    """SimHash of one text: bit i is 1 if it is set in over half the hashes of its word shingles; 0 without words."""
    ones = np.zeros(BITS, dtype=np.int64)
    total = 0
    digest = xxhash.xxh64_intdigest
    for words in word_blocks(raw.translate(_LOWER), overlap=shingle - 1):
        if not words:
            continue
        joined = b" ".join(words)
        if len(words) < shingle:
            hashes = np.array([digest(joined, SEED)], dtype=np.uint64)
        else:
            lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
            ends = np.cumsum(lengths + 1) - 1
            first, last = (ends - lengths)[: 1 - shingle or None].tolist(), ends[shingle - 1:].tolist()
            hashes = np.fromiter(
                (digest(joined[a:b], SEED) for a, b in zip(first, last)), dtype=np.uint64, count=len(first)
            )
        total += len(hashes)
        for part in range(0, len(hashes), 1 << 16):
            eight = hashes[part: part + (1 << 16)].view(np.uint8)
            ones += np.unpackbits(eight, bitorder="little").reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * ones > total).tolist())


def fingerprint(text: Column) -> Column:
    """SimHash of a text column as a signed LONG; null and wordless texts give 0."""

    @F.arrow_udf("long")
    def simhash(texts: pa.Array) -> pa.Array:
        values = np.fromiter((fingerprint_bytes(raw) for raw in text_bytes(texts)), dtype=np.uint64, count=len(texts))
        return pa.array(values.view(np.int64))

    return simhash(text)


@dataclass(frozen=True)
class BlockCode:
    """Anchors of one block of bits: the words of the code whose parity-check columns are ``columns``."""

    shift: int
    columns: tuple[int, ...]
    within: int  # differing bits that two linked fingerprints may have in this block

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Error patterns up to weight R + within by syndrome: starts, lengths, patterns (lightest first), syndromes
        of every value of the low and the high half of the block are computed by ``syndromes``."""
        n = len(self.columns)
        found: dict[int, list[int]] = {}
        wanted = 1 << max(c.bit_length() for c in self.columns)
        radius = None
        for weight in range(n + 1):
            if radius is not None and weight > radius + self.within:
                break
            for bits in itertools.combinations(range(n), weight):
                syndrome, pattern = 0, 0
                for bit in bits:
                    syndrome ^= self.columns[bit]
                    pattern |= 1 << bit
                found.setdefault(syndrome, []).append(pattern)
            if radius is None and len(found) == wanted:
                radius = weight
        lengths = np.array([len(found[s]) for s in range(wanted)], dtype=np.int64)
        patterns = np.array(list(itertools.chain.from_iterable(found[s] for s in range(wanted))), dtype=np.int64)
        return np.cumsum(lengths) - lengths, lengths, patterns, np.array(self.columns, dtype=np.int64)


def _golay_columns() -> tuple[int, ...]:
    """x^i modulo the generator polynomial x^11 + x^9 + x^7 + x^6 + x^5 + x + 1."""
    columns, value = [], 1
    for _ in range(23):
        columns.append(value)
        value <<= 1
        if value & (1 << 11):
            value ^= 0b101011100011
    return tuple(columns)


BLOCKS = (
    BlockCode(0, _golay_columns(), 1),
    BlockCode(23, _golay_columns(), 1),
    BlockCode(46, tuple(range(1, 16)) + (0, 0, 0), 1),
)


def anchors(fingerprints: DataFrame, blocks: tuple[BlockCode, ...] = BLOCKS) -> DataFrame:
    """Every (LONG) fingerprint at every anchor it may share: columns block, anchor, fp, home."""

    def replicate(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [code.tables() for code in blocks]
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for at in range(0, len(fps), 1 << 15):
                part = fps[at: at + (1 << 15)]
                for number, (code, (starts, lengths, patterns, columns)) in enumerate(zip(blocks, tables)):
                    width = len(columns)
                    value = (part.view(np.uint64) >> np.uint64(code.shift)).astype(np.int64) & ((1 << width) - 1)
                    syndrome = np.zeros(len(part), dtype=np.int64)
                    for bit in range(width):
                        syndrome ^= np.where((value >> bit) & 1, columns[bit], 0)
                    many = lengths[syndrome]
                    picked = ragged(starts[syndrome], many)
                    home = np.zeros(len(picked), dtype=bool)
                    home[np.cumsum(many) - many] = True  # the lightest pattern leads to the nearest anchor
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(picked), number, dtype=np.int32)),
                            pa.array((np.repeat(value, many) ^ patterns[picked]).astype(np.int32)),
                            pa.array(np.repeat(part, many)),
                            pa.array(home),
                        ],
                        names=["block", "anchor", "fp", "home"],
                    )

    return fingerprints.mapInArrow(replicate, "block int, anchor int, fp long, home boolean")


def _merge(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Union the pairs (a[i], b[i]) into ``labels``, which always point at a smaller or the same position."""
    while True:
        while True:
            deeper = labels[labels]
            if np.array_equal(deeper, labels):
                break
            labels[:] = deeper
        x, y = labels[a], labels[b]
        apart = x != y
        if not apart.any():
            return
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(labels, np.maximum(x, y), np.minimum(x, y))


def link_group(block: int, fps: np.ndarray, home: np.ndarray, blocks=BLOCKS) -> tuple[np.ndarray, np.ndarray]:
    """Links of one anchor as a spanning forest: (fingerprint, smaller fingerprint of the same tree).

    Small groups are compared directly.  In larger ones the bits outside the block are cut into five pieces, one of
    which must be equal, and only fingerprints that agree in a piece are compared.
    """
    values = np.unique(fps)
    labels = np.arange(len(values))
    mine = np.searchsorted(values, np.unique(fps[home]))
    raw = values.view(np.uint64)

    def compare(a: np.ndarray, b: np.ndarray) -> None:
        near = np.bitwise_count(raw[a] ^ raw[b]) <= MAX_DIFFERENCE
        if near.any():
            _merge(labels, a[near], b[near])

    if len(mine) * len(values) <= PAIRS_AT_ONCE:
        if len(mine):
            i, j = np.nonzero(np.bitwise_count(raw[mine][:, None] ^ raw[None, :]) <= MAX_DIFFERENCE)
            _merge(labels, mine[i], j)
    else:
        width = len(blocks[block].columns)
        outside = [bit for bit in range(BITS) if not blocks[block].shift <= bit < blocks[block].shift + width]
        for piece in np.array_split(np.array(outside), MAX_DIFFERENCE + 1):
            mask = np.uint64(sum(1 << int(bit) for bit in piece))
            order = np.argsort(raw & mask, kind="stable")
            keys = (raw & mask)[order]
            low = np.searchsorted(keys, raw[mine] & mask, side="left")
            many = np.searchsorted(keys, raw[mine] & mask, side="right") - low
            at = 0
            total = np.cumsum(many)
            while at < len(mine):
                upto = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + PAIRS_AT_ONCE)))
                part = many[at:upto]
                compare(np.repeat(mine[at:upto], part), order[ragged(low[at:upto], part)])
                at = upto
    _merge(labels, labels[:0], labels[:0])
    moved = np.flatnonzero(labels != np.arange(len(values)))
    return values[moved], values[labels[moved]]


def links(fingerprints: DataFrame, blocks: tuple[BlockCode, ...] = BLOCKS, home_rows: int = HOME_ROWS) -> DataFrame:
    """Edges (u, v) whose components are those of all links between the distinct fingerprints of column ``fp``.

    An anchor with more than ``home_rows`` fingerprints at home is split: its home rows are dealt over several
    parts, and each part receives all fingerprints of the anchor (8 bytes each), so no comparison is left out.
    """
    placed = materialise(anchors(fingerprints.select("fp"), blocks), "simhash-anchors")
    sizes = placed.groupBy("block", "anchor").agg(F.count_if("home").alias("n"))
    parts = sizes.select("block", "anchor", F.ceil(F.col("n") / home_rows).cast("int").alias("parts")).where("parts > 1")
    own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    split = (
        placed.join(parts, ["block", "anchor"], "left")
        .withColumn("parts", F.coalesce("parts", F.lit(1)))
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select("block", "anchor", "part", "fp", (F.col("home") & (F.col("part") == own)).alias("home"))
    )
    keys = ["block", "anchor", "part"]

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in stream_groups(batches, keys):
            if len(group["fp"]) > 1 and group["home"].any():
                u, v = link_group(int(group["block"][0]), group["fp"], group["home"].astype(bool), blocks)
                if len(u):
                    yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    return split.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(compare, "u long, v long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp, component_id) for every row: the smallest id reachable over links, own id included.

    Null and wordless texts have fingerprint 0 and link like any other; equal texts share a fingerprint; repeated
    rows and ids keep one result row each; null ids are results but never a component's id (a component of null
    ids only gets null); other columns are ignored; an empty table gives an empty result.
    """
    marked = materialise(
        docs.select(F.col(id_col).alias("id"), fingerprint(F.col(text_col)).alias("fp")), "simhash-fingerprints"
    )
    distinct = materialise(marked.groupBy("fp").agg(F.min("id").alias("least")), "simhash-distinct")
    roots = connected_components(links(distinct), "simhash-components")
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = rooted.join(named, "root").select("fp", "component_id")
    return marked.join(classes, "fp").select("id", "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with one row left per component: the one with the smallest id (null ids last, further
    ties by row hash; of fully equal rows one stays)."""
    located = docs.select(
        F.col(id_col).alias("id"), fingerprint(F.col(text_col)).alias("fp"), row_hash(docs).alias("row")
    )
    return keep_least(docs, materialise(located, "simhash-rows"), links, id_col)


def row_hash(docs: DataFrame) -> Column:
    return F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns if docs.schema[c].dataType.typeName() != "map"])


def keep_least(
    docs: DataFrame, marked: DataFrame, edges: Callable[[DataFrame], DataFrame], id_col: str = "doc_id"
) -> DataFrame:
    """``keep_one`` for rows ``marked(id, fp, row)`` of ``docs``, row being ``row_hash``, and links ``edges`` (u, v)
    between the distinct ``fp`` of a table (fp, least), least having the first row of each."""
    row = row_hash(docs)
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "row"))
    distinct = materialise(marked.groupBy("fp").agg(first.alias("least")), "simhash-distinct")
    roots = connected_components(edges(distinct), "simhash-components")
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    kept = rooted.groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("least").alias("least"))
    kept = kept.select(F.col("least.id").alias("_of_id"), F.col("least.row").alias("_of_row"))
    copies = marked.groupBy(F.col("id").alias("_id"), F.col("row").alias("_row")).agg(F.count(F.lit(1)).alias("_n"))
    same = F.col("_id").eqNullSafe(F.col("_of_id")) & (F.col("_row") == F.col("_of_row"))
    kept = materialise(kept.join(copies, same).select("_of_id", "_of_row", "_n"), "simhash-kept")
    keyed = docs.select(row_struct(docs.columns).alias("doc"), F.col(id_col).alias("_id"), row.alias("_row"))
    once, often = kept.where("_n = 1"), kept.where("_n > 1")
    single = keyed.join(once, same, "left_semi")
    several = keyed.join(often, same, "left_semi").dropDuplicates(["_id", "_row"])
    return single.unionByName(several).select("doc.*")
