"""Mixing sources to target weights by cube-method balanced sampling.

Every document is taken ``floor(rate)`` times for certain, where rate = target / size of its source, and once more
with probability ``rate - floor(rate)``.  Which documents are taken once more is decided by the cube method: the
vector of inclusion probabilities moves inside the unit cube, along directions that change neither the expected number
of documents nor their expected words, until it reaches a corner in all but two coordinates.

The flight runs in blocks of bounded size, dealt by a hash so that a large source has many.  What is left of each block
(two documents at most) flies again with what is left of others, level by level, until one block per source remains.
There the last documents stay undecided, and land together on the corner that is nearest to the targets.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import row_struct, stream_groups, text_bytes, word_blocks
from starloom.operators.keys import assign_surrogate_keys
from starloom.session import materialise

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5  # of all words
MOST = 2.0  # times a source
BLOCK_ROWS = 4096
COPIES = 10_000  # equal rows numbered from one array
LANDING = 12  # documents of the last block that do not fly
EDGE = 1e-9
SEED = 42


def word_count(text: Column) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+`` in the whole text; null has none."""

    @F.arrow_udf("long")
    def count_words(texts: pa.Array) -> pa.Array:
        return pa.array([sum(map(len, word_blocks(raw))) for raw in text_bytes(texts)], type=pa.int64())

    return count_words(text)


def source_targets(
    sized: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """(source, source_size, target) with one row per source of ``sized(source, size)``.

    Sources in code-point order, null last, get the weights in turn.  Targets share ``share`` of all words by weight;
    a target over ``most`` times its source stops there and the excess is shared again among the others, until none is
    above.  Each round is one sum over the sources; nothing but sums comes to the driver.
    """
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    named = sizes.withColumn("absent", F.col("source").isNull())
    ranked = materialise(assign_surrogate_keys(named, ["absent", "source"], "rank"), "mix-sources")
    turn = F.pmod(F.col("rank") - 1, F.lit(len(weights))).cast("int")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1)
    ranked = ranked.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * most).alias("limit"))
    total = (ranked.agg(F.sum("source_size")).first()[0] or 0) * share
    level, full = None, -1
    while True:
        stopped = F.lit(False) if level is None else F.col("weight") * level > F.col("limit")
        limited, free, count = ranked.agg(
            F.coalesce(F.sum(F.when(stopped, F.col("limit"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~stopped, F.col("weight"))), F.lit(0.0)),
            F.count_if(stopped),
        ).first()
        if count == full or not free:
            break
        full, level = count, (total - limited) / free
    target = F.least(F.col("weight") * F.lit(float(level or 0.0)), F.col("limit"))
    return ranked.select("source", "source_size", target.alias("target"))


def flight(chance: np.ndarray, size: np.ndarray, seed: np.ndarray | None = None) -> np.ndarray:
    """Move the chances of one block to 0 or 1, all but two at most, keeping their sum and the sum of chance * size.

    The first three undecided documents move along the direction that is orthogonal to (1, 1, 1) and to their sizes;
    the side is drawn with the probability of the other one's distance, so that no chance changes in expectation.  The
    draw is a hash of the documents' ``seed`` (their positions without one), so that a rerun decides alike.
    """
    seeds = (np.arange(len(chance)) if seed is None else seed).astype(np.uint64)
    value = chance.astype(np.float64).copy()
    words = size.tolist()
    p = value.tolist()
    active = [i for i, x in enumerate(p) if EDGE < x < 1 - EDGE]
    active.reverse()
    held: list[int] = []
    while True:
        while len(held) < 3 and active:
            held.append(active.pop())
        if len(held) < 2:
            break
        if len(held) == 3:
            i, j, k = held
            a, b, c = words[i], words[j], words[k]
            u = (float(c - b), float(a - c), float(b - a))
            if u == (0.0, 0.0, 0.0):
                u = (1.0, -1.0, 0.0)
        elif words[held[0]] == words[held[1]]:
            u = (1.0, -1.0)
        else:
            break
        up = min((1 - p[i]) / x if x > 0 else p[i] / -x for i, x in zip(held, u) if x)
        down = min(p[i] / x if x > 0 else (1 - p[i]) / -x for i, x in zip(held, u) if x)
        drawn = xxhash.xxh64_intdigest(seeds[held].tobytes(), SEED) / 2.0**64
        move = up if drawn * (up + down) < down else -down
        for i, x in zip(held, u):
            p[i] += move * x
            if p[i] < EDGE:
                p[i] = 0.0
            elif p[i] > 1 - EDGE:
                p[i] = 1.0
        held = [i for i in held if 0.0 < p[i] < 1.0]
    return np.array(p)


def landing(chance: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Decide the last few documents: of all corners the one nearest to the expected words and count.

    A document too many costs as much as a quarter of a mean document's words.
    """
    left = np.flatnonzero((chance > EDGE) & (chance < 1 - EDGE))
    value = np.round(chance)
    if len(left):
        corners = (np.arange(1 << len(left))[:, None] >> np.arange(len(left)) & 1).astype(float)
        words = np.abs(corners @ size[left] - chance[left] @ size[left]) / max(float(size[left].mean()), 1.0)
        count = np.abs(corners.sum(axis=1) - chance[left].sum())
        value[left] = corners[np.argmin(words + 0.25 * count)]
    return value


def decide_block(chance: np.ndarray, size: np.ndarray, last: bool, seed: np.ndarray | None = None) -> np.ndarray:
    """Chances of a block after its flight; of the ``last`` block of a source, after the landing."""
    if not last:
        return flight(chance, size, seed)
    open_ = np.flatnonzero((chance > EDGE) & (chance < 1 - EDGE))
    value = chance.copy()
    flying = open_[:-LANDING]
    value[flying] = flight(chance[flying], size[flying], None if seed is None else seed[flying])
    return landing(value, size)


_ROWS = "source_id long, place long, row long, size long, chance double"
_KEYS = ["source_id", "row", "size"]


def _fly(rows: DataFrame, land: bool, level: int) -> DataFrame:
    keys = ["source_id", "place"]

    def decide(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in stream_groups(batches, keys):
            seed = group.pop("seed")
            group["chance"] = decide_block(group["chance"], group["size"], land, seed.view(np.uint64))
            yield pa.RecordBatch.from_pydict({name: pa.array(values) for name, values in group.items()})

    ordered = rows.repartition(*keys).sortWithinPartitions(*keys, "order", "size", "row")
    seed = F.xxhash64(*_KEYS, F.lit(level)).alias("seed")
    return ordered.select("source_id", "place", "row", "size", "chance", seed).mapInArrow(decide, _ROWS)


def balanced_draw(rows: DataFrame, label: str = "mix", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(source_id, row, size, extra), extra 0 or 1, for every undecided row of ``rows(source_id, row, size, chance)``;
    ``row`` is unique among the rows of a source and size.

    Rows with a chance of 0 or 1 are left out.
    """
    order = F.xxhash64("row").alias("order")
    left = rows.where(F.col("chance").between(EDGE, 1 - EDGE)).select("source_id", "row", "size", "chance", order)
    most = left.groupBy("source_id").count().agg(F.max("count")).first()[0] or 0
    decided = []
    level = 0
    blocks = -(-most // (block_rows // 2))
    while True:
        place = F.pmod(F.xxhash64("row", F.lit(level)), F.lit(max(blocks, 1)))
        flown = _fly(left.withColumn("place", place), land=blocks <= 1, level=level)
        flown = materialise(flown, f"{label}-level{level}")
        decided.append(flown.where(~F.col("chance").between(EDGE, 1 - EDGE)))
        if blocks <= 1:
            break
        left = flown.where(F.col("chance").between(EDGE, 1 - EDGE)).select("source_id", "row", "size", "chance", order)
        blocks = 1 if 2 * blocks <= block_rows else -(-2 * blocks // (block_rows // 2))
        level += 1
    out = decided[0]
    for more in decided[1:]:
        out = out.unionByName(more)
    return out.select(*_KEYS, F.round("chance").cast("int").alias("extra"))


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """(doc_id, source, row_hash, copy, size, source_size, target, times, taken) with one row per document.

    ``times`` is how often the mix takes the document, ``taken`` its words in the mix.  Null texts and texts without
    words have size 0 and are taken like others (they do not count in words).  Null sources are one source, the last.
    Repeated ids are documents of their own; fully equal rows are told apart by number.  Extra columns are ignored;
    an empty table gives an empty result.  ``row_hash`` identifies equal rows: xxhash64 of id, source and text.
    """
    source = F.col(source_col)
    sized = materialise(
        docs.select(
            F.col(id_col).alias("doc_id"), source.alias("source"), word_count(F.col(text_col)).alias("size"),
            F.xxhash64(F.col(id_col), source, F.col(text_col)).alias("row_hash"),
        ),
        "mix-sizes",
    )
    # One line per kind of row with its number of copies: every copy is an own document below.
    kinds = sized.groupBy("doc_id", "source", "size", "row_hash").agg(F.count(F.lit(1)).alias("copies"))
    targets = materialise(source_targets(sized, weights, share, most).withColumn(
        "source_id", F.xxhash64("source", F.col("source").isNull())), "mix-targets")
    source_id = F.xxhash64("source", F.col("source").isNull())
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rated = kinds.withColumn("source_id", source_id).join(
        targets.select("source_id", "source_size", "target", rate.alias("rate")), "source_id"
    )
    sure = F.floor(F.col("rate") + EDGE)
    tens = F.explode(F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / COPIES)))
    ones = F.explode(F.sequence(F.lit(1), F.least(F.lit(COPIES), F.col("copies") - F.col("_tens") * COPIES)))
    numbered = rated.withColumn("_tens", tens).withColumn("_ones", ones)
    each = numbered.withColumn("copy", F.col("_tens") * COPIES + F.col("_ones")).select(
        "source_id", "doc_id", "source", "row_hash", "size", "source_size", "target", "copy", sure.alias("sure"),
        F.greatest(F.col("rate") - sure, F.lit(0.0)).alias("chance"),
        F.xxhash64("doc_id", "row_hash", "copy").alias("row"),
    )
    each = materialise(each, "mix-documents")
    drawn = balanced_draw(each.select("source_id", "row", "size", "chance"))
    times = (F.col("sure") + F.coalesce("extra", F.round("chance").cast("int"))).cast("int")
    return each.join(drawn, _KEYS, "left").select(
        "doc_id", "source", "row_hash", "copy", "size", "source_size", "target", times.alias("times"),
        (times * F.col("size")).cast("long").alias("taken"),
    )


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, columns unchanged."""
    names = {k: options.get(k, d) for k, d in (("id_col", "doc_id"), ("text_col", "text"), ("source_col", "source"))}
    drawn = mix(docs, **options).groupBy(F.col("doc_id").alias("_id"), F.col("row_hash").alias("_row")).agg(
        F.sum("times").alias("_times"), F.count(F.lit(1)).alias("_copies")
    ).withColumnsRenamed({"_id": "_of_id", "_row": "_of_row"})
    drawn = materialise(drawn, "mix-times")
    row = F.xxhash64(*[F.col(c) for c in (names["id_col"], names["source_col"], names["text_col"])])
    keyed = docs.select(
        row_struct(docs.columns).alias("doc"), F.col(names["id_col"]).alias("_id"), row.alias("_row")
    )
    both = F.col("_id").eqNullSafe(F.col("_of_id")) & (F.col("_row") == F.col("_of_row"))
    # Equal rows share their takings: the first ones are taken once more than the rest, so any of them will do.
    joined = keyed.join(drawn, both)
    base, extra = F.floor(F.col("_times") / F.col("_copies")).cast("int"), F.col("_times") % F.col("_copies")
    once = joined.where("_copies = 1").withColumn("_n", F.col("_times").cast("int"))
    number = F.row_number().over(Window.partitionBy("_id", "_row").orderBy(F.lit(1)))
    same = joined.where("_copies > 1").withColumn("_n", base + F.when(number <= extra, 1).otherwise(0))
    rows = once.unionByName(same).where("_n > 0").withColumn("_n", F.explode(F.sequence(F.lit(1), F.col("_n"))))
    return rows.select("doc.*")
