"""Quality rules by robust multivariate outliers.

Every document has a vector of transformed text statistics.  For every language and source the minimum covariance
determinant estimate is taken over the documents that pass the base rules: concentration steps, each of which keeps
the ``SHARE`` of the rows nearest to the last estimate and takes their mean and covariance.  A document is rejected if
its Mahalanobis distance is beyond what ``CUTOFF`` allows.

The statistics are narrow and written once.  A step is one quantile sketch and one sum of moments per group, both
combined in the map tasks.  Rows meet the estimate of their group by group and salt, one salt per shuffle partition, so
a source with a third of all rows is no hot key.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import text_bytes
from starloom.operators.lookup import shuffle_partitions
from starloom.session import materialise

SHARE = 0.75
SHARE_QUANTILE = 6.6257  # of the chi-squared distribution with five degrees of freedom, at SHARE
CUTOFF = 75.0  # squared distance; no normal vector gets there, but clean texts have heavier tails
STEPS = 5
LEAST_ROWS = 50  # smaller groups are judged by their language, then by the corpus
#: Standard deviations that no estimate goes below, in the order of ``_FEATURES``.
FLOORS = (0.7, 0.2, 0.06, 0.2, 0.2)

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
REPEAT_WORDS = 5
_SYMBOLS = b"#*$%&|<>"
_SPACES = b" \t\n\x0b\x0c\r"

_STATISTICS = "struct<n_words: bigint, word_chars: bigint, n_symbols: bigint, n_lines: bigint, n_dup_lines: bigint, " \
    "n_repeat_words: bigint>"


def repeat_words(words: list[bytes], size: int = REPEAT_WORDS) -> int:
    """Words in windows of ``size`` words that are found twice or more, the first included; exact."""
    if len(words) <= size:
        return 0
    number: dict[bytes, int] = {}
    codes = np.fromiter((number.setdefault(word, len(number)) for word in words), dtype=np.int64, count=len(words))
    single = codes
    for i in range(1, size):
        codes = codes[:-1] * len(number) + single[i:]
        if i < size - 1 and (int(codes.max()) + 1) * len(number) >= 2**62:
            codes = np.unique(codes, return_inverse=True)[1]
    _, inverse, many = np.unique(codes, return_inverse=True, return_counts=True)
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    again = np.flatnonzero(many[inverse] > 1)
    np.add.at(edge, again, 1)
    np.add.at(edge, again + size, -1)
    return int((np.cumsum(edge) > 0).sum())


def text_statistics(text: Column) -> Column:
    """STRUCT of the counts of a whole text; null counts as empty."""

    @F.arrow_udf(_STATISTICS)
    def statistics(texts: pa.Array) -> pa.Array:
        rows = []
        for raw in text_bytes(texts):
            words = raw.split()
            inside = raw.translate(None, _SPACES)
            points = len(inside) - len(inside.translate(None, bytes(range(128)) + bytes(range(192, 256))))
            seen: set[bytes] = set()
            lines = same = 0
            for line in raw.split(b"\n"):
                if line.strip(_SPACES):
                    lines += 1
                    same += line in seen
                seen.add(line)
            symbols = len(raw) - len(raw.translate(None, _SYMBOLS))
            rows.append((len(words), points, symbols, lines, same, repeat_words(words)))
        columns = list(zip(*rows)) or [[]] * 6
        names = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]
        return pa.StructArray.from_arrays([pa.array(c, type=pa.int64()) for c in columns], names=names)

    return statistics(text)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _share(part: str, whole: str) -> Column:
    return F.asin(F.sqrt(F.least(F.col(part) / F.greatest(F.col(whole), F.lit(1)), F.lit(1.0))))


def _features() -> list[Column]:
    """Logarithms of length and mean word length, and shares on the scale that makes their variance even."""
    return [
        F.log1p(F.col("n_words").cast("double")),
        F.log(F.greatest(F.col("word_chars"), F.lit(1)) / F.greatest(F.col("n_words"), F.lit(1))),
        _share("n_symbols", "word_chars"), _share("n_dup_lines", "n_lines"), _share("n_repeat_words", "n_words"),
    ]


_P = len(FLOORS)
_PAIRS = [(i, j) for i in range(_P) for j in range(i, _P)]


def _estimate(moments: Column) -> Column:
    """Center and inverse scatter (upper triangle) from count, sums and sums of products."""

    @F.arrow_udf("array<double>")
    def estimate(rows: pa.Array) -> pa.Array:
        sums = np.asarray(rows.flatten(), dtype=np.float64).reshape(-1, 1 + _P + len(_PAIRS))
        out = []
        for row in sums:
            center = row[1: 1 + _P] / row[0]
            scatter = np.diag(np.square(FLOORS)).astype(float)
            for value, (i, j) in zip(row[1 + _P:] / row[0], _PAIRS):
                covariance = value - center[i] * center[j]
                scatter[i, j] += covariance
                if i != j:
                    scatter[j, i] += covariance
            inverse = np.linalg.inv(scatter)
            out.append(np.concatenate([center, [inverse[i, j] for i, j in _PAIRS]]))
        return pa.array([list(row) for row in out], type=pa.list_(pa.float64()))

    return estimate(moments)


def _moments() -> list[Column]:
    x = [F.col("x")[i] for i in range(_P)]
    return [F.array(F.count(F.lit(1)).cast("double"), *[F.sum(v) for v in x], *[F.sum(x[i] * x[j]) for i, j in _PAIRS])]


def _distance() -> Column:
    away = [F.col("x")[i] - F.col("model")[i] for i in range(_P)]
    total = F.lit(0.0)
    for at, (i, j) in enumerate(_PAIRS):
        total = total + (1.0 if i == j else 2.0) * F.col("model")[_P + at] * away[i] * away[j]
    return total


def minimum_covariance(rows: DataFrame, steps: int = STEPS, share: float = SHARE) -> DataFrame:
    """(g, model, scale) per group of ``rows(g, salt, x)``: center and inverse scatter, and the factor that makes the
    ``share`` quantile of the squared distances that of a normal vector.  ``salt`` runs from 0 to the number of shuffle
    partitions, exclusive.

    Starts from the coordinate medians with the floors as scatter.  Quantiles are sketches with an error of one
    ten-thousandth of the rows.
    """
    salt = F.explode(F.sequence(F.lit(0), F.lit(shuffle_partitions(rows.sparkSession) - 1))).alias("salt")

    def meet(left: DataFrame, right: DataFrame) -> DataFrame:
        return left.join(right.select("*", salt), ["g", "salt"])

    middle = rows.groupBy("g").agg(F.array(*[F.percentile_approx(F.col("x")[i], 0.5, 10_000) for i in range(_P)]).alias("m"))
    start = F.concat("m", F.array(*[F.lit(1 / FLOORS[i] ** 2 if i == j else 0.0) for i, j in _PAIRS]))
    model = materialise(middle.select("g", start.alias("model")), "mcd-start")
    for step in range(steps):
        away = meet(rows, model).select("g", "salt", "x", _distance().alias("d"))
        bound = away.groupBy("g").agg(F.percentile_approx("d", share, 10_000).alias("bound"))
        nearest = meet(away, bound).where("d <= bound")
        sums = nearest.groupBy("g").agg(*[m.alias("sums") for m in _moments()])
        model = materialise(sums.select("g", _estimate(F.col("sums")).alias("model")), f"mcd-step{step}")
    scale = meet(rows, model).groupBy("g").agg(
        (F.percentile_approx(_distance(), share, 10_000) / SHARE_QUANTILE).alias("scale")
    )
    return materialise(model.join(scale, "g"), "mcd-model")


def judge_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
    cutoff: float = CUTOFF, least_rows: int = LEAST_ROWS,
) -> DataFrame:
    """(doc_id, counts, base_failed, kept, distance) with one row per row of ``docs``.

    ``distance`` is the squared robust distance in the group.  Groups of less than ``least_rows`` documents are judged by
    the estimate over all documents of their language, or of the corpus if the language has too few.  It is null where the
    base rules failed, or where the whole corpus has too few documents; the latter are kept.  Null languages and sources are groups like
    others; null texts have no words and fail; repeated rows each get a result.  Other columns are ignored; an empty
    table gives an empty result.
    """
    stats = docs.select(
        F.col(id_col).alias("doc_id"), F.col(lang_col).cast("string").alias("lang"),
        F.col(source_col).cast("string").alias("source"), text_statistics(F.col(text_col)).alias("s"),
    ).select("doc_id", "lang", "source", "s.*")
    stats = stats.withColumn("base_failed", base_failed()).withColumn("x", F.array(*_features()))
    by_source = F.to_json(F.struct("lang", "source"))
    by_lang = F.to_json(F.struct("lang"))
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(shuffle_partitions(docs.sparkSession))).cast("int")
    named = stats.withColumns({"by_source": by_source, "by_lang": by_lang, "salt": salt})
    stats = materialise(named, "quality-statistics")

    passed = stats.where("NOT base_failed")
    sources = passed.groupBy("by_source", "by_lang").agg(F.count(F.lit(1)).alias("n"))
    langs = materialise(sources.groupBy("by_lang").agg(F.sum("n").alias("in_lang"), F.min("n").alias("least")), "quality-langs")
    total, least_lang = langs.agg(F.coalesce(F.sum("in_lang"), F.lit(0)), F.min("in_lang")).first()
    everywhere = total >= least_rows > (least_lang or 0)  # some language is judged by the whole corpus
    large, some = F.col("n") >= least_rows, F.col("in_lang") >= least_rows
    lang = F.concat("by_lang", F.lit("*"))
    group = F.when(large, F.col("by_source")).when(some, lang).when(F.lit(everywhere), "*")
    feeds = F.array_compact(F.array(
        F.when(large, F.col("by_source")), F.when(some & (F.col("least") < least_rows), lang), F.when(F.lit(everywhere), "*")
    ))
    groups = materialise(sources.join(langs, "by_lang").select("by_source", group.alias("g"), feeds.alias("feeds")), "quality-groups")

    fed = passed.join(groups.select("by_source", "feeds"), "by_source").select(F.explode("feeds").alias("g"), "salt", "x")
    rows = materialise(fed, "quality-rows")
    models = groups.join(minimum_covariance(rows), "g").select("by_source", "model", "scale")
    judged = stats.join(models, "by_source", "left").withColumn(
        "distance", F.when(~F.col("base_failed"), _distance() / F.greatest("scale", F.lit(1e-3)))
    )
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= cutoff)).alias("kept"), "distance",
    )
