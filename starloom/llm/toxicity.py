"""Toxicity by a classifier chain.

Categories are predicted one after the other by linear models over the words of a whole text and over the beginnings
of its words, which find inflected and compounded forms; every model also sees the log-odds of the categories before
it.  While training, those are out-of-fold predictions, so that a later model learns from odds as reliable as the ones
it will be given.  The models are fitted on a bounded sample of the labelled rows (``SAMPLE_ROWS``) and have at most
``MAX_TERMS`` terms, so what is broadcast does not grow with the corpus.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import row_struct, text_bytes, word_blocks
from starloom.session import materialise

SAMPLE_ROWS = 8_000
MAX_TERMS = 4_096
MIN_DOCS = 4  # of the sample, that a term must occur in
MAX_SHARE = 0.1  # of the sample; terms in more documents say nothing by themselves
MERIT = 5.0  # standard errors by which a term must be more frequent in a category
MOST = 5  # distinct words with one beginning that count
PREFIXES = range(4, 10)  # bytes
FOLDS = 5
STEPS = 300
RIDGE = 3e-4
ODDS = 8.0  # log-odds are cut here before a later model sees them

_PLAIN = bytes(
    c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256)
)


def word_set(raw: bytes) -> set[bytes]:
    """Distinct words of a whole text, ASCII lower case, ASCII punctuation counting as space."""
    found: set[bytes] = set()
    for words in word_blocks(raw.translate(_PLAIN)):
        found.update(words)
    return found


def term_counts(words: Iterable[bytes]) -> Counter[bytes]:
    """Every distinct word once, and for every beginning (marked by ^) the number of words with it, ``MOST`` at most."""
    counts: Counter[bytes] = Counter()
    for word in words:
        counts[word] = 1
        for size in PREFIXES:
            if len(word) < size:
                break
            counts[b"^" + word[:size]] += 1
    return Counter({term: min(count, MOST) for term, count in counts.items()})


@dataclass
class Linear:
    weights: np.ndarray
    earlier: np.ndarray
    bias: float

    def odds(self, rows: np.ndarray, cols: np.ndarray, counts: np.ndarray, before: np.ndarray) -> np.ndarray:
        words = np.bincount(rows, self.weights[cols] * counts, minlength=len(before))
        return words + before @ self.earlier + self.bias


def fit_linear(
    rows: np.ndarray, cols: np.ndarray, counts: np.ndarray, before: np.ndarray, wanted: np.ndarray, terms: int
) -> Linear:
    """Logistic regression with a ridge on the term weights, by full-batch Adam steps; deterministic."""
    n, width = len(wanted), before.shape[1]
    theta = np.zeros(terms + width + 1)
    rate = np.clip(wanted.mean() if n else 0.5, 1e-3, 1 - 1e-3)
    theta[-1] = np.log(rate / (1 - rate))
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        model = Linear(theta[:terms], theta[terms:-1], theta[-1])
        off = 1 / (1 + np.exp(-np.clip(model.odds(rows, cols, counts, before), -30, 30))) - wanted
        words = np.bincount(cols, off[rows] * counts, minlength=terms)
        slope = np.concatenate([words, off @ before, [off.sum()]]) / max(n, 1)
        slope[:terms] += RIDGE * theta[:terms]
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope**2
        theta = theta - 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return Linear(theta[:terms], theta[terms:-1], float(theta[-1]))


@dataclass
class Chain:
    """Fitted models in the order of the categories."""

    categories: list[str]
    terms: list[bytes]
    models: list[Linear] = field(default_factory=list)
    trained: bool = True  # on one labelled row at least

    def predict(self, rows: np.ndarray, cols: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
        """Probabilities, one column per category, for n texts with ``counts[i]`` of term ``cols[i]`` in ``rows[i]``."""
        odds = np.zeros((n, 0))
        for model in self.models:
            odds = np.column_stack([odds, np.clip(model.odds(rows, cols, counts, odds), -ODDS, ODDS)])
        return 1 / (1 + np.exp(-odds))

    def score(self, text: Column) -> Column:
        """STRUCT of one probability per category for a text column; null counts as the empty text."""
        kind = ", ".join(f"`{name}`: double" for name in self.categories)
        shared, names = self, list(self.categories)

        @F.arrow_udf(f"struct<{kind}>")
        def chain_score(texts: pa.Array) -> pa.Array:
            number = {term: i for i, term in enumerate(shared.terms)}
            shortest = PREFIXES[0]
            begins = {term[1: 1 + shortest] for term in shared.terms if term[:1] == b"^"}
            rows, cols, counts = [], [], []
            for row, raw in enumerate(text_bytes(texts)):
                # Only words that are terms, or begin like one, can count.
                near = [word for word in word_set(raw) if word[:shortest] in begins or word in number]
                hits = sorted((number[t], n) for t, n in term_counts(near).items() if t in number)
                cols.extend(col for col, _ in hits)
                counts.extend(n for _, n in hits)
                rows.extend([row] * len(hits))
            held = (np.array(column, dtype=np.int64) for column in (rows, cols, counts))
            found = shared.predict(*held, len(texts))
            return pa.StructArray.from_arrays([pa.array(column) for column in found.T], names=names)

        return chain_score(text)


def fit_chain(
    terms: list[bytes], rows: np.ndarray, cols: np.ndarray, counts: np.ndarray, wanted: Mapping[str, np.ndarray],
    fold: np.ndarray,
) -> Chain:
    """Fit on ``counts[i]`` of term ``cols[i]`` in text ``rows[i]``; ``fold`` numbers the fold of each text."""
    n = len(fold)
    chain = Chain(list(wanted), terms)
    before = np.zeros((n, 0))
    for values in wanted.values():
        odds = np.zeros(n)
        for part in range(FOLDS):
            train, held = np.flatnonzero(fold != part), np.flatnonzero(fold == part)
            if not len(held):
                continue
            place = np.zeros(n, dtype=np.int64)
            place[train], place[held] = np.arange(len(train)), np.arange(len(held))
            inside = fold[rows] != part
            own = place[rows[inside]], cols[inside], counts[inside]
            model = fit_linear(*own, before[train], values[train], len(terms))
            odds[held] = model.odds(place[rows[~inside]], cols[~inside], counts[~inside], before[held])
        chain.models.append(fit_linear(rows, cols, counts, before, values, len(terms)))
        before = np.column_stack([before, np.clip(odds, -ODDS, ODDS)])
    return chain


def _sample_terms(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, terms, counts = [], [], []
        for id_, raw in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1))):
            found = term_counts(word_set(raw))
            ids += [id_] * len(found)
            terms += found.keys()
            counts += found.values()
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, type=pa.int64()), pa.array(terms, type=pa.binary()), pa.array(counts, type=pa.int32())],
            names=["_id", "term", "n"],
        )


def train_chain(
    docs: DataFrame,
    labels: DataFrame,
    categories: Mapping[str, str],
    id_col: str = "doc_id",
    text_col: str = "text",
    sample_rows: int = SAMPLE_ROWS,
) -> Chain:
    """Fit a chain on at most ``sample_rows`` labelled documents, those with the smallest hash of the id.

    ``categories`` names each category, in chain order, with a boolean SQL expression over ``labels``.  An id with
    several labels belongs to a category if one of them says so; labels that are null or have no document are left
    out; of several texts of one id the smallest is used.  Without any labelled row every probability is one half.
    """
    marks = [f"_{i}" for i in range(len(categories))]
    named = [F.max(F.expr(rule).cast("int")).alias(mark) for mark, rule in zip(marks, categories.values())]
    known = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("_id")).agg(*named).dropna()
    order = F.xxhash64("_id")
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    sample = known.orderBy(order, "_id").limit(sample_rows)
    # The broadcast side has at most sample_rows rows of a few numbers.
    chosen = texts.join(F.broadcast(sample), "_id").groupBy("_id").agg(
        F.min("_text").alias("_text"), *[F.first(mark).alias(mark) for mark in marks]
    )
    chosen = materialise(chosen, "toxicity-sample")
    drawn = chosen.orderBy(order, "_id").select("_id", F.pmod(F.shiftright(order, 7), F.lit(FOLDS)).alias("_fold"), *marks)
    rows = drawn.toArrow()
    n = rows.num_rows
    if not n:
        return Chain(list(categories), [], [Linear(np.zeros(0), np.zeros(i), 0.0) for i in range(len(categories))], trained=False)
    wanted = {name: rows[mark].to_numpy().astype(float) for name, mark in zip(categories, marks)}

    terms = materialise(chosen.select("_id", "_text").mapInArrow(_sample_terms, "_id long, term binary, n int"), "toxicity-terms")
    totals = terms.join(F.broadcast(drawn), "_id").groupBy("term").agg(
        F.count(F.lit(1)).alias("docs"), *[F.sum(mark).alias(mark) for mark in marks]
    )
    merits = []
    for mark, values in zip(marks, wanted.values()):
        rate = float(np.clip(values.mean(), 1e-6, 1 - 1e-6))
        merits.append((F.col(mark) - F.col("docs") * rate) / F.sqrt(F.col("docs") * (rate * (1 - rate))))
    best = totals.withColumn("merit", F.greatest(*merits) if len(merits) > 1 else merits[0]).where(
        (F.col("docs") >= MIN_DOCS) & (F.col("docs") <= max(MAX_SHARE * n, MIN_DOCS)) & (F.col("merit") >= MERIT)
    )
    best = best.orderBy(F.desc("merit"), "term").limit(MAX_TERMS).select("term").toArrow()["term"].to_pylist()
    numbered = docs.sparkSession.createDataFrame([(t, i) for i, t in enumerate(best)], "term binary, number int")
    held = terms.join(F.broadcast(numbered), "term").select("_id", "number", "n").toArrow()
    place = {id_: i for i, id_ in enumerate(rows["_id"].to_pylist())}
    at = np.array([place[id_] for id_ in held["_id"].to_pylist()], dtype=np.int64)
    cols, counts = held["number"].to_numpy().astype(np.int64), held["n"].to_numpy().astype(np.int64)
    # In one order, whatever the tasks did: sums in floating point depend on it.
    first = np.lexsort((cols, at))
    return fit_chain(best, at[first], cols[first], counts[first], wanted, rows["_fold"].to_numpy().astype(np.int64))


#: The categories that the table ``labels`` knows, in chain order.
LABEL_CATEGORIES = {"junk": "quality = 0", "toxic": "toxic = 1"}
THRESHOLD = 0.5


def score_documents(docs: DataFrame, labels: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """(doc, scores, trained): every row of ``docs`` as a struct, one probability per category of ``labels``, and
    whether any label stands behind them; without one, no document is to be called toxic."""
    chain = train_chain(docs, labels, LABEL_CATEGORIES, text_col=text_col, **options)
    return docs.select(row_struct(docs.columns).alias("doc"), chain.score(F.col(text_col)).alias("scores"),
                       F.lit(chain.trained).alias("trained"))


def reject_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """The rows of ``docs`` whose probability of the last category is below ``threshold``, columns unchanged; all
    of them if no label was there to learn from."""
    last = list(LABEL_CATEGORIES)[-1]
    return score_documents(docs, labels, **options).where(~F.col("trained") | (F.col(f"scores.{last}") < threshold)).select("doc.*")
