"""Secret scans over an incremental blob ledger, with DataFrame functions only.

Every version of every path is addressed by the SHA-256 of its content.  The ledger remembers which blob was scanned
by which version of which rule.  A scan reads only the blobs that some rule version has not seen, adds findings and
then the marks of what was seen, and findings are joined back to every path and version that holds the blob.

A ledger folder holds ``findings`` (batch, blob, rule, version, start, end) and ``seen`` (batch, blob, rules).  Marks
are appended after the findings of their batch, and findings count only with the mark of their own batch, so a run
that dies in between leaves nothing that is read.  One writer at a time is assumed.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.llm.common import row_struct
from starloom.session import materialise


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``pattern``; a match counts if ``group`` has ``least`` characters.

    ``trigger`` is a cheaper pattern that every text with a match contains.
    """

    name: str
    pattern: str
    group: int = 0
    least: int = 1
    version: int = 1
    trigger: str | None = None

    @property
    def key(self) -> str:
        return f"{self.name}@{self.version}"


_VALUE = r"[A-Za-z0-9+/_.=-]"
BASE_RULES = (
    Rule(
        "assign",
        rf"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?({_VALUE}+)""",
        group=2,
        least=6,
        trigger=rf"""(?i:passw(?:or)?d|secret|token|api_?key)["']?\x20*[:=]\x20*["']?{_VALUE}""",
    ),
    # A run that is too short fails as a whole, so the length can stand in the pattern of these two.
    Rule("access", r"AKIA[A-Z0-9]{16,}", least=20),
    Rule("hex", r"[0-9a-f]{24,}", least=24),
)
# A key without its END goes as far as its headers and body lines of 40 and more characters do, and a padded last line.
# Hyphens of a body come in runs of up to four, so it never reaches into another BEGIN.  Repetitions are possessive: they
# run in constant stack over bodies of any length, and what follows each of them can never be part of it.
_BEGIN_KEY = r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY(?: BLOCK)?-----"
_THROUGH_END = r"[^-]*+(?:-{1,4}+[^-]++)*+-{5,}END [A-Z ]{0,40}PRIVATE KEY(?: BLOCK)?-----"
_GAP, _BODY = r"[\x20\x09-\x0D]", r"[A-Za-z0-9+/=]{40,}+"
_WITHOUT_END = (
    rf"(?:{_GAP}*+[A-Za-z][A-Za-z0-9-]{{0,38}}:[^\n]*+\n)*+{_GAP}*+{_BODY}(?:{_GAP}++{_BODY})*+"
    rf"(?:{_GAP}++[A-Za-z0-9+/]+={{1,2}})?"
)
ADDED_RULES = (
    Rule("private", rf"{_BEGIN_KEY}(?:{_THROUGH_END}|{_WITHOUT_END})?", version=3, trigger=_BEGIN_KEY),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("webtoken", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]+"),
)
RULES = BASE_RULES + ADDED_RULES


def blob_id(text: Column) -> Column:
    """SHA-256 of the UTF-8 bytes; null counts as the empty text."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def find_spans(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, rule, version, start, end) of ``blobs(blob, text, todo)``; ``todo`` lists the rule keys to apply.

    A text is split at the matches of a rule; the lengths of the pieces and matches, summed up, are the positions in
    code points (end exclusive).  Only these lengths are exploded, never the text.
    """
    parts = []
    for rule in rules:
        text = F.when(
            F.array_contains("todo", rule.key) & F.col("text").rlike(rule.trigger or rule.pattern), F.col("text")
        )
        whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
        held = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else whole
        pieces = F.arrays_zip(
            F.transform(F.split(text, rule.pattern, -1), F.length).alias("before"),
            F.transform(whole, F.length).alias("size"),
            F.transform(held, F.length).alias("held"),
        )
        parts.append(
            F.when(
                text.isNotNull(),
                F.array(F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.version).alias("version"),
                                 F.lit(rule.least).alias("least"), pieces.alias("pieces"))),
            ).otherwise(F.array())
        )
    # The array_union of structs would drop equal ones; concat keeps them all.
    found = blobs.select("blob", F.explode(F.concat(*parts)).alias("r"))
    lengths = found.select("blob", "r.rule", "r.version", "r.least", F.posexplode("r.pieces").alias("at", "p"))
    lengths = lengths.distinct()  # an id may repeat with the same text
    so_far = Window.partitionBy("blob", "rule").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    ends = F.sum(F.col("p.before") + F.coalesce("p.size", F.lit(0))).over(so_far)
    placed = lengths.withColumn("end", ends)
    return placed.where("p.held >= least").select(
        "blob", "rule", "version", (F.col("end") - F.col("p.size")).alias("start"), "end"
    )


class BlobLedger:
    """What was scanned and found so far, in a folder that driver and executors share."""

    _FINDINGS = "batch string, blob binary, rule string, version int, start long, end long"
    _SEEN = "batch string, blob binary, rules array<string>"

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _read(self, name: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.folder}/{name}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def seen(self) -> DataFrame:
        return self._read("seen", self._SEEN)

    def findings(self, rules: tuple[Rule, ...] = RULES) -> DataFrame:
        """Committed findings of the given rule versions: blob, rule, start, end."""
        wanted = F.concat("rule", F.lit("@"), F.col("version").cast("string")).isin([r.key for r in rules])
        found = self._read("findings", self._FINDINGS).where(wanted)
        return found.join(self.seen().select("batch", "blob"), ["batch", "blob"], "left_semi").select(
            "blob", "rule", "start", "end"
        )

    def scan(self, versions: DataFrame, id_col: str, text_col: str, rules: tuple[Rule, ...] = RULES) -> None:
        """Scan every blob of ``versions`` that some rule version has not seen, and add it to the ledger.

        One row stands for a blob: the one with the smallest id.  Copies are aggregated before the shuffle, and of
        the texts only those to be scanned are joined.
        """
        rows = versions.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
        rows = rows.withColumn("blob", blob_id(F.col("text")))
        blobs = rows.groupBy("blob").agg(F.min("id").alias("first"))
        before = self.seen().select("blob", F.explode("rules").alias("rule")).groupBy("blob").agg(
            F.collect_set("rule").alias("done")
        )
        every = F.array(*[F.lit(rule.key) for rule in rules])
        todo = F.array_except(every, F.coalesce("done", F.array().cast("array<string>")))
        unseen = blobs.join(before, "blob", "left").select("blob", "first", todo.alias("todo")).where(F.size("todo") > 0)
        picked = unseen.withColumnRenamed("blob", "_blob").hint("shuffle_hash")
        same = (F.col("blob") == F.col("_blob")) & F.col("id").eqNullSafe(F.col("first"))
        texts = rows.join(picked, same).select("blob", "text", "todo")
        batch = uuid.uuid4().hex
        find_spans(texts, rules).select(F.lit(batch).alias("batch"), "*").write.mode("append").parquet(f"{self.folder}/findings")
        marks = unseen.select(F.lit(batch).alias("batch"), "blob", F.col("todo").alias("rules"))
        marks.write.mode("append").parquet(f"{self.folder}/seen")


def spans_by_blob(findings: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, spans): an array of structs start, rank, end, rule in order of start, then rule as listed.

    Bounded by the matches of one text.
    """
    rank = F.create_map(*[F.lit(x) for i, rule in enumerate(rules) for x in (rule.name, i)])[F.col("rule")]
    span = F.struct("start", rank.alias("rank"), "end", "rule")
    return findings.groupBy("blob").agg(F.array_sort(F.collect_list(span)).alias("spans"))


def attach(
    versions: DataFrame,
    text_col: str,
    findings: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """(doc, spans): each row of ``versions`` as a struct (of the columns ``carry``) and what was found in its blob.

    Clean rows get null.  The spans are written first, so that the join is not bound to their partitioning and the
    adaptive join can split the rows of a blob that many paths share.
    """
    found = materialise(spans_by_blob(findings, rules).withColumnRenamed("blob", "found_blob"), "secret-spans")
    keyed = versions.select(row_struct(carry or versions.columns).alias("doc"), blob_id(F.col(text_col)).alias("blob"))
    return keyed.join(found, F.col("blob") == F.col("found_blob"), "left").select("doc", "spans")


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every maximal run of overlapping spans replaced by ``mark``; unchanged without spans."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))

    def step(state: Column, span: Column) -> Column:
        ahead = span["start"] >= state["at"]
        gap = F.substring(text, (state["at"] + 1).cast("int"), (span["start"] - state["at"]).cast("int"))
        first = state["at"] == 0
        new = F.when(ahead & ((span["start"] > state["at"]) | first), F.concat(state["out"], F.array(gap, F.lit(mark))))
        return F.struct(F.greatest(state["at"], span["end"]).alias("at"), new.otherwise(state["out"]).alias("out"))

    def finish(state: Column) -> Column:
        rest = F.substring(text, (state["at"] + 1).cast("int"), F.lit(2**31 - 1))
        return F.concat(F.array_join(state["out"], ""), rest)

    return F.when(F.size(spans) > 0, F.aggregate(spans, start, step, finish)).otherwise(text)


def redact_documents(
    docs: DataFrame, ledger: BlobLedger, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars"
) -> DataFrame:
    """``docs`` with all found spans replaced in the text, and the length column, if there is one, set for those rows.

    Every row stays; rows without a finding are unchanged, null texts stay null.
    """
    ledger.scan(docs, id_col, text_col)
    found = attach(docs, text_col, ledger.findings()).withColumn(
        "clean", redact(F.col("doc")[text_col], F.col("spans"))
    )
    hit = F.size("spans") > 0
    new = {text_col: F.col("clean")}
    if length_col in docs.columns:
        kind = docs.schema[length_col].dataType
        new[length_col] = F.when(hit, F.length("clean").cast(kind)).otherwise(F.col("doc")[length_col])
    return found.select(*[new.get(c, F.col("doc")[c]).alias(c) for c in docs.columns])
