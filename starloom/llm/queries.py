"""The registered query of every operator of this package and of the pipeline, with SQL where SQL can express it."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import bounded_batches


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starloom.llm.substrings import substring_dedup

    found = substring_dedup(_table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starloom.llm.mixing import mix

    return mix(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "times"
    )


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starloom.llm.packing import pack_rows

    ids = _tokenizer(spark).encode(F.col("text")).alias("ids")
    return pack_rows(_table(spark, sf_dir, "documents").select("doc_id", ids))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starloom.llm.secrets import BASE_RULES, BlobLedger, attach
    from starloom.session import scratch_path

    documents = _table(spark, sf_dir, "documents")
    ledger = BlobLedger(spark, scratch_path(spark, "secret-ledger"))
    ledger.scan(documents, "doc_id", "text")
    found = attach(documents, "text", ledger.findings(), carry=["doc_id"]).select(
        "doc.doc_id", F.coalesce("spans", F.array().cast("array<struct<start:long,rank:int,end:long,rule:string>>")).alias("s")
    )
    joined = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["rule"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    base = F.filter("s", lambda s: s["rank"] < len(BASE_RULES))
    count = lambda name: F.size(F.filter("s", lambda s: s["rule"] == name)).cast("long")
    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("s")).alias("spans"),
    )


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starloom.llm.chat import format_conversations, read_back

    table = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = F.lit("</s>[INST] ok [/INST]").alias("text")
    fixed = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said,
    )
    read = read_back(format_conversations(table.unionByName(fixed)))
    said_turns = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    parts = F.struct(
        "run", "first", F.array_join(said_turns, "").alias("turns"), F.array_join("targets", "").alias("targets")
    )
    # The digests ask for whole conversations, so here, and only here, one is brought together.
    whole = read.groupBy("conv_id").agg(
        F.sum(F.size("turns")).cast("long").alias("n_turns"), F.array_sort(F.collect_list(parts)).alias("parts"),
        F.sum("n_chars").cast("long").alias("formatted_chars"),
    )
    joined = lambda name: F.array_join(F.transform("parts", lambda p: p[name]), "")
    return whole.select(
        "conv_id", "n_turns", F.sha2(joined("turns"), 256).alias("turns_sha256"),
        F.length(joined("targets")).cast("long").alias("loss_chars"),
        F.sha2(joined("targets"), 256).alias("loss_sha256"), "formatted_chars",
    )


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starloom.llm.toxicity import THRESHOLD, score_documents

    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_documents(documents, _table(spark, sf_dir, "labels"))
    return scored.select(
        "doc.doc_id", (F.col("trained") & (F.col("scores.toxic") >= THRESHOLD)).alias("toxic"),
        F.col("scores.junk").alias("p_junk"), F.col("scores.toxic").alias("p_toxic"),
    )


def op7_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starloom.llm.outliers import judge_documents

    return judge_documents(_table(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starloom.llm.simhash import near_duplicates

    found = near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _tokenizer(spark: SparkSession):
    import public_tokenizers

    from starloom.llm.bpe import Tokenizer

    return Tokenizer(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = _tokenizer(spark)
    documents = _table(spark, sf_dir, "documents")
    digest = tokenizer.digest(tokenizer.encode(F.col("text"))).alias("d")
    return documents.select("doc_id", digest).select("doc_id", "d.n_tokens", "d.ids_sha256", "d.decoded_sha256")


def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starloom.llm.neighbours import nearest

    return nearest(_table(spark, sf_dir, "embeddings"))


def op11_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starloom.llm.ngram_join import linked_documents

    found = linked_documents(_table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starloom.llm.periodic_runs import periodic_runs

    return periodic_runs(_table(spark, sf_dir, "documents"), repeat_tails=True).withColumnRenamed("id", "doc_id")


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from starloom.llm.alignment import Vocabularies, aligned_documents

    files = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    vocabularies = Vocabularies.read(*files, public_tokenizers.PATTERN)
    return aligned_documents(_table(spark, sf_dir, "documents"), vocabularies).withColumnRenamed("id", "doc_id")


_QUERIES = [
    op1_substrings, op2_mixing, op3_packing, op4_secrets, op5_chat, op6_toxicity, op7_outliers, op8_simhash, op9_bpe,
    op10_neighbours, op11_ngram_join, op12_periodic_runs, op13_alignment,
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: query for query in _QUERIES}


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_OP1_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 19], ' ') AS k
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM d WHERE len(ws) >= 20)),
later AS (SELECT doc_id, i FROM win QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM later),
words AS (SELECT doc_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS p FROM d),
kept AS (SELECT doc_id, string_agg(w, ' ' ORDER BY p) AS t, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""


def _op4_sql() -> str:
    """Spans by splitting at the matches and adding up the lengths; list sums replace the window."""
    from starloom.llm.secrets import BASE_RULES, RULES

    kinds = []
    for rank, rule in enumerate(RULES):
        # SQL's patterns know no possessive repetition and need none.
        pattern = re.sub(r"([*+}])\+", r"\1", rule.pattern).replace("'", "''")
        before = "coalesce(list_sum(list_transform(p[1:i], lambda x: length(x))), 0)"
        matched = "coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0)"
        kinds.append(f"""
        SELECT doc_id, '{rule.name}' AS rule, {rank} AS rank, {before} + {matched} AS s, {before} + {matched} + length(m[i]) AS e
        FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM (
            SELECT doc_id, regexp_extract_all(text, '{pattern}', 0) AS m, regexp_extract_all(text, '{pattern}', {rule.group}) AS h,
                   string_split_regex(text, '{pattern}') AS p FROM documents WHERE text IS NOT NULL))
        WHERE length(h[i]) >= {rule.least}""")
    said = "rule || ':' || CAST(s AS BIGINT) || ':' || CAST(e AS BIGINT)"
    counts = ", ".join(f"count(*) FILTER (rule = '{rule.name}') AS n_{rule.name}" for rule in BASE_RULES)
    return f"""
    WITH f AS ({" UNION ALL ".join(kinds)}),
    g AS (SELECT doc_id, {counts}, string_agg({said}, ',' ORDER BY s, rank) FILTER (rank < {len(BASE_RULES)}) AS base,
                 string_agg({said}, ',' ORDER BY s, rank) AS spans FROM f GROUP BY doc_id)
    SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
           sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM documents LEFT JOIN g USING (doc_id)"""


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

_OP11_SQL = rf"""
WITH RECURSIVE d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
sh AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
       ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS s FROM d),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS i FROM sh a JOIN sh b USING (s) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT u, v FROM pairs JOIN n a ON a.doc_id = u JOIN n b ON b.doc_id = v WHERE 100 * i >= 80 * (a.n + b.n - i)),
reach AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT reach.doc_id, v FROM reach JOIN links ON u = other)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id FROM reach LEFT JOIN n USING (doc_id) GROUP BY doc_id"""


def oracle_sql() -> dict[str, str]:
    """The others return fingerprints, draws, packings, trained verdicts, runs or token ids, for which SQL has no form that
    is fast enough over whole tables."""
    return {"op1_substrings": _OP1_SQL, "op4_secrets": _op4_sql(), "op11_ngram_join": _OP11_SQL}
