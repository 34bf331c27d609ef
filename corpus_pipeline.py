"""The corpus pipeline: each stage applies one operator of ``statmart.llm`` to what its predecessor kept.

Every stage but the last takes and returns the columns of ``documents``; the last returns the
tokens. Between two stages the rows are written to the cluster's shared folder and read again; a
stage's rows are deleted once the next has written its own.

In every stage a column that bears the name of one of the operator's outputs keeps its own values, a
repeated row is judged like its twin, and an empty table gives an empty one. What each stage does
with null and empty texts and null ids stands in its docstring.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statmart.llm import bpe, decontaminate, near_dup, suffix_dedup, toxicity
from statmart.llm.shared import discard, free_name, stored, table


def aside(docs: DataFrame, *names: str) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with the columns that bear one of ``names`` under another, and the way back."""
    other = {c: free_name(docs, f"own_{c}") for c in docs.columns if c.lower() in names}
    return docs.withColumnsRenamed(other), {v: k for k, v in other.items()}


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the tagger does not call toxic; null and empty texts have no words and stay."""
    model = toxicity.learned(docs, table(spark, sf_dir, "labels"))
    rows, back = aside(docs, "score", "predicted", "spans")
    return toxicity.scored(rows, model).filter("predicted = 0").select(*rows.columns).withColumnsRenamed(back)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the least id.

    Texts without words and rows with a null id are copies of nothing and stay. Rows that share an
    id are one document: they stay or go together.
    """
    rows, back = aside(docs, "n_shingles", "component_id", "kept")
    return near_dup.near_duplicates(rows).filter("kept").select(*rows.columns).withColumnsRenamed(back)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document has; a text that was nothing else goes.

    Null and empty texts stay as they are; a row with a null id comes after all others. ``n_chars``
    follows the text.
    """
    rows, back = aside(docs, "n_bytes", "n_removed", "spans", "kept")
    missing = free_name(rows, "own_missing")
    out = suffix_dedup.repeats_removed(rows.withColumn(missing, F.col("text").isNull()), whole_characters=True, keep_text=False)
    out = out.withColumn("text", F.when(~F.col(missing), F.col("kept").cast("string")))
    out = out.filter("n_bytes = 0 OR octet_length(kept) > 0").withColumn("n_chars", F.length(F.coalesce("text", F.lit(""))).cast("long"))
    return out.select(*rows.columns).withColumnsRenamed(back)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark; null and empty texts stay. Rows that share an id go together."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian unsigned 32-bit integers) of every document's whole text; a null or empty text has none.

    Here a column of ``docs`` that bears an output's name (``n_tokens``, ``ids``, ...) gives way to it.
    """
    return bpe.encoded(docs, public_tokenizers.path("word_bpe_49k.json"), ids="ids").drop("text")


STAGES = [
    ("toxicity", drop_toxic),
    ("near-dedup", one_of_each),
    ("suffix-dedup", without_repeats),
    ("decontamination", without_benchmark),
    ("bpe", encode),
]
#: No SQL: the stages train a model and encode with a vocabulary.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
        if before is not None:
            discard(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
