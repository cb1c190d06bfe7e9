"""The corpus pipeline: toxicity, line dedup, near-dedup, decontamination and tokens, over `documents`."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.llm._common import cut, release, table
from eventlake.llm.bpe import decoded, encoded
from eventlake.llm.decontaminate import decontaminated
from eventlake.llm.line_dedup import without_duplicate_lines
from eventlake.llm.near_dedup import near_duplicates
from eventlake.llm.toxicity import without_toxic

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the classifier, fitted on this table's labels, scores at 0.5 or more.

    Null and empty texts score what the labels' share gives and stay where that is below 0.5; rows that
    repeat are scored alike; without labels nothing goes.
    """
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops lines that an earlier line matches, and documents of which no word is left.

    Null, empty and wordless texts stay as they are; of equal lines the first by doc_id stays, a null
    doc_id comes last; rows that repeat id and text keep the same lines.
    """
    return without_duplicate_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group of near copies the document of the smallest id.

    Rows that repeat an id are one document; rows with a null id are kept.
    """
    found = near_duplicates(docs).where("kept and doc_id is not null").select("doc_id").distinct()
    known = docs.where("doc_id is not null").join(found, "doc_id", "left_semi")
    return known.unionByName(docs.where("doc_id is null")).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the benchmark contaminates: at least a twentieth of their words hit.

    Null and empty texts, and an empty benchmark, hit nothing; rows that repeat are judged alike.
    """
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds the ids of each text (little-endian 32-bit), their number and whether they decode to it.

    A null text is encoded as the empty one and stays null.
    """
    out = decoded(encoded(docs, RANKS), RANKS)
    same = F.col("decoded") == F.encode(F.coalesce(F.col("row.text"), F.lit("")), "UTF-8")
    return out.select("row.*", "n_tokens", F.col("ids").alias("token_ids"), same.alias("round_trip"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to `documents`; each but the last is written in the shared folder and read again.

    A stage's table goes as soon as the next one is written; the last is read by the result.
    """
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
        release(*before)
        before = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)


#: SQL can express neither the fitted classifier nor the tokens; the tests hold both against brute force.
ORACLE_SQL: str | None = None
