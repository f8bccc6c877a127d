"""A corpus pipeline of five stages over the table ``documents``.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps, with the columns of
``documents``; the last returns the mix. What each decides takes effect on what the next reads:

1. ``language_id``: documents without a letter (and null texts) go, no others; a missing
   ``lang`` is filled with the prediction, which is ``und`` where no row has a label.
2. ``minhash_dedup``: of each group of near duplicates one row stays, that with the smallest id.
3. ``suffix_dedup``: bytes of passages of 100 bytes that also start earlier are removed from
   the texts; documents of which nothing is left go.
4. ``decontamination``: documents that hold a passage of the benchmark go.
5. ``mix_sources``: every document as often as its source's target asks for, with the number
   of the copy.

Rows count, not ids: stage 2 keeps exactly one row of a group, also where rows repeat an id, have
none, or are equal. Empty tables pass through.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontamination, language_id, minhash_dedup, mixing, suffix_dedup
from tessera.llm.common import read_table, shared_folder, workers_find_package

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    workers_find_package(spark)
    learn = ~language_id.held_out(F.col("doc_id"), 4, 2)
    judged = language_id.identify_languages(
        docs, learn, carry=COLUMNS[1:], letter_col="has_letter"
    )
    return judged.filter("has_letter").withColumn(
        "lang", F.coalesce("lang", "lang_pred")
    ).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    workers_find_package(spark)
    return minhash_dedup.one_of_each_group(docs.select(*COLUMNS))


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    workers_find_package(spark)
    cleaned = suffix_dedup.remove_repeats(docs, as_text=True, carry=("lang", "source"))
    return cleaned.filter("kept != '' or n_bytes = 0").select(
        "doc_id", F.col("kept").alias("text"), "lang", "source",
        F.length("kept").cast("long").alias("n_chars"),
    )


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    workers_find_package(spark)
    judged = decontamination.find_contamination(
        docs, read_table(spark, sf_dir, "benchmark"), carry=COLUMNS[1:]
    )
    return judged.filter("n_hit = 0").select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs.select(*COLUMNS))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_languages),
    ("minhash_dedup", drop_near_duplicates),
    ("suffix_dedup", remove_repeated_passages),
    ("decontamination", drop_contaminated),
    ("mix_sources", mix_sources),
]
ORACLE_SQL = None  # SQL cannot express the network; tests hold the stages to brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of ``documents``; every stage but the last is written to the shared folder."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = f"{shared_folder(spark)}/pipeline-{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
