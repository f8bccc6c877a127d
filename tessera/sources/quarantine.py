"""Loading rows that may break the declared schema: the good ones typed, the others kept aside
with their reasons, and what the rules count observed on the way.

A row is read once. Every column is cast by trying; what cannot be read, what is missing and what
is null gives a reason. One job writes both kinds, told apart by a folder, so nothing is computed
twice and nothing is lost: good and rejected rows together are the rows given. The counts of the
quality rules are collected by the same job, as metrics of the good rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tessera.schemas import Channel

REJECTED = "is_rejected"
REASONS = "reject_reasons"
GIVEN = "given"


@dataclass(frozen=True)
class Load:
    """What a load gave: typed rows, rejected rows (``given``, the columns as text, and
    ``reject_reasons``), how many of each, and each rule's number of violations."""

    good: DataFrame
    rejected: DataFrame
    good_rows: int
    rejected_rows: int
    violations: Mapping[str, int]


def _column(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def judged(df: DataFrame, channel: Channel) -> DataFrame:
    """The channel's columns typed, null where that fails; ``reject_reasons``, empty for a good row,
    in the order of the columns; and ``given``, the columns as text."""
    missing = [f.name for f in channel.schema if f.name not in df.columns]
    if missing:
        raise ValueError(f"{channel.table} lacks columns {missing}")
    typed, reasons, given = [], [], []
    for field in channel.schema:
        value = _column(field.name)
        cast = value.try_cast(field.dataType)
        unreadable = F.lit(f"{field.name}: cannot be read as {field.dataType.simpleString()}")
        reasons.append(
            F.when(value.isNull(), F.lit(f"{field.name}: is null")).when(cast.isNull(), unreadable)
        )
        typed.append(cast.alias(field.name))
        given.append(value.try_cast("string").alias(field.name))
    return df.select(
        *typed, F.array_compact(F.array(*reasons)).alias(REASONS), F.struct(*given).alias(GIVEN)
    )


def quarantine(
    df: DataFrame, channel: Channel, folder: str, rules: Mapping[str, str] | None = None
) -> Load:
    """Writes the rows to a new folder below ``folder`` in one job, good and rejected apart.

    ``rules`` (name -> SQL condition that a row breaking it meets, as in `quality.rule_report`) are
    counted over the good rows by the tasks that write them. A rule is not a reason to reject.
    """
    rules = dict(rules or {})
    rows = judged(df, channel).withColumn(REJECTED, F.size(REASONS) > 0)
    good = ~F.col(REJECTED)
    observed = Observation()
    counts = [
        F.coalesce(F.count_if(good & F.expr(f"({broken})")), F.lit(0)).alias(f"rule_{i}")
        for i, broken in enumerate(rules.values())
    ]
    # A rejected row keeps its texts alone, a good one its typed columns alone.
    columns = [F.when(good, F.col(f.name)).alias(f.name) for f in channel.schema]
    watched = rows.observe(
        observed, F.count_if(good).alias("good"), F.count_if(~good).alias("rejected"), *counts
    )
    path = f"{folder.rstrip('/')}/{channel.table}-{uuid.uuid4().hex[:12]}"
    watched.select(
        *columns, F.when(~good, F.col(REASONS)).alias(REASONS),
        F.when(~good, F.col(GIVEN)).alias(GIVEN), REJECTED,
    ).write.partitionBy(REJECTED).parquet(path)
    found = observed.get
    schema = watched.select(*columns, REASONS, GIVEN, REJECTED).schema
    written = df.sparkSession.read.schema(schema).parquet(path)
    return Load(
        good=written.filter(good).select(*(f.name for f in channel.schema)),
        rejected=written.filter(F.col(REJECTED)).select(REASONS, GIVEN),
        good_rows=found["good"],
        rejected_rows=found["rejected"],
        violations={name: found[f"rule_{i}"] for i, name in enumerate(rules)},
    )


def reject_reasons(df: DataFrame, channel: Channel) -> DataFrame:
    """(channel, reason, rows) of what a load would reject, without writing."""
    return reject_summary(judged(df, channel)).select(
        F.lit(channel.key).alias("channel"), "reason", "rows"
    )


def reject_summary(rejected: DataFrame) -> DataFrame:
    """(reason, rows): how many rejected rows have each reason."""
    return rejected.select(F.explode(REASONS).alias("reason")).groupBy("reason").agg(
        F.count(F.lit(1)).alias("rows")
    )
