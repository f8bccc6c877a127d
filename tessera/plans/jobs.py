"""The batch job: channel tables in the catalog to the profile table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Row, SparkSession

from tessera.operators.serve import load_report
from tessera.plans.profile import profile_nested
from tessera.sources.sinks import for_lookup, replace_table_as
from tessera.sources.tables import TableNames, channels_from_catalog

PROFILE_COMMENT = "One profile per customer, consolidated from all sales channels"


def consolidate(
    spark: SparkSession,
    names: TableNames,
    as_of: datetime | str | None = None,
    buckets: int | None = None,
) -> Row:
    """Rebuild the profile table; returns the customer and multi-channel customer counts.

    The report reads one small column of the written table, so it also holds if tasks of the
    writing job had to be repeated.
    """
    profiles = profile_nested(channels_from_catalog(spark, names), as_of)
    replace_table_as(
        for_lookup(profiles), names, names.profile_table, PROFILE_COMMENT, buckets
    )
    return load_report(spark.table(names.profile)).first()
