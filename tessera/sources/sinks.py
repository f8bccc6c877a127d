"""Writing tables: overwrite with a new schema, replace in one step, comments, JSON lines."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.schemas import Channel
from tessera.sources.tables import TableNames, conform


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def comment_on_table(spark: SparkSession, table: str, comment: str) -> None:
    spark.sql(f"COMMENT ON TABLE {table} IS {_text(comment)}")


def overwrite_table(df: DataFrame, table: str, comment: str | None = None) -> None:
    """The table's rows and schema are replaced by the frame's."""
    df.write.mode("overwrite").option("overwriteSchema", "true").saveAsTable(table)
    if comment is not None:
        comment_on_table(df.sparkSession, table, comment)


def load_channel(df: DataFrame, channel: Channel, names: TableNames) -> int:
    """Overwrite one channel table with typed rows that have no nulls; its row count."""
    table = names.qualified(channel.table)
    overwrite_table(conform(df, channel, enforce_required=True), table, channel.comment)
    return df.sparkSession.table(table).count()


def for_lookup(profiles: DataFrame) -> DataFrame:
    """Profiles with the lower-case e-mail stored, so that a lookup's filter is pushed down."""
    return profiles.withColumn("email_lc", F.lower("email"))


def replace_table_as(
    df: DataFrame,
    names: TableNames,
    table: str,
    comment: str = "",
    buckets: int | None = None,
) -> None:
    """Make ``table`` the frame's rows in one step, without a transactional format.

    The rows go to a new table; only when that is complete does a view of the given name
    start to point at it. Readers see the old rows or the new ones, and a failed job changes
    nothing. The version before last is dropped; the last stays for queries under way. If a
    table, or a view made otherwise, already has the name, nothing is written and an error
    says so; `adopt_table` takes a table over. Of two replacements at once the later publication counts; the other's version
    stays in the catalog, since nobody can know whether it is still read.

    With a column ``email_lc`` its Bloom filters are written, which let a lookup skip most
    files' data at no extra shuffle; ``buckets`` shuffles once more and lets it open one file.
    """
    spark = df.sparkSession
    view = names.qualified(table)
    previous, kept = _own_versions(spark, view)
    version = f"{table}_v{uuid.uuid4().hex[:12]}"
    if buckets and "email_lc" in df.columns:
        writer = df.repartition(buckets, "email_lc").write
        writer = writer.bucketBy(buckets, "email_lc").sortBy("email_lc")
    else:
        writer = df.write
    if "email_lc" in df.columns:
        writer = writer.option("parquet.bloom.filter.enabled#email_lc", "true")
    writer.format("parquet").saveAsTable(names.qualified(version))
    _point(spark, names, table, version, previous, comment)
    if kept is not None:
        spark.sql(f"DROP TABLE IF EXISTS {names.qualified(kept)}")


def adopt_table(spark: SparkSession, names: TableNames, table: str, comment: str = "") -> None:
    """Make a table of its own the first version behind a view of its name, so that
    `replace_table_as` can replace it. No row is copied: the table is renamed, and for the moment
    until the view stands nobody finds the name. If the view cannot be made, the table gets its
    name back. An error if there is no such table, or the name is a view already."""
    view = names.qualified(table)
    if not spark.catalog.tableExists(view):
        raise ValueError(f"there is no table {view}")
    if spark.catalog.getTable(view).tableType == "VIEW":
        raise ValueError(f"{view} is a view already")
    version = f"{table}_v{uuid.uuid4().hex[:12]}"
    spark.sql(f"ALTER TABLE {view} RENAME TO {names.qualified(version)}")
    try:
        _point(spark, names, table, version, None, comment)
    except Exception:
        spark.sql(f"ALTER TABLE {names.qualified(version)} RENAME TO {view}")
        raise


def _point(
    spark: SparkSession, names: TableNames, table: str, version: str, previous: str | None,
    comment: str,
) -> None:
    """The view of the name shows a version from now on, and records it and the one before."""
    note = f"COMMENT {_text(comment)} " if comment else ""
    chain = f"'version' = '{version}', 'previous' = '{previous or ''}'"
    spark.sql(
        f"CREATE OR REPLACE VIEW {names.qualified(table)} {note}TBLPROPERTIES ({chain}) AS "
        f"SELECT * FROM {names.qualified(version)}"
    )


def _own_versions(spark: SparkSession, view: str) -> tuple[str | None, str | None]:
    """The version the view points at and the one before it, as the view itself records them.
    Nothing else is ever dropped: not tables that are named alike, and not versions that
    another replacement has written and not yet published.
    """
    if not spark.catalog.tableExists(view):
        return None, None
    if spark.catalog.getTable(view).tableType != "VIEW":
        raise ValueError(f"{view} is a table of its own; only a view of versions is replaced")
    properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {view}").collect()}
    if "version" not in properties:
        raise ValueError(f"{view} is a view that does not point at a version")
    return properties["version"], properties.get("previous") or None


def write_json_lines(rows: DataFrame, path: str) -> None:
    """The ``json`` column, one text per line."""
    rows.select("json").write.mode("overwrite").text(path)
