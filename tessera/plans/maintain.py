"""The profile kept up to date by key: a batch of changed rows rewrites only what it touches.

Below one folder lie the channels' rows, the nested profile and partial statistics, each in folders
by a hash of the e-mail. A batch names new and changed rows, and rows to delete. The buckets it
touches are those of the rows' e-mails now and before; the channel rows of these buckets are read,
changed and written again, and their profiles and statistics are built from them by the same code
that builds everything. Other buckets' files are neither read nor written.

A batch can be applied again after a failure: its result is the same. Each table is replaced
bucket by bucket, so a reader of the folder during a batch can see some buckets before and some
after it; readers that must not read a published copy (`publish`), which changes in one step.

A row is known by its id within its channel. Hot e-mails make hot buckets; a bucket costs what its
rows cost in the full build.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.serve import portfolio_partials
from tessera.plans.profile import profile_nested
from tessera.schemas import BY_KEY, CHANNELS, Channel
from tessera.sources.sinks import for_lookup, replace_table_as
from tessera.sources.tables import Channels, TableNames, conform, described

BUCKET = "email_bucket"
BUCKETS = 256
UPSERT, DELETE = "upsert", "delete"


def bucket_of(email: str | Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(email), F.lit(buckets)).cast("int")


class MaintainedProfile:
    """The tables below ``folder``. ``buckets`` must be the same for all of their life."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int = BUCKETS):
        if buckets < 1:
            raise ValueError("buckets must be 1 or more")
        self.spark, self.folder, self.buckets = spark, folder.rstrip("/"), buckets

    def _path(self, table: str) -> str:
        return f"{self.folder}/{table}"

    def _write(self, df: DataFrame, table: str, among: list[int] | None = None) -> None:
        """Replaces the buckets ``among``, or everything; those that end up empty go."""
        writer = df.repartition(BUCKET).sortWithinPartitions(BUCKET).write.partitionBy(BUCKET)
        if among is None:
            writer.mode("overwrite").option("partitionOverwriteMode", "static").parquet(
                self._path(table))
            return
        # Dynamic overwriting leaves a bucket that gets no row as it was: its files are the same.
        before = {bucket: self._files(table, bucket) for bucket in among}
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(
            self._path(table))
        for bucket, files in before.items():
            if files and self._files(table, bucket) == files:
                path, system = self._hadoop(table, bucket)
                system.delete(path, True)

    def _hadoop(self, table: str, bucket: int):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self._path(table)}/{BUCKET}={bucket}")
        return path, path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def _files(self, table: str, bucket: int) -> set[str]:
        path, system = self._hadoop(table, bucket)
        return {f.getPath().getName() for f in system.listStatus(path)} if system.exists(path) \
            else set()

    def _bucketed(self, df: DataFrame) -> DataFrame:
        return df.withColumn(BUCKET, bucket_of("email", self.buckets))

    def _rows(self, channel: Channel) -> DataFrame:
        schema = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in channel.schema)}, "
        return self.spark.read.schema(schema + f"{BUCKET} int").parquet(self._path(channel.table))

    def channels(self, among: list[int] | None = None) -> Channels:
        """The channels' rows, of all buckets or of some."""
        found = {}
        for channel in CHANNELS:
            rows = self._rows(channel)
            if among is not None:
                rows = rows.filter(F.col(BUCKET).isin(among))
            found[channel.key] = conform(rows, channel)
        return found

    def profiles(self) -> DataFrame:
        return self.spark.read.parquet(self._path("profile")).drop(BUCKET)

    def partials(self) -> DataFrame:
        """Partial statistics, a row per bucket; see `serve.portfolio_of`."""
        return self.spark.read.parquet(self._path("statistics"))

    def build(self, channels: Channels, as_of: datetime | str | None = None) -> None:
        """Everything anew."""
        for channel in CHANNELS:
            rows = channels.get(channel.key)
            if rows is None:
                rows = self.spark.createDataFrame([], channel.schema)
            self._write(self._bucketed(conform(rows, channel)), channel.table)
        self._rebuild(None, as_of)

    def _rebuild(self, among: list[int] | None, as_of: datetime | str | None) -> None:
        profiles = self._bucketed(profile_nested(self.channels(among), as_of))
        self._write(profiles, "profile", among)
        written = self.spark.read.schema(profiles.schema).parquet(self._path("profile"))
        if among is not None:
            written = written.filter(F.col(BUCKET).isin(among))
        self._write(portfolio_partials(written, BUCKET), "statistics", among)

    def apply(
        self, changes: Mapping[str, DataFrame], as_of: datetime | str | None = None
    ) -> list[int]:
        """Applies a batch; returns the buckets that were rewritten.

        ``changes``: by channel, rows with the channel's columns and ``change``, 'upsert' or
        'delete'. Of a row whose e-mail changes, ``previous_email`` is the one before; rows to
        delete need their id and e-mail only. An id occurs once in a batch. At most ``buckets``
        numbers come to the driver.
        """
        batch = {}
        for channel, df in described(changes):
            if "previous_email" not in df.columns:
                df = df.withColumn("previous_email", F.col("email"))
            previous = F.coalesce("previous_email", "email")
            batch[channel.key] = df.withColumns({
                BUCKET: bucket_of("email", self.buckets),
                "previous_bucket": bucket_of(previous, self.buckets),
            })
        touched = {
            key: sorted(r["b"] for r in df.select(
                F.explode(F.array(BUCKET, "previous_bucket")).alias("b")).distinct().collect())
            for key, df in batch.items()
        }
        for key, df in batch.items():
            channel = BY_KEY[key]
            if touched[key]:
                self._write(self._changed(channel, df, touched[key]), channel.table, touched[key])
        among = sorted(set().union(*touched.values()))
        if among:
            self._rebuild(among, as_of)
        return among

    def _changed(self, channel: Channel, changes: DataFrame, among: list[int]) -> DataFrame:
        ids = changes.select(F.col(channel.id_field).alias("changed_id"))
        old = self._rows(channel).filter(F.col(BUCKET).isin(among))
        kept = old.join(ids, F.col(channel.id_field) == F.col("changed_id"), "left_anti")
        fresh = changes.filter(F.col("change") == UPSERT)
        return reduce(DataFrame.unionByName, [
            kept, self._bucketed(conform(fresh, channel)).select(*kept.columns)
        ])

    def publish(self, names: TableNames, comment: str = "") -> None:
        """Makes the profiles the public table in one step."""
        replace_table_as(for_lookup(self.profiles()), names, names.profile_table, comment)
