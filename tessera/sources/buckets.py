"""Channel tables bucketed by e-mail: what is grouped by e-mail needs no shuffle.

All four tables have the same number of buckets, so an aggregation by e-mail runs where the
rows are read, and merging the channels finds them in place. The price is paid once, at load.

A bucket is read by one task. Where one e-mail has very many rows its bucket would be that task's
alone, so a table whose largest bucket exceeds a stated size is read as plain files instead: they
are split as usual, its rows are combined before they are shuffled, and results are the same.
"""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.schemas import CHANNELS, Channel
from tessera.sources.sinks import comment_on_table
from tessera.sources.tables import Channels, TableNames, conform

BUCKETS = 256
SPLITS = 8
LARGEST_BYTES = 1 << 30  # compressed bytes of one bucket that one task may read
_BUCKET_FILE = re.compile(r"_(\d{5,})(?:\.|$)")  # the bucket's number in a data file's name


def load_bucketed(
    df: DataFrame,
    channel: Channel,
    names: TableNames,
    buckets: int = BUCKETS,
    splits: int = SPLITS,
    enforce_required: bool = True,
) -> None:
    """Overwrite one channel table with typed rows in ``buckets`` buckets by e-mail. A bucket is
    written as up to ``splits`` files by as many tasks, rows dealt by id, so that no task writes
    all rows of a frequent e-mail."""
    if buckets < 1 or splits < 1:
        raise ValueError("buckets and splits must be 1 or more")
    rows = conform(df, channel, enforce_required)
    # The bucket is the one that Spark gives a row; each of its splits is a task of its own.
    bucket = F.pmod(F.hash("email"), F.lit(buckets))
    split = F.pmod(F.xxhash64(channel.id_field), F.lit(splits)).cast("int")
    dealt = rows.repartitionById(buckets * splits, bucket * splits + split)
    table = names.qualified(channel.table)
    dealt.write.mode("overwrite").format("parquet").bucketBy(buckets, "email").saveAsTable(table)
    comment_on_table(df.sparkSession, table, channel.comment)


def bucket_bytes(spark: SparkSession, table: str) -> dict[int, int]:
    """The size of each bucket's files, from one listing of the table's folder."""
    location = spark._jvm.org.apache.hadoop.fs.Path(_location(spark, table))
    system = location.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    sizes: Counter[int] = Counter()
    for file in system.listStatus(location):
        found = _BUCKET_FILE.search(file.getPath().getName())
        if found:
            sizes[int(found[1])] += file.getLen()
    return dict(sizes)


def _location(spark: SparkSession, table: str) -> str:
    detail = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'")
    return detail.head()["data_type"]


def channels_from_buckets(
    spark: SparkSession, names: TableNames, largest_bytes: int = LARGEST_BYTES
) -> Channels:
    """The four channels: bucketed where every bucket is at most ``largest_bytes``, plain files
    where one is larger."""
    found = {}
    for channel in CHANNELS:
        table = names.qualified(channel.table)
        if max(bucket_bytes(spark, table).values(), default=0) <= largest_bytes:
            rows = spark.table(table)
        else:
            rows = spark.read.schema(spark.table(table).schema).parquet(_location(spark, table))
        found[channel.key] = conform(rows, channel)
    return found
