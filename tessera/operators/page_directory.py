"""Event histories stored so that one page is read from one file.

Below a folder lie the events of one channel in range partitions by e-mail and event, a file each
in ``part=n``, and a directory: for every e-mail the parts that hold its events, and in each the
number of its first page. A hot history lies in many parts, no task ever holds it whole, and pages
never cross a part. Equal events are one row with their number, however many they are.

The events are shuffled twice, by content to count the copies and by range; building the directory
reads e-mails and counts alone. The directory has one row per e-mail and part it lies in, in folders
by a hash of the e-mail, so that finding a page opens one folder of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.operators.events import check_page, counted_events
from tessera.schemas import Channel

BUCKETS = 256
EVENTS, DIRECTORY = "events", "directory"


def _bucket(email, buckets: int):
    return F.pmod(F.xxhash64(email), F.lit(buckets)).cast("int")


def ranged_events(df: DataFrame, channel: Channel, partitions: int | None = None) -> DataFrame:
    """(email, event, copies, part), in order within each part. Parts follow each other as the
    e-mails and events do."""
    keys = ("email", "event")
    counted = counted_events(df, channel)
    ranged = counted.repartitionByRange(partitions, *keys) if partitions else (
        counted.repartitionByRange(*keys)
    )
    return ranged.withColumn("part", F.spark_partition_id()).sortWithinPartitions("part", *keys)


def directory_of(ranged: DataFrame, page_events: int) -> DataFrame:
    """(email, part, events, first_page, pages, page_events) of events in parts. Pages are counted
    from 0 over the parts; the last of a part may be short. An e-mail has at most a row per part."""
    check_page(page_events)
    parts = ranged.groupBy("email", "part").agg(F.sum("copies").alias("events"))
    parts = parts.withColumn("pages", F.ceil(F.col("events") / page_events))
    before = (
        Window.partitionBy("email").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    )
    first = F.coalesce(F.sum("pages").over(before), F.lit(0).cast("long"))
    return parts.select(
        "email", "part", "events", first.alias("first_page"), "pages",
        F.lit(page_events).alias("page_events"),
    )


class EventPages:
    """The pages of one channel below ``folder``. ``buckets`` must be the same for all of their
    life; the folder must be one that all executors share."""

    def __init__(
        self, spark: SparkSession, folder: str, channel: Channel, buckets: int = BUCKETS
    ):
        if buckets < 1:
            raise ValueError("buckets must be 1 or more")
        self.spark, self.folder, self.channel = spark, folder.rstrip("/"), channel
        self.buckets = buckets

    def write(self, df: DataFrame, page_events: int, partitions: int | None = None) -> None:
        """Replaces everything by the channel rows' events; rows without an e-mail are left out."""
        check_page(page_events)
        ranged_events(df, self.channel, partitions).write.mode("overwrite").partitionBy(
            "part").parquet(f"{self.folder}/{EVENTS}")
        directory = directory_of(self._events(), page_events)
        directory.withColumn("bucket", _bucket("email", self.buckets)).repartition(
            "bucket").sortWithinPartitions("bucket", "email", "part").write.mode(
            "overwrite").partitionBy("bucket").parquet(f"{self.folder}/{DIRECTORY}")

    def _events(self) -> DataFrame:
        event = self.channel.event_type.simpleString()
        return self.spark.read.schema(
            f"email string, event {event}, copies long, part int"
        ).parquet(f"{self.folder}/{EVENTS}")

    def directory(self) -> DataFrame:
        return self.spark.read.schema(
            "email string, part int, events long, first_page long, pages long, page_events int, "
            "bucket int"
        ).parquet(f"{self.folder}/{DIRECTORY}")

    def page_counts(self) -> DataFrame:
        """(email, events, pages) of every customer with events, from the directory alone."""
        return self.directory().groupBy("email").agg(
            F.sum("events").alias("events"), F.sum("pages").alias("pages")
        )

    def page(self, email: str, number: int) -> DataFrame:
        """The events on one page of one exact e-mail, in order; none if there is no such page.

        One row of the directory comes to the driver; the frame then reads one file, and in it the
        row groups that can hold the e-mail.
        """
        own = self.directory().filter(
            (F.col("bucket") == _bucket(F.lit(email), self.buckets)) & (F.col("email") == email)
        )
        found = own.filter(
            (F.col("first_page") <= number) & (F.col("first_page") + F.col("pages") > number)
        ).head()
        if found is None:
            return self._events().filter("false").select("event.*")
        size, page = found["page_events"], number - found["first_page"]
        rows = self._events().filter((F.col("part") == found["part"]) & (F.col("email") == email))
        before = (
            Window.partitionBy("email").orderBy("event")
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        placed = rows.withColumn("start", F.coalesce(F.sum("copies").over(before), F.lit(0)))
        # Only this page is cut out, so copies that fill very many pages stay a number.
        lo, hi = F.lit(page * size), F.lit((page + 1) * size)
        start = F.greatest("start", lo)
        end = F.least(F.col("start") + F.col("copies"), hi)
        cut = placed.select("event", (end - start).alias("copies")).filter("copies > 0")
        copies = F.array_repeat("event", F.col("copies").cast("int"))
        return cut.select(F.explode(copies).alias("event")).select(
            "event.*"
        ).orderBy(*(f.name for f in self.channel.event_type))
