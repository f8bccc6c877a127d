"""Search through an inverted index of trigrams, so that a query need not read every profile.

Every profile gets a number, a 31-bit hash of its e-mail, and a bucket, another hash of it. The
index has a row for each gram and bucket: the numbers of the bucket's profiles whose lower-case
e-mail or full name holds the gram, in order and stored as differences, which stay small where a
gram is frequent. A text shorter than a gram is a gram of its own.

Whatever holds a searched text holds all its grams. So a search reads the lists of these grams
alone, keeps the numbers that are in all of them, reads the buckets these lie in and applies the
search proper to the profiles found: equal numbers or grams of two fields cost time, never rows.
Of a searched text of one or two letters, every gram that contains it is read. A pattern is cut at
its wildcards; one without anything else searches all profiles.

`write_search` stores both tables: profiles in folders by bucket, the index in folders by a hash of
the gram, so that the grams' folders are picked when the query is planned and the profiles' folders
while it runs. A list is bounded by its bucket's profiles; choose ``buckets`` with their number.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions import display
from tessera.operators.serve import DEFAULT_LIMIT, check_limit, customers_search, lowered_email

GRAM = 3
BUCKETS = 64
GRAM_BUCKETS = 64
NUMBER_BITS = 31


def numbered(profiles: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Adds ``search_bucket`` and ``search_no``, which follow from the e-mail."""
    if buckets < 1:
        raise ValueError("buckets must be 1 or more")
    return profiles.withColumns({
        "search_bucket": F.pmod(F.xxhash64(F.lit("bucket"), "email"), F.lit(buckets)).cast("int"),
        "search_no": F.pmod(F.xxhash64("email"), F.lit(1 << NUMBER_BITS)).cast("int"),
    })


def _grams(text: Column) -> Column:
    """The distinct grams of a text; none of null, the text itself if it is short."""
    starts = F.sequence(F.lit(1), F.greatest(F.length(text) - GRAM + 1, F.lit(1)))
    return F.array_distinct(F.transform(starts, lambda at: text.substr(at, F.lit(GRAM))))


def _gram_bucket(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(GRAM_BUCKETS)).cast("int")


def search_postings(profiles: DataFrame) -> DataFrame:
    """(gram_bucket, gram, search_bucket, steps) of `numbered` profiles: the sorted numbers of the
    profiles that hold the gram, each as the difference from the one before."""
    none = F.array().cast("array<string>")
    fields = (lowered_email(profiles), F.lower(display.full_name()))
    grams = F.array_union(*(F.coalesce(_grams(text), none) for text in fields))
    rows = profiles.select("search_bucket", "search_no", F.explode(grams).alias("gram"))
    lists = rows.groupBy("gram", "search_bucket").agg(
        F.sort_array(F.collect_set("search_no")).alias("numbers")
    )
    steps = F.transform("numbers", lambda number, at: number - F.when(at == 0, 0).otherwise(
        F.get("numbers", at - 1)))
    return lists.select(_gram_bucket(F.col("gram")).alias("gram_bucket"), "gram", "search_bucket",
                        steps.alias("steps"))


def literal_runs(q: str, wildcard: bool) -> list[str]:
    """The lower-case texts that whatever is found must hold: ``q``, or what lies between its
    wildcards. Cut out are letters whose lower case depends on the neighbours or is several."""
    runs, escaped = [""], False
    for letter in q:
        if wildcard and not escaped and letter in "%_":
            runs.append("")
        elif wildcard and not escaped and letter == "\\":
            escaped = True
        else:
            escaped, low = False, letter.lower()
            if len(low) > 1 or low in "\u03c2\u03c3":  # sigma has a form at the end of words
                runs.append("")
            else:
                runs[-1] += low
    return [run for run in runs if run]


def _lists(postings: DataFrame, runs: list[str]) -> tuple[DataFrame, int]:
    """The lists to read, each with the name of what it stands for, and how many names there are."""
    grams = sorted({run[at : at + GRAM] for run in runs for at in range(len(run) - GRAM + 1)})
    if grams:
        buckets = [_gram_bucket(F.lit(gram)) for gram in grams]  # folded to numbers
        wanted = F.col("gram_bucket").isin(buckets) & F.col("gram").isin(grams)
        return postings.filter(wanted).withColumn("name", F.col("gram")), len(grams)
    longest = max(runs, key=len)  # one or two letters, which lie inside a gram
    return (
        postings.filter(F.col("gram").contains(longest)).withColumn("name", F.lit(longest)), 1
    )


def search_candidates(postings: DataFrame, runs: list[str]) -> DataFrame:
    """(search_bucket, search_no) of the profiles that are in the lists of all grams."""
    lists, names = _lists(postings, runs)
    # A running sum of the differences, list by list.
    place = Window.partitionBy("gram", "search_bucket").orderBy("at")
    rows = lists.select("name", "gram", "search_bucket", F.posexplode("steps").alias("at", "step"))
    rows = rows.withColumn("search_no", F.sum("step").over(place).cast("int"))
    return (
        rows.groupBy("search_bucket", "search_no")
        .agg(F.count_distinct("name").alias("held"))
        .filter(F.col("held") == names)
        .select("search_bucket", "search_no")
    )


def indexed_search(
    profiles: DataFrame,
    postings: DataFrame,
    q: str,
    limit: int = DEFAULT_LIMIT,
    wildcard: bool = False,
) -> DataFrame:
    """The rows of `serve.customers_search` over the same `numbered` profiles."""
    check_limit(limit)
    runs = literal_runs(q, wildcard)
    if runs:
        key = ["search_bucket", "search_no"]
        profiles = profiles.join(search_candidates(postings, runs), key, "left_semi")
    return customers_search(profiles, q, limit, wildcard)


def write_search(profiles: DataFrame, folder: str, buckets: int = BUCKETS) -> str:
    """Stores the profiles and their index in a new folder below ``folder``; returns its path.

    The index is built from the stored profiles. Readers of an older folder are not disturbed.
    """
    path = f"{folder.rstrip('/')}/search-{uuid.uuid4().hex[:12]}"
    spark = profiles.sparkSession
    numbered(profiles, buckets).repartition("search_bucket").sortWithinPartitions(
        "search_bucket", "search_no"
    ).write.partitionBy("search_bucket").parquet(f"{path}/profiles")
    stored, _ = read_search(spark, path, with_index=False)
    search_postings(stored).repartition("gram_bucket").sortWithinPartitions(
        "gram_bucket", "gram", "search_bucket"
    ).write.partitionBy("gram_bucket").parquet(f"{path}/postings")
    return path


def read_search(
    spark: SparkSession, path: str, with_index: bool = True
) -> tuple[DataFrame, DataFrame | None]:
    """(profiles, postings) for `indexed_search`."""
    profiles = spark.read.parquet(f"{path}/profiles")
    return profiles, spark.read.parquet(f"{path}/postings") if with_index else None
