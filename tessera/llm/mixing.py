"""Mixing sources to target weights by systematic sampling. DataFrame functions only.

Each source has a target in words. Every document of a source is expected ``target / source
size`` times; the running sum of these expectations over the source's documents, shifted by one
random offset, crosses an integer boundary once for every copy the mix takes. So a source gets
its expected number of copies to within one, no document more copies than its expectation
rounded up, and with documents ordered by size the words taken follow the target closely.

The running sum must not need a whole source in one task. Documents are put in cells, by size
to four leading bits and by a hash of id and text. A class of sizes has ``buckets`` cells and one
more for every ``cell_rows`` documents of its source, so that a cell has about ``cell_rows`` at most
even where all documents are equally long or have no id. The sources with more cells are fewer
than a ``cell_rows``-th of the documents. Cells are counted with map-side combining and written
once; their counts are summed by class, the classes by source, and documents are numbered within
their cell. Only the few rows of sources are ordered in one task.

Rows with a null text, or without words, have size 0; they take part like others and add no
words. Null is a source of its own, the last. Repeated rows are documents each for itself; rows
that agree in source, id and text share a cell and are interchangeable: which of them is taken
more often is not defined, how many copies they get together is. Very long texts are one row of a
large size, taken as often as their source's rate says. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
BUCKETS = 32  # parts of the documents of one size class, so that a hot class is split
CELL_ROWS = 1_000_000  # a source has one part more for so many documents
SIZE_BITS = 4  # leading bits of the size that make its class


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _md5_number(text: Column, digits: int = 8) -> Column:
    """The first hexadecimal digits of the MD5 as a number, the same in every engine."""
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("long")


def size_class(size: Column) -> Column:
    """The size cut to its ``SIZE_BITS`` leading binary digits."""
    shift = F.greatest(F.lit(0), F.length(F.bin(size)) - SIZE_BITS)
    return F.call_function("shiftright", size, shift.cast("int")) + shift * (1 << (SIZE_BITS + 1))


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.0, most: float = 3.0
) -> DataFrame:
    """(source_key, source_size, weight, target): one row per source.

    ``sizes`` has a row per source: (source_key, source_size), sorted keys give the weights in
    turn. ``share`` of all sizes is dealt by weight; a target stops at ``most`` times its
    source's size and the rest is dealt again among the others. Sources fill up in the order
    of their room per weight, so running sums in that order say where it ends.
    """
    everything = Window.partitionBy()  # a row per source, not per document
    by_key = Window.orderBy("source_key")
    position = F.row_number().over(by_key) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), F.pmod(position, len(weights)) + 1)
    capped = sizes.select(
        "source_key", "source_size", weight.cast("double").alias("weight")
    ).select(
        "*",
        (F.col("source_size") * F.lit(float(most))).alias("cap"),
        (F.sum("source_size").over(everything) * F.lit(float(share))).alias("total"),
        F.sum("weight").over(everything).alias("all_weights"),
    )
    before = Window.orderBy(F.col("cap") / F.col("weight"), "source_key").rowsBetween(
        Window.unboundedPreceding, -1
    )
    filled = capped.select(
        "*",
        F.coalesce(F.sum("cap").over(before), F.lit(0.0)).alias("caps_before"),
        F.coalesce(F.sum("weight").over(before), F.lit(0.0)).alias("weights_before"),
    )
    # What each unit of weight gets once the sources before are full; never above the level
    # that deals out everything, and equal to it at the right place, so that is the largest.
    level = (F.col("total") - F.col("caps_before")) / (
        F.col("all_weights") - F.col("weights_before")
    )
    return filled.withColumn("level", F.max(level).over(everything)).select(
        "source_key", "source_size", "weight",
        F.least(F.col("cap"), F.col("level") * F.col("weight")).alias("target"),
    )


def _source_key(source: Column) -> Column:
    """Sorts by code point, null last; never null itself."""
    return F.when(source.isNull(), "t").otherwise(F.concat(F.lit("s"), source))


def in_cells(
    df: DataFrame, seed: str, buckets: int, cell_rows: int,
    id_col: str, text_col: str, source_col: str, carry: tuple[str, ...] = (),
) -> DataFrame:
    """Every row with its size and its cell; column i of ``carry`` is called ``carried_<i>``."""
    source, text = F.col(source_col).cast("string"), F.col(text_col).cast("string")
    name = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    draw = _md5_number(
        F.concat(F.lit(f"{seed}:"), name, F.lit(":"), F.md5(F.coalesce(text, F.lit("")))), 15
    )
    rows = df.select(
        F.col(id_col).alias("doc_id"), source.alias("source"), word_count(text).alias("size"),
        _source_key(source).alias("source_key"), draw.alias("draw"),
        *(F.col(c).alias(f"carried_{i}") for i, c in enumerate(carry)),
    )
    # Reads the sources alone; written, so that its size is known to be small.
    large = stored(
        df.groupBy(_source_key(source).alias("source_key"))
        .agg(F.floor(F.count(F.lit(1)) / cell_rows).cast("long").alias("more"))
        .filter("more > 0")
    )
    parts = F.lit(buckets) + F.coalesce("more", F.lit(0))
    return rows.join(large, "source_key", "left").select(
        *rows.columns, size_class(F.col("size")).cast("int").alias("class"),
        F.pmod("draw", parts).alias("bucket"),
    )


def _counted(
    df: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = 1.0,
    most: float = 3.0,
    seed: str = "mix",
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    buckets: int = BUCKETS,
    cell_rows: int = CELL_ROWS,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Every row with its copies; column i of ``carry`` is called ``carried_<i>``."""
    keyed = in_cells(df, seed, buckets, cell_rows, id_col, text_col, source_col, carry)
    cell = ["source_key", "class", "bucket"]
    cells = stored(keyed.groupBy(*cell).agg(
        F.count(F.lit(1)).alias("cell_rows"), F.sum("size").alias("cell_size")
    ))
    classes = cells.groupBy("source_key", "class").agg(
        F.sum("cell_rows").alias("class_rows"), F.sum("cell_size").alias("class_size")
    )

    def sum_before(rows: str, window) -> Column:
        preceding = window.rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(rows).over(preceding), F.lit(0))

    of_class = Window.partitionBy("source_key", "class").orderBy("bucket")
    of_source = Window.partitionBy("source_key").orderBy("class")
    placed = cells.select(*cell, sum_before("cell_rows", of_class).alias("cells_before")).join(
        classes.select("source_key", "class", sum_before("class_rows", of_source).alias("before")),
        ["source_key", "class"],
    ).select(*cell, (F.col("cells_before") + F.col("before")).alias("rows_before"))
    sizes = classes.groupBy("source_key").agg(F.sum("class_size").alias("source_size"))
    targets = source_targets(sizes, weights, share, most)
    offset = _md5_number(F.concat(F.lit(seed + "|"), "source_key")) / F.lit(float(1 << 32))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rated = placed.join(
        targets.select("source_key", "source_size", "target", rate.alias("rate"),
                       offset.alias("offset")),
        "source_key",
    )
    within = Window.partitionBy(*cell).orderBy("size", "doc_id", "draw")
    numbered = keyed.withColumn("number", F.row_number().over(within)).join(rated, cell)
    last = F.col("rows_before") + F.col("number")
    copies = F.floor(last * F.col("rate") + F.col("offset")) - F.floor(
        (last - 1) * F.col("rate") + F.col("offset")
    )
    return numbered.withColumn("copies", copies.cast("long"))


def mix_sources(df: DataFrame, **options) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken) for every row: ``copies`` is
    how often the mix has the document, ``taken`` the words it takes of it. Options are those
    of `source_targets`, ``seed``, ``buckets``, ``cell_rows`` and the names of columns; ``most`` must be whole for the
    bound on copies to hold exactly."""
    return _counted(df, **options).select(
        "doc_id", "source", "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def mixed(df: DataFrame, **options) -> DataFrame:
    """The mix itself: the rows of ``df``, each as often as it is taken, and ``copy``, the
    number of the copy from 1 on."""
    columns = tuple(c for c in df.columns if c != "copy")
    counted = _counted(df, carry=columns, **options).filter("copies > 0")
    return counted.select(
        *(F.col(f"carried_{i}").alias(c) for i, c in enumerate(columns)),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"),
    )
