"""Interaction audit of document filters: what each removes in every order of application.

Each document has a mask of the filters it fails. In one order it is removed by the filter of
its mask that comes first; the later ones of its mask find it gone. Audited are all orders at
once, by Lehmer rank: the orders that begin with the same filters are an interval of the
lexicographic ranks, of (filters left)! ranks. A mask is removed at a step exactly in the
intervals of those beginnings whose last filter is in the mask and none before it; where one
before it is, the last filter's failure is redundant. So a part's audit adds the masks' document
counts at the ends of intervals, in one difference array per step and measure, and a prefix sum
across the ranks gives every order's totals. The documents are counted once, by part and mask;
nothing is done per document and order.

`audit_orders` does this for any few filters; `document_failures` works out five of texts:

* A: under ``MIN_WORDS`` words (maximal runs of other than ASCII white space);
* B: distinct words under half of the words, case-sensitive;
* C: more than 3 capitals A-Z in 100 code points;
* D: one of ``SYMBOLS``;
* E: the text is that of a row with a smaller id, in any part, removed or not.

A text travels as its SHA-256, and equal rows are combined before each shuffle, so that a text
of very many copies is one row per task. Null texts are empty texts, null languages the part
``""``. A null id is neither smaller nor greater than another, and has no label. Rows that repeat
an id count each for itself; an id has a label if any of its label rows says so. Texts of any
length are read whole, one at a time. An empty table has no part and gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

FILTERS = "ABCDE"
MIN_WORDS = 200
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SYMBOLS = b"#$%&*|"
MOST_FILTERS = 6  # 720 orders

AUDIT = pa.schema([
    ("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32()),
    *((name, pa.int64()) for name in (
        "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley",
    )),
])
AUDIT_DDL = "part string, filter_order string, step int, " + ", ".join(
    f"{name} long" for name in AUDIT.names[3:]
)


def lehmer_rank(beginning: tuple[int, ...], n: int) -> int:
    """The lexicographic rank of the first order that begins so."""
    rank = 0
    for place, item in enumerate(beginning):
        smaller = sum(other < item for other in range(n) if other not in beginning[:place])
        rank += smaller * factorial(n - 1 - place)
    return rank


def intervals(n: int) -> list[tuple[int, int, int, int, int]]:
    """(step, first rank, rank after the last, filter, mask of the filters before it) of every
    beginning of an order of ``n`` filters."""
    found = []
    for length in range(1, n + 1):
        for beginning in permutations(range(n), length):
            start = lehmer_rank(beginning, n)
            before = sum(1 << item for item in beginning[:-1])
            found.append(
                (length - 1, start, start + factorial(n - length), beginning[-1], before)
            )
    return found


def order_totals(masks: np.ndarray, counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(removed, redundant) of one part: ``masks`` and their ``counts`` (masks, measures) to
    totals (measures, ranks, steps) and, of the first measure, (ranks, steps)."""
    orders = factorial(n)
    removed = np.zeros((counts.shape[1], orders + 1, n), np.int64)
    redundant = np.zeros((orders + 1, n), np.int64)
    for step, start, end, item, before in intervals(n):
        fails = masks >> item & 1 == 1
        first = fails & (masks & before == 0)
        lost = counts[first].sum(axis=0)
        removed[:, start, step] += lost
        removed[:, end, step] -= lost
        later = counts[fails & ~first, 0].sum()
        redundant[start, step] += later
        redundant[end, step] -= later
    return removed.cumsum(axis=1)[:, :-1], redundant.cumsum(axis=0)[:-1]


def _audited(filters: str):
    n = len(filters)
    orders = list(permutations(range(n)))
    letters = np.array(orders)  # (ranks, steps): the lexicographic order is that of the ranks
    names = ["".join(filters[i] for i in order) for order in orders]

    def run(table: pa.Table) -> pa.Table:
        masks = table.column("mask").to_numpy().astype(np.int64)
        counts = np.stack(
            [table.column(c).to_numpy() for c in ("docs", "good", "toxic")], axis=1
        ).astype(np.int64)
        removed, redundant = order_totals(masks, counts, n)
        kept = counts[:, 0].sum() - removed[0].cumsum(axis=1)
        unique = np.array([counts[masks == 1 << i, 0].sum() for i in range(n)], np.int64)
        shapley = np.array([removed[0][letters == i].sum() for i in range(n)], np.int64)
        rows = len(orders) * n
        part = table.column("part")[0].as_py()
        return pa.Table.from_arrays(
            [pa.array([part] * rows, pa.string()), pa.array(np.repeat(names, n), pa.string()),
             pa.array(np.tile(np.arange(1, n + 1), len(orders)), pa.int32()),
             *(pa.array(values.ravel(), pa.int64()) for values in (
                 kept, removed[0], redundant, unique[letters], removed[1], removed[2],
                 shapley[letters]))],
            schema=AUDIT,
        )

    return run


def audit_orders(failures: DataFrame, filters: str = FILTERS) -> DataFrame:
    """The audit of rows (part, mask, docs, good, toxic): one row per part, order and step.

    Bit i of ``mask`` says that the documents fail filter i. A part is at most 2**n rows in its
    task, whatever the number of documents.
    """
    if not 1 <= len(set(filters)) == len(filters) <= MOST_FILTERS:
        raise ValueError(f"1 to {MOST_FILTERS} different filters, not {filters!r}")
    cells = failures.groupBy("part", "mask").agg(
        *(F.sum(c).cast("long").alias(c) for c in ("docs", "good", "toxic"))
    )
    return cells.groupBy("part").applyInArrow(_audited(filters), AUDIT_DDL)


def text_mask(data: bytes, code_points: int) -> int:
    """Filters A to D of a text in UTF-8, as bits 0 to 3."""
    words = data.split()  # of bytes: at ASCII white space alone
    capitals = len(data) - len(data.translate(None, CAPITALS))
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    return (
        (len(words) < MIN_WORDS)
        | (100 * len(set(words)) < 50 * len(words)) << 1
        | (100 * capitals > 3 * code_points) << 2
        | (symbols > 0) << 3
    )


def _masked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        masks, digests = [], []
        for value in batch.column(2):  # one text as a Python string at a time
            text = value.as_py() or ""
            data = text.encode("utf-8")
            masks.append(text_mask(data, len(text)))
            digests.append(hashlib.sha256(data).digest())
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:2], pa.array(masks, pa.int32()), pa.array(digests, pa.binary())],
            names=["doc_id", "part", "mask", "digest"],
        )


def document_failures(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "lang",
) -> DataFrame:
    """(part, mask, docs, good, toxic): documents counted by part and failed filters A to E."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.col(text_col).cast("string").alias("text"),
    ).mapInArrow(_masked, "doc_id long, part string, mask int, digest binary")
    # Equal rows at once, so that a very frequent id or text is a row per task.
    same = ["doc_id", "part", "mask", "digest"]
    rows = rows.groupBy(*same).agg(F.count(F.lit(1)).alias("docs"))
    marks = labels.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce((F.col("quality") == 1).cast("int"), F.lit(0)).alias("good"),
        F.coalesce((F.col("toxic") == 1).cast("int"), F.lit(0)).alias("toxic"),
    ).filter("doc_id is not null").groupBy("doc_id").agg(
        F.max("good").alias("good"), F.max("toxic").alias("toxic")
    )
    zero = F.lit(0)
    known = rows.filter("doc_id is not null").join(marks, "doc_id", "left").select(
        *same, "docs", F.coalesce("good", zero).alias("good"),
        F.coalesce("toxic", zero).alias("toxic"),
    )
    # By text, part and label: the smallest id and the rows that have it, of which all but those
    # of the text's smallest id fail E.
    texts = known.groupBy("digest", "part", "mask", "good", "toxic").agg(
        F.min("doc_id").alias("least"), F.min_by("docs", "doc_id").alias("firsts"),
        F.sum("docs").alias("docs"),
    )
    least = F.min("least").over(Window.partitionBy("digest"))
    texts = texts.withColumn("firsts", F.when(F.col("least") == least, F.col("firsts"))
                             .otherwise(0))
    repeated = 1 << FILTERS.index("E")
    either = F.array(
        F.struct(F.col("mask"), F.col("firsts").alias("docs")),
        F.struct((F.col("mask") + repeated).alias("mask"),
                 (F.col("docs") - F.col("firsts")).alias("docs")),
    )
    counted = texts.select("part", "good", "toxic", F.inline(either)).filter("docs > 0")
    nameless = rows.filter("doc_id is null").select(
        "part", zero.alias("good"), zero.alias("toxic"), "mask", "docs"
    )
    return counted.unionByName(nameless).groupBy("part", "mask").agg(
        F.sum("docs").alias("docs"), F.sum(F.col("docs") * F.col("good")).alias("good"),
        F.sum(F.col("docs") * F.col("toxic")).alias("toxic"),
    )


def audit_filters(docs: DataFrame, labels: DataFrame, **columns: str) -> DataFrame:
    """The audit of the five text filters over a whole corpus; see `audit_orders`."""
    return audit_orders(document_failures(docs, labels, **columns))
