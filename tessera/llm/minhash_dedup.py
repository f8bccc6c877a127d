"""MinHash near-duplicate groups of documents, confirmed on their full shingle sets.

Texts are lower-cased (A-Z) and cut into words at ASCII white space. A document's set is its
distinct shingles of ``SHINGLE`` words; with fewer words, the whole sequence is one shingle.
Documents with equal sets form a class, and classes alone are compared: 128 universal hash
minima, in 32 bands of 4, put classes with a similarity of 0.75 into a common bucket with
probability 1 - 5e-6. Links are found in two steps, so that no bucket gives all its pairs:

1. every class of a bucket is compared with the bucket's first class, and the links that hold
   are joined to components;
2. in buckets that still touch several components, the signatures of classes in different
   components are compared, in blocks of bounded members and shingles; pairs within 4 standard
   deviations of the threshold are confirmed on the full sets in the same task, which holds the
   block's texts. Pairs inside a component are not needed. A block gives the links that join
   components, fewer than it has members, however many of its pairs are almost alike.

The pairs of the first step, one per class and bucket, are confirmed in a grid: a pair belongs to
the cell of the hashes of both its classes, so that a class with very many partners is spread over
a whole row of cells, and each cell holds a text once for all its pairs.

Very long texts count by their shingles: a block has fewer of them. Empty tables give no rows.

Null, empty and blank texts have an empty set and no links. A null id is never a component id
unless no document of the group has another; rows that repeat an id are rows each for itself.
A class is known by the 64-bit fingerprint of its set, a shingle by a 64-bit fingerprint too.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import keyed_texts, stored
from tessera.llm.components import connected
from tessera.llm.hashing import Hasher, mix

SHINGLE = 5
PERCENT = 75
LAST_ID = (1 << 63) - 1
BANDS, ROWS = 32, 4
BLOCK_MEMBERS = 1024  # classes of one bucket compared at once with as many others
BLOCK_SHINGLES = 1 << 21  # and about so many shingles of theirs
SHARED_AT_ONCE = 1 << 14  # shingles whose owners are held as bits
PAIRS_AT_ONCE = 1 << 14
CELL_PAIRS = 2000  # about so many pairs are confirmed in a task's group

_random = np.random.default_rng(75)
FACTORS = _random.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * 2 + 1
TERMS = _random.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)
PLACES = _random.integers(0, 1 << 63, 64, dtype=np.uint64) * 2 + 1
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def shingle_set(text: str | None, size: int, hasher: Hasher) -> np.ndarray:
    """The sorted fingerprints of the distinct shingles."""
    data = np.frombuffer((text or "").encode("utf-8").lower(), np.uint8)
    blank = np.concatenate([[True], SPACE[data], [True]])
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    words = hasher.of(hasher.sums(data), edges[::2], edges[1::2])
    if not len(words):
        return words
    size = min(size, len(words))
    n = len(words) - size + 1
    total = np.full(n, size, np.uint64)
    for i in range(size):
        total += words[i : i + n] * PLACES[i]
    return np.unique(mix(total))


def signature(shingles: np.ndarray) -> np.ndarray:
    """The smallest value of each universal hash, its upper 32 bits."""
    low = np.full(len(FACTORS), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 512):
        part = shingles[None, at : at + 512]
        low = np.minimum(low, (part * FACTORS[:, None] + TERMS[:, None]).min(axis=1))
    return (low >> np.uint64(32)).astype(np.uint32)


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """A bucket number per document and band, which holds the band in its lowest bits."""
    bands = signatures.reshape(len(signatures), BANDS, ROWS).astype(np.uint64)
    key = mix((bands * PLACES[:ROWS]).sum(axis=2, dtype=np.uint64))
    return (key & ~np.uint64(BANDS - 1) | np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def _class_of(shingles: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)


def _sketches(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            sizes, classes, signatures = [], [], []
            for text in batch.column(1):  # one text as a Python string at a time
                shingles = shingle_set(text.as_py(), shingle, hasher)
                sizes.append(len(shingles))
                classes.append(_class_of(shingles) if len(shingles) else None)
                signatures.append(signature(shingles).tobytes() if len(shingles) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *batch.columns[2:], pa.array(sizes, pa.int64()),
                 pa.array(classes, pa.int64()), pa.array(signatures, pa.binary())],
                names=["doc_id", "order_id", "text_key", "n_shingles", "node", "signature"],
            )

    return run


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            part = batch.slice(at, 1000)
            packed = b"".join(part.column(2).to_pylist())
            keys = band_keys(np.frombuffer(packed, np.uint32).reshape(-1, BANDS * ROWS))
            nodes, sizes = (
                np.repeat(part.column(i).to_numpy(zero_copy_only=False), BANDS) for i in (0, 1)
            )
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.ravel()), pa.array(nodes), pa.array(sizes)],
                names=["bucket", "node", "n_shingles"],
            )


def _cell(grid: int):
    a, b = (F.pmod(F.xxhash64(c), F.lit(grid)) for c in ("a", "b"))
    return (a * grid + b).cast("int")


LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _confirmed(shingle: int, percent: int):
    def run(pairs: pa.Table, texts: pa.Table) -> pa.Table:
        if not pairs.num_rows:
            return LINKS.empty_table()
        hasher = Hasher()
        known = {
            node: shingle_set(text, shingle, hasher)
            for node, text in zip(
                texts.column("node").to_pylist(), texts.column("text").to_pylist(), strict=True
            )
        }
        a, b = (
            np.concatenate([np.frombuffer(p, np.int64) for p in pairs.column(c).to_pylist()])
            for c in ("a", "b")
        )
        order = np.lexsort((b, a))
        holds = np.zeros(len(a), bool)
        last = None
        for i in order.tolist():
            if (int(a[i]), int(b[i])) == last:
                continue
            last = int(a[i]), int(b[i])
            one, other = known[last[0]], known[last[1]]
            if 100 * min(len(one), len(other)) < percent * max(len(one), len(other)):
                continue
            common = len(np.intersect1d(one, other, assume_unique=True))
            union = len(one) + len(other) - common
            holds[i] = 100 * common >= percent * union
        return pa.Table.from_arrays([pa.array(a[holds]), pa.array(b[holds])], schema=LINKS)

    return run


def shared_counts(sets: list[np.ndarray]):
    """A function of pairs (x, y) of the sets' numbers to the sizes of their intersections.

    Only elements of several sets count; the owners of a stretch of them are rows of bits.
    """
    owners = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, place, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times > 1
    column = np.cumsum(shared) - 1
    wanted = shared[place]
    owners, column = owners[wanted], column[place[wanted]]
    order = np.argsort(column, kind="stable")
    owners, column = owners[order], column[order]
    bits = []
    for at in range(0, int(shared.sum()), SHARED_AT_ONCE):
        low, high = np.searchsorted(column, (at, at + SHARED_AT_ONCE))
        members, own = np.unique(owners[low:high], return_inverse=True)
        held = np.zeros((len(members) + 1, SHARED_AT_ONCE), bool)  # the last row owns nothing
        held[own, column[low:high] - at] = True
        row = np.full(len(sets), len(members))
        row[members] = np.arange(len(members))
        bits.append((row, np.packbits(held, axis=1).view(np.uint64)))

    def count(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x), np.int64)
        for row, packed in bits:
            both = packed[row[x]]
            both &= packed[row[y]]
            total += np.bitwise_count(both).sum(axis=1, dtype=np.int64)
        return total

    return count


def _joined(components: np.ndarray, x: np.ndarray, y: np.ndarray, holds) -> list[int]:
    """The places of the pairs that join components, out of those that hold; pairs whose sides
    are joined by then are not looked at."""
    parent = {c: c for c in components.tolist()}

    def find(c):
        while parent[c] != c:
            parent[c] = parent[parent[c]]
            c = parent[c]
        return c

    found = []
    for at in range(0, len(x), PAIRS_AT_ONCE):
        places = np.arange(at, min(at + PAIRS_AT_ONCE, len(x)))
        root = {c: find(c) for c in parent}
        one, other = (
            np.array([root[c] for c in components[side[places]].tolist()], np.int64)
            for side in (x, y)
        )
        places = places[one != other]
        for place in places[holds(x[places], y[places])].tolist():
            a, b = find(int(components[x[place]])), find(int(components[y[place]]))
            if a != b:
                parent[max(a, b)] = min(a, b)
                found.append(place)
    return found


def _across(shingle: int, percent: int):
    """Links of one block of a bucket that join different components."""
    n = BANDS * ROWS
    share = percent / 100
    least = n * share - 4 * math.sqrt(n * share * (1 - share))

    def run(table: pa.Table) -> pa.Table:
        bucket, i, j = (table.column(c)[0].as_py() for c in ("bucket", "i", "j"))
        order = np.argsort(table.column("node").to_numpy())
        nodes, parts, components = (
            table.column(c).to_numpy()[order] for c in ("node", "part", "component")
        )
        signatures = np.frombuffer(
            b"".join(table.column("signature").to_pylist()), np.uint32
        ).reshape(-1, n)[order]
        left, right = np.flatnonzero(parts == i), np.flatnonzero(parts == j)
        band, found = bucket % BANDS, [(np.empty(0, np.int64),) * 2]
        for at in range(0, len(left), 256):
            rows = left[at : at + 256]
            alike = np.zeros((len(rows), len(right)), np.uint16)
            for k in range(n):
                alike += signatures[rows, k][:, None] == signatures[right, k][None, :]
            good = alike >= least
            good &= components[rows][:, None] != components[right][None, :]
            good &= nodes[rows][:, None] < nodes[right][None, :] if i == j else True
            x, y = np.nonzero(good)
            for part in range(0, len(x), PAIRS_AT_ONCE):
                one = rows[x[part : part + PAIRS_AT_ONCE]]
                other = right[y[part : part + PAIRS_AT_ONCE]]
                # A pair is followed up in the first of the bands that it has in common.
                common = (signatures[one] == signatures[other]).reshape(-1, BANDS, ROWS)
                first = common.all(axis=2).argmax(axis=1) == band
                found.append((one[first], other[first]))
        x, y = (np.concatenate(c) for c in zip(*found, strict=True))
        if not len(x):
            return LINKS.empty_table()
        used, places = np.unique(np.concatenate([x, y]), return_inverse=True)
        x, y = places[: len(x)], places[len(x) :]
        hasher, texts = Hasher(), table.column("text")
        sets = [shingle_set(texts[k].as_py(), shingle, hasher) for k in order[used].tolist()]
        sizes = np.array([len(s) for s in sets])
        count = shared_counts(sets)

        def holds(x, y):
            common = count(x, y)
            return 100 * common >= percent * (sizes[x] + sizes[y] - common)

        links = _joined(components[used], x, y, holds)
        one, other = nodes[used[x[links]]], nodes[used[y[links]]]
        return pa.Table.from_arrays([pa.array(one), pa.array(other)], schema=LINKS)

    return run


def _grid(pairs: int) -> int:
    return max(1, math.isqrt(max(0, pairs) // CELL_PAIRS + 1))


def _confirm(packed: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The links among packed pairs (cell, a, b); every cell gets each of its texts once."""

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cell, a, b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                nodes = np.unique(np.frombuffer(a + b, np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(nodes), cell, np.int32)), pa.array(nodes)],
                    names=["cell", "node"],
                )

    needed = packed.select("cell", "a", "b").mapInArrow(ends, "cell int, node long").distinct()
    sent = needed.join(texts.select("node", "text"), "node").select("cell", "node", "text")
    return packed.groupBy("cell").cogroup(sent.groupBy("cell")).applyInArrow(
        _confirmed(shingle, percent), "a long, b long"
    )


def near_duplicates(
    df: DataFrame,
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_members: int = BLOCK_MEMBERS,
    block_shingles: int = BLOCK_SHINGLES,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row."""
    docs = _keyed(df, id_col, text_col)
    sketches, grouped = _grouped(docs, shingle, percent, block_members, block_shingles)
    smallest = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    named = grouped.join(smallest, "component").select("node", "component_id")
    return sketches.select("doc_id", "n_shingles", "node").join(named, "node", "left").select(
        "doc_id", "n_shingles",
        F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce("component_id", "doc_id").eqNullSafe(F.col("doc_id")).alias("kept"),
    )


def one_of_each_group(
    df: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """The rows of ``df`` but for near duplicates: of each group exactly one row stays, whatever
    its id. It is the one with the smallest id, nulls last, then by a hash of its text, then by
    its other columns; of rows equal in everything one stays. Rows without words all stay."""
    columns = [F.col(c) for c in df.columns]
    rows = df.select(
        F.struct(*columns).alias("row"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("order_id"),
        F.col(text_col).cast("string").alias("text"),
    )
    has_words = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    rows = rows.select("row", "order_id", F.xxhash64("text").alias("text_key"),
                       has_words.alias("has_words"))
    sketches, grouped = _grouped(
        _keyed(df, id_col, text_col), shingle, percent, BLOCK_MEMBERS, BLOCK_SHINGLES
    )
    chosen = grouped.groupBy("component").agg(F.min("holder").alias("holder")).select("holder.*")
    # How many rows share the chosen one's id and text: nearly always itself alone.
    alike = sketches.groupBy("order_id", "text_key").agg(F.count(F.lit(1)).alias("alike"))
    chosen = stored(chosen.join(alike, ["order_id", "text_key"]))
    found = rows.filter("has_words").join(chosen, ["order_id", "text_key"])
    single = found.filter("alike = 1").select("row")
    several = found.filter("alike > 1").groupBy("order_id", "text_key").agg(
        F.min("row").alias("row")
    ).select("row")
    kept = rows.filter("not has_words").select("row").unionAll(single).unionAll(several)
    return kept.select("row.*")


def _keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return keyed_texts(df, id_col, text_col).select(
        "doc_id", "text", F.coalesce("doc_id", F.lit(LAST_ID)).alias("order_id"),
        F.xxhash64("text").alias("text_key"),
    )


def _grouped(
    docs: DataFrame, shingle: int, percent: int, block_members: int, block_shingles: int
) -> tuple[DataFrame, DataFrame]:
    """The sketch of every row, and (node, least, holder, component) of every class: its smallest
    id, the (order_id, text_key) of its smallest row, and its component of classes."""
    sketches = stored(docs.mapInArrow(
        _sketches(shingle),
        "doc_id long, order_id long, text_key long, n_shingles long, node long, signature binary",
    ))
    # Equal sets are combined before the shuffle, so that copies weigh nothing from here on.
    classes = stored(sketches.filter("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("least"), F.min("signature").alias("signature"),
        F.max("n_shingles").alias("n_shingles"),
        F.min(F.struct("order_id", "text_key")).alias("holder"),
    ))
    rows = classes.select("node", "n_shingles", "signature").mapInArrow(
        _buckets, "bucket long, node long, n_shingles long"
    )
    shared = rows.groupBy("bucket").agg(
        F.min("node").alias("first"), F.max("node").alias("last")
    ).filter("first != last")
    members = stored(rows.join(shared.select("bucket", "first"), "bucket"))
    star = members.filter("node != first").select(
        F.least("first", "node").alias("a"), F.greatest("first", "node").alias("b")
    ).distinct()

    # A text and the signature of each class that shares a bucket.
    holder = classes.join(members.select("node").distinct(), "node", "left_semi").select(
        "node", "holder.*"
    )
    texts = stored(_texts_of(holder, docs, shingle))

    star = stored(star)
    grid = _grid(star.count())
    pairs = star.select(
        _cell(grid).alias("cell"), "a", "b"
    ).groupBy("cell").applyInArrow(_pack, "cell int, a binary, b binary")
    links = stored(_confirm(pairs, texts, shingle, percent))
    components = stored(connected(links))

    placed = members.join(components, "node", "left").select(
        "bucket", "node", "n_shingles", F.coalesce("component", "node").alias("component")
    )
    torn = placed.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("room"),
        F.min("component").alias("least"), F.max("component").alias("most"),
    ).filter("least != most and n > 2").withColumn("parts", F.ceil(F.greatest(
        F.col("n") / block_members, F.col("room") / block_shingles
    )).cast("int"))
    torn_rows = placed.join(torn.select("bucket", "parts"), "bucket")
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    blocks = torn_rows.withColumn("part", part).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    ).select(
        "bucket", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"),
        "part", "node", "component",
    ).join(texts, "node")
    more = stored(blocks.groupBy("bucket", "i", "j").applyInArrow(
        _across(shingle, percent), "a long, b long"
    ))
    if not more.isEmpty():
        components = connected(links.unionByName(more))
    grouped = classes.select("node", "least", "holder").join(components, "node", "left").select(
        "node", "least", "holder", F.coalesce("component", "node").alias("component")
    )
    return sketches, grouped


def _pack(table: pa.Table) -> pa.Table:
    a, b = (table.column(c).to_numpy().tobytes() for c in ("a", "b"))
    return pa.table({
        "cell": pa.array([table.column("cell")[0].as_py()], pa.int32()),
        "a": pa.array([a], pa.binary()), "b": pa.array([b], pa.binary()),
    })


def _texts_of(holder: DataFrame, docs: DataFrame, shingle: int) -> DataFrame:
    """(node, text, signature) of the classes, from the texts of their holders."""
    schema = pa.schema([("node", pa.int64()), ("text", pa.string()), ("signature", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                rows = []
                for text, node in zip(
                    *(c.to_pylist() for c in batch.slice(at, 500).columns), strict=True
                ):
                    shingles = shingle_set(text, shingle, hasher)
                    rows.append((node, text, signature(shingles).tobytes()))
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)],
                    schema=schema,
                )

    # Rows that repeat an id and a text are one; the join has brought them together.
    named = docs.join(holder, ["order_id", "text_key"]).dropDuplicates(["order_id", "text_key"])
    return named.select("text", "node").mapInArrow(
        run, "node long, text string, signature binary"
    )
