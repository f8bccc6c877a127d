"""The trie of all conversations' beginnings, as a compacted z-fast trie spread over the cluster.

A *print* is a 128-bit hash of a conversation's first d turns, chained turn by turn, so equal prints
mean equal beginnings. A compacted node stands for the stretch of turns between two places where
conversations part or end; it is a row with its stretch (a print and the code points so far for each
turn) and its *handle*: the print at the two-fattest depth of the stretch, the depth divisible by
the highest power of two. The table of handles is the trie's dictionary.

1. Turns are put in order and chained, a shuffle of 32 bytes a turn; equal conversations become one
   *string* with a count, so that copies weigh nothing from here on.
2. Strings are inserted in batches of a random order, each ``GROWTH`` times the one before. A
   batch's strings find their exit node by fat binary search, all at once: a join with the dictionary
   per bit of the greatest length. A hit goes on below the node or ends in its stretch, a miss goes on
   above. Strings that leave the trie with the same turn at the same node meet, together with the
   stretch they leave in, and are split into new nodes. Between two strings of a random sample
   there are about ``GROWTH`` others, so these groups stay small however many share a beginning.
3. Counts, smallest members, leaves and code points are added up the tree by doubling: after k
   rounds every node has what lies less than 2**k nodes below it.
4. Stretches are expanded to one row per depth.

Turns with equal numbers, or none, are in order of the MD5 of role and text. Rows without a
conv_id belong to no conversation; null roles and texts are empty. Repeated rows are turns each for
itself. Texts of any length are hashed where they lie and never travel. A conversation's chain, 24
bytes a turn, is one row of one task. An empty table has no members and gives no rows.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import stored

PRINT = 16  # bytes of a print
ENTRY = PRINT + 8  # a turn of a chain: print, code points of all turns so far
ROOT = bytes(PRINT)
FIRST_BATCH = 4096
GROWTH = 32
IDS_PER_ROW_BITS = 12
ROWS_AT_ONCE, BYTES_AT_ONCE = 2000, 4 << 20
STEP = np.dtype([("print", f"S{PRINT}"), ("points", ">i8")])
NO_ENDS = hashlib.sha256(b"").hexdigest()

STRETCH = pa.schema([
    ("first", pa.binary()), ("handle", pa.binary()), ("above", pa.binary()), ("node", pa.binary()),
    ("begin", pa.int32()), ("end", pa.int32()), ("start", pa.int64()), ("steps", pa.binary()),
])
STRETCH_DDL = (
    "first binary, handle binary, above binary, node binary, begin int, end int, start long, "
    "steps binary"
)


class Rows:
    """Collects rows into batches of bounded size."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows, self.bytes = schema, [], 0

    def add(self, row: tuple, size: int = 0) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.bytes += size
        if len(self.rows) >= ROWS_AT_ONCE or self.bytes >= BYTES_AT_ONCE:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            columns = zip(*self.rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, self.schema, strict=True)],
                schema=self.schema,
            )
            self.rows, self.bytes = [], 0


def two_fattest(low: int, high: int) -> int:
    """The number in (low, high] that is divisible by the highest power of two."""
    return high & (-1 << ((low ^ high).bit_length() - 1))


def shared_turns(conv_id: int, limit: int) -> int:
    return zlib.crc32(str(conv_id).encode()) % limit


CHAIN = pa.schema([
    ("conv_id", pa.int64()), ("depth", pa.int32()), ("node", pa.binary()), ("chain", pa.binary()),
])


def _chained(limit: int | None):
    """Turns in order, group by group with the group's base first, to one chain per conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Rows(CHAIN)
        base_of = conv = None
        begun: list[tuple[bytes, int]] = []  # the base's first turns
        chain, last, points, skip, is_base = bytearray(), ROOT, 0, 0, False

        def done():
            return out.add((conv, len(chain) // ENTRY, last, bytes(chain)), len(chain))

        for batch in batches:
            for base, conv_id, key, length in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                if conv_id != conv:
                    if conv is not None:
                        yield from done()
                    if base != base_of:
                        base_of, begun = base, []
                    conv, is_base = conv_id, conv_id == base
                    skip = 0 if is_base or not limit else shared_turns(conv, limit)
                    chain, last, points = bytearray(), ROOT, 0
                    for last, points in begun[:skip]:
                        chain += last + points.to_bytes(8, "big")
                if skip:
                    skip -= 1
                    continue
                last, points = xxhash.xxh3_128_digest(last + key), points + length
                chain += last + points.to_bytes(8, "big")
                if is_base and limit and len(begun) < limit:
                    begun.append((last, points))
        if conv is not None:
            yield from done()
        yield from out.rest()

    return run


def chains(df: DataFrame, branch: tuple[int, int] | None = None) -> DataFrame:
    """(conv_id, depth, node, chain): every conversation's turns as a chain of prints.

    With ``branch`` (group, limit) conversation c begins with the first h turns of conversation
    c - c % group, h being the CRC-32 of its number modulo limit, and goes on with its own turns
    after its first h.
    """
    empty = F.lit("")
    role, text = (F.coalesce(F.col(c).cast("string"), empty) for c in ("role", "text"))
    # The role's length keeps ("ab", "c") apart from ("a", "bc").
    key = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))
    conv = F.col("conv_id").cast("long")
    base = conv if branch is None else conv - conv % branch[0]
    turns = df.select(
        base.alias("base"), conv.alias("conv"), F.col("turn").cast("long").alias("place"),
        key.alias("key"), F.length(text).cast("long").alias("points"),
    ).filter("conv is not null")
    ordered = turns.repartition("base").sortWithinPartitions(
        "base", F.col("conv") != F.col("base"), "conv", F.col("place").asc_nulls_first(), "key"
    )
    return ordered.select("base", "conv", "key", "points").mapInArrow(
        _chained(branch and branch[1]), "conv_id long, depth int, node binary, chain binary"
    )


def _print_at(depth: Column) -> Column:
    """The print at a depth of at least 1 of the column ``chain``."""
    return F.col("chain").substr((depth - 1) * ENTRY + 1, F.lit(PRINT))


def _number(eight_bytes: Column) -> Column:
    return F.conv(F.hex(eight_bytes), 16, 10).cast("long")


def _located(batch: DataFrame, stretches: DataFrame, greatest: int) -> DataFrame:
    """Adds ``low``, the end of the last node that the string passes whole: the string ends there
    or goes on in, or beside, a stretch that begins there."""
    dictionary = stretches.select(
        "handle", F.col("begin").alias("hit_begin"), F.col("end").alias("hit_end"),
        F.col("node").alias("hit_node"),
    )
    low, high, depth = F.col("low"), F.col("high"), F.col("depth")
    found = batch.select("*", F.lit(0).alias("low"), depth.alias("high"))
    for _ in range(greatest.bit_length()):
        fattest = F.expr("shiftleft(shiftright(high, length(bin(low ^ high)) - 1), "
                         "length(bin(low ^ high)) - 1)")
        # A string that is done asks for what is in no dictionary, spread over the partitions.
        probe = F.when(low < high, _print_at(fattest)).otherwise(
            F.concat(F.col("node"), F.lit(b"."))
        )
        asked = found.withColumn("probe", probe).withColumn("fattest", fattest).join(
            dictionary, F.col("probe") == F.col("handle"), "left"
        )
        hit, end = F.col("handle").isNotNull(), F.col("hit_end")
        whole = (end <= depth) & (_print_at(end) == F.col("hit_node"))
        found = asked.select(
            *batch.columns,
            F.when(hit & whole, end).when(hit, F.col("hit_begin")).otherwise(low).alias("low"),
            F.when(low >= high, high).when(hit & whole, high).when(hit, F.col("hit_begin"))
            .otherwise(F.col("fattest") - 1).alias("high"),
        )
    return found


def split(sequences: list[np.ndarray], begin: int, above: bytes, start: int) -> list[tuple]:
    """The nodes of strings with a common first turn, as rows of `STRETCH`: all are sequences
    of `STEP` from depth ``begin`` on."""
    found, open_ = [], [(sequences, 0, above, start)]
    while open_:
        together, at, above, start = open_.pop()
        one, shortest = together[0], min(map(len, together))
        end = at + 1  # the first steps are equal; equal prints mean equal beginnings
        for other in together[1:]:
            if len(other) != len(one) or other["print"][-1] != one["print"][-1]:
                shortest = min(shortest, _common(one, other, at + 1, shortest))
        end = max(end, shortest)
        steps = one[at:end]
        prints, depth = steps["print"], begin + at
        fattest = two_fattest(depth, begin + end) - depth
        found.append((
            _bytes(prints[0]), _bytes(prints[fattest - 1]), above, _bytes(prints[-1]),
            depth, begin + end, start, steps.tobytes(),
        ))
        parting: dict[bytes, list[np.ndarray]] = {}
        for sequence in together:
            if len(sequence) > end:
                parting.setdefault(_bytes(sequence["print"][end]), []).append(sequence)
        for group in parting.values():
            open_.append((group, end, _bytes(prints[-1]), int(steps["points"][-1])))
    return found


def _bytes(value: np.bytes_) -> bytes:
    return bytes(value).ljust(PRINT, b"\0")  # numpy drops zero bytes at the end


def _common(one: np.ndarray, other: np.ndarray, low: int, high: int) -> int:
    """How many first steps are equal, of which ``low`` are known to be."""
    high = min(high, len(other))
    while low < high:
        middle = (low + high + 1) // 2
        if one["print"][middle - 1] == other["print"][middle - 1]:
            low = middle
        else:
            high = middle - 1
    return low


def _grown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (first, is_new, begin, above, start, steps) in order of the first two, to stretches."""
    out, rows, current = Rows(STRETCH), [], None

    def done():
        _, begin, above, start, _ = rows[0]
        sequences = [np.frombuffer(row[4], STEP) for row in rows]
        for found in split(sequences, begin, above, start):
            yield from out.add(found, len(found[-1]))

    for batch in batches:
        for first, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if first != current and rows:
                yield from done()
                rows = []
            current = first
            rows.append(row)
    if rows:
        yield from done()
    yield from out.rest()


def _inserted(batch: DataFrame, stretches: DataFrame | None, greatest: int) -> DataFrame:
    """The stretches after a batch of strings."""
    if stretches is None:
        placed = batch.withColumn("low", F.lit(0))
    else:
        placed = _located(batch, stretches, greatest).filter("low < depth")
    low, inside = F.col("low"), F.col("low") > 0
    points = F.col("chain").substr((low - 1) * ENTRY + PRINT + 1, F.lit(8))
    fresh = placed.select(
        _print_at(low + 1).alias("first"), F.lit(True).alias("is_new"), low.alias("begin"),
        F.when(inside, _print_at(low)).otherwise(F.lit(ROOT)).alias("above"),
        F.when(inside, _number(points)).otherwise(0).alias("start"),
        F.col("chain").substr(low * ENTRY + 1, F.length("chain")).alias("steps"),
    )
    if stretches is not None:
        fresh = fresh.unionByName(stretches.select(
            "first", F.lit(False).alias("is_new"), "begin", "above", "start", "steps"
        ))
    return fresh.repartition("first").sortWithinPartitions("first", "is_new").mapInArrow(
        _grown, STRETCH_DDL
    )


def build_trie(strings: DataFrame) -> DataFrame:
    """The compacted trie of distinct strings (node, depth, chain), as rows of `STRETCH`."""
    total, greatest = strings.agg(F.count(F.lit(1)), F.max("depth")).first()
    draw = F.pmod(F.xxhash64("node"), F.lit(1 << 40)) / float(1 << 40)
    stretches, before, share = None, 0.0, FIRST_BATCH / max(1, total)
    while before < 1 or stretches is None:
        batch = strings.filter((draw >= before) & (draw < min(share, 1.0)))
        stretches = stored(_inserted(batch, stretches, greatest or 0))
        before, share = share, share * GROWTH
    return stretches


SUMS = ("convs", "weighted", "points", "leaves")


def _added_up(nodes: DataFrame) -> DataFrame:
    """Every node's sums and smallest member over its subtree, by doubling; ``nodes`` has a row
    (node, above, smallest, *SUMS) each."""
    table = nodes.withColumn("up", F.nullif("above", F.lit(ROOT)))
    names = ["node", "above", "smallest", *SUMS]
    while True:
        table = stored(table.select(*names, "up"))
        live = table.filter("up is not null")
        if live.isEmpty():
            return table.select(*names)
        below = live.groupBy(F.col("up").alias("below_of")).agg(
            F.min("smallest").alias("below_smallest"), *(F.sum(c).alias(f"below_{c}") for c in SUMS)
        )
        higher = live.select(F.col("node").alias("higher"), F.col("up").alias("next"))
        moved = live.join(higher, F.col("up") == F.col("higher"), "left").select(*names, "next")
        moved = moved.unionByName(
            table.filter("up is null").select(*names, F.col("up").alias("next"))
        )
        table = moved.join(below, F.col("node") == F.col("below_of"), "left").select(
            "node", "above", F.least("smallest", "below_smallest").alias("smallest"),
            *((F.col(c) + F.coalesce(f"below_{c}", F.lit(0))).alias(c) for c in SUMS),
            F.col("next").alias("up"),
        )


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids (node, text) in order to one hash per node; a node's ids are never held together."""
    schema = pa.schema([("end_node", pa.binary()), ("ends_sha256", pa.string())])
    out, current, running = Rows(schema), None, None
    for batch in batches:
        for node, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if node != current:
                if current is not None:
                    yield from out.add((current, running.hexdigest()))
                current, running = node, hashlib.sha256(ids.encode())
            else:
                running.update(b"," + ids.encode())
    if current is not None:
        yield from out.add((current, running.hexdigest()))
    yield from out.rest()


def end_hashes(ended: DataFrame) -> DataFrame:
    """(end_node, ends_sha256) of rows (node, conv_id): the ids that end at a node, in order.

    Neighbouring ids are joined first, at most 2**12 in a row; the hash of a node then reads its
    rows one after the other."""
    chunks = ended.groupBy(
        "node", F.shiftright("conv_id", IDS_PER_ROW_BITS).alias("chunk")
    ).agg(F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",")
          .alias("ids"))
    return chunks.repartition("node").sortWithinPartitions("node", "chunk").select(
        "node", "ids"
    ).mapInArrow(_hashed, "end_node binary, ends_sha256 string")


NODE = pa.schema([
    ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()),
    ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()),
    ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()),
])
NODE_DDL = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
            "n_leaves long, saved_tokens long, ends_sha256 string")


def _expanded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per depth of each stretch."""
    for batch in batches:
        for row in batch.to_pylist():
            points = np.frombuffer(row["steps"], STEP)["points"]
            n = len(points)
            below = (row["weighted"] - row["convs"] * int(points[-1])
                     - (row["points"] - (int(points[-1]) - row["start"])))
            before = np.concatenate([[row["start"]], points[:-1]])
            saved = below + (row["convs"] - 1) * (points[-1] - before)
            for at in range(0, n, ROWS_AT_ONCE):
                size = min(ROWS_AT_ONCE, n - at)
                last = at + size == n
                parents = np.full(size, row["smallest"], np.int64)
                children = np.ones(size, np.int64)
                ends = [NO_ENDS] * size
                if at == 0:
                    parents[0] = row["parent"]
                if last:
                    children[-1], ends[-1] = row["children"], row["ends_sha256"] or NO_ENDS
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(size, row["smallest"], np.int64)),
                     pa.array(np.arange(row["begin"] + at + 1, row["begin"] + at + size + 1)),
                     pa.array(parents), pa.array(np.full(size, row["convs"], np.int64)),
                     pa.array(children), pa.array(np.full(size, row["leaves"], np.int64)),
                     pa.array(saved[at : at + size]), pa.array(ends, pa.string())],
                    schema=NODE,
                )


def prefix_trie(df: DataFrame, branch: tuple[int, int] | None = None) -> DataFrame:
    """One row per node of the trie of conversations (conv_id, turn, role, text).

    ``conv_id`` is the smallest member, ``depth`` the number of turns, ``parent_conv_id`` the
    parent's smallest member; ``n_convs`` members, ``n_children``, ``n_leaves`` childless nodes of
    the subtree, ``saved_tokens`` the code points that the subtree stores once instead of per
    member, ``ends_sha256`` the hash of the members that end here. ``branch``: see `chains`.
    """
    rows = stored(chains(df, branch))
    heads = rows.groupBy("node").agg(
        F.count(F.lit(1)).alias("convs"), F.min("conv_id").alias("smallest")
    )
    heads = stored(heads)
    strings = stored(
        rows.filter("depth > 0")
        .join(heads.select("smallest"), F.col("conv_id") == F.col("smallest"), "left_semi")
        .select("node", "depth", "chain")
    )
    stretches = build_trie(strings)
    children = stretches.groupBy(F.col("above").alias("parent_node")).agg(
        F.count(F.lit(1)).alias("children")
    )
    ends = heads.select(
        F.col("node").alias("head"), "smallest", F.col("convs").alias("ended")
    )
    reached = _number(F.expr("substring(steps, length(steps) - 7, 8)"))
    none = F.lit(0).cast("long")
    placed = (
        stretches.join(ends, F.col("node") == F.col("head"), "left")
        .join(children, F.col("node") == F.col("parent_node"), "left")
        .select(
            "node", "above", "begin", "start", "steps", "smallest",
            F.coalesce("ended", none).alias("convs"),
            (F.coalesce("ended", none) * reached).alias("weighted"),
            (reached - F.col("start")).alias("points"),
            F.coalesce("children", none).alias("children"),
            F.when(F.col("children").isNull(), 1).otherwise(0).cast("long").alias("leaves"),
        )
    )
    placed = stored(placed)
    sums = _added_up(placed.select("node", "above", "smallest", *SUMS))
    hashes = end_hashes(rows.select("node", "conv_id"))
    hashes = stored(hashes)
    total, least = heads.agg(F.sum("convs"), F.min("smallest")).first()
    parents = sums.select(
        F.col("node").alias("parent_node"), F.col("smallest").alias("parent")
    )
    nodes = (
        placed.select("node", "begin", "start", "steps", "children")
        .join(sums, "node")
        .join(parents, F.col("above") == F.col("parent_node"), "left")
        .join(hashes, F.col("node") == F.col("end_node"), "left")
        .select(
            "begin", "start", "steps", "children", "smallest", *SUMS, "ends_sha256",
            F.coalesce("parent", F.lit(least)).alias("parent"),
        )
        .mapInArrow(_expanded, NODE_DDL)
    )
    if not total:
        return nodes
    # The root: of the nodes below it, and of what ends there.
    tops = sums.filter(F.col("above") == F.lit(ROOT)).select(
        "leaves", (F.col("weighted") - F.col("points")).alias("saved"), F.lit(1).alias("child"),
        F.lit(None).cast("string").alias("ends"),
    ).unionByName(hashes.filter(F.col("end_node") == F.lit(ROOT)).select(
        none.alias("leaves"), none.alias("saved"), F.lit(0).alias("child"),
        F.col("ends_sha256").alias("ends"),
    ))
    childless = F.sum("child") == 0
    root = tops.agg(
        F.lit(least).cast("long").alias("conv_id"), none.alias("depth"),
        F.lit(None).cast("long").alias("parent_conv_id"),
        F.lit(total).cast("long").alias("n_convs"), F.sum("child").alias("n_children"),
        F.when(childless, 1).otherwise(F.sum("leaves")).cast("long").alias("n_leaves"),
        F.sum("saved").alias("saved_tokens"),
        F.coalesce(F.max("ends"), F.lit(NO_ENDS)).alias("ends_sha256"),
    )
    return nodes.unionByName(root)
