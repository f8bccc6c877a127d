"""What several operators share: input tables, intermediate tables, blocks of documents.

A *block* is a group of documents small enough for one Python task. Operators that compare
all documents exchange packed arrays between blocks and hash *parts* instead of a row per
word or position: a row holds what one block sends to one part, so that copies inside a block
are merged before the shuffle and no key can collect more than one entry per block.
"""

from __future__ import annotations

import ctypes
import math
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def workers_find_package(spark: SparkSession) -> None:
    """Python workers look for this package where the driver found it. A cluster whose machines
    do not share that folder gets the package by ``--py-files``."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster shares; one of our own only in local mode without one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    folder = folder or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="tessera-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def stored(df: DataFrame) -> DataFrame:
    """The frame written to the shared folder and read back: computed once, and a lost
    executor costs another read of it, not another computation."""
    path = f"{shared_folder(df.sparkSession)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(column: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(column, UPPER, UPPER.lower())


def keyed_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id long, text string) alone, so that no other column can clash."""
    return df.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def block_count(texts: DataFrame, block_bytes: int, per_partition: int = 2) -> int:
    """How many blocks keep each near ``block_bytes``, and every task busy."""
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(
        math.ceil(total / block_bytes), per_partition * shuffle_partitions(texts.sparkSession)
    )


def blocked(texts: DataFrame, blocks: int) -> DataFrame:
    """Adds ``block``, chosen by the row's own content, so the same in every reading."""
    block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int")
    return texts.select(block.alias("block"), "*")


def give_back() -> None:
    """Free memory goes back to the system. A worker outlives its task, and so does what it keeps."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
    if trim is not None:
        trim(0)


def tidy(run: Callable) -> Callable:
    """The function of one or two tables, giving back its memory after each call."""

    def one(table):
        result = run(table)
        give_back()
        return result

    def two(left, right):
        result = run(left, right)
        give_back()
        return result

    return one if run.__code__.co_argcount == 1 else two


def dealt(part: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(part, the places that go to it, in order) for every part that gets any."""
    order = np.argsort(part, kind="stable")
    found, starts = np.unique(part[order], return_index=True)
    yield from zip(found.tolist(), np.split(order, starts[1:]) if len(found) else [], strict=True)


def pack(array: np.ndarray, kind, rising: bool = False) -> bytes:
    """Numbers in few bytes: differences if they rise, byte by byte of equal weight, compressed."""
    array = array.astype(kind)
    if rising:
        array = np.diff(array, prepend=array.dtype.type(0))
    planes = array.view(np.uint8).reshape(len(array), array.dtype.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes, kind, rising: bool = False) -> np.ndarray:
    kind = np.dtype(kind)
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    array = np.ascontiguousarray(raw.reshape(kind.itemsize, -1).T).view(kind).ravel()
    return np.cumsum(array, dtype=kind) if rising else array
