"""Channel tables as typed DataFrames."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tessera.schemas import BY_KEY, CHANNELS, Channel

Channels = Mapping[str, DataFrame]  # channel key -> its table


@dataclass(frozen=True)
class TableNames:
    """Where the tables live. An empty catalog or schema leaves that part to the session."""

    catalog: str = ""
    schema: str = "default"
    profile_table: str = "customer_profile"

    @classmethod
    def from_env(cls, prefix: str = "TESSERA_") -> TableNames:
        given = {
            field: os.environ[prefix + field.upper()]
            for field in ("catalog", "schema", "profile_table")
            if prefix + field.upper() in os.environ
        }
        return cls(**given)

    def qualified(self, table: str) -> str:
        parts = [part for part in (self.catalog, self.schema, table) if part]
        return ".".join("`" + part.replace("`", "``") + "`" for part in parts)

    @property
    def profile(self) -> str:
        return self.qualified(self.profile_table)


def conform(df: DataFrame, channel: Channel, enforce_required: bool = False) -> DataFrame:
    """``df`` with exactly the channel's columns and types.

    ``enforce_required`` makes a null in any column fail the job, for use when loading;
    `quality.null_report` counts the nulls of a table that is already there.
    """
    present = df.columns
    missing = [f.name for f in channel.schema if f.name not in present]
    if missing:
        raise ValueError(f"{channel.table} lacks columns {missing}")
    columns = []
    for field in channel.schema:
        kind = field.dataType.simpleString()
        typed = f"cast({field.name} as {kind})"
        if enforce_required:
            error = f"raise_error('null in required column {channel.table}.{field.name}')"
            typed = f"if({typed} is null, cast({error} as {kind}), {typed})"
        columns.append(f"{typed} as {field.name}")
    typed = df.selectExpr(*columns)
    got = [(f.name, f.dataType) for f in typed.schema]
    assert got == [(f.name, f.dataType) for f in channel.schema], got
    return typed


def channels_from_catalog(spark: SparkSession, names: TableNames) -> Channels:
    return {c.key: conform(spark.table(names.qualified(c.table)), c) for c in CHANNELS}


def channels_from_parquet(spark: SparkSession, root: str) -> Channels:
    return {c.key: conform(spark.read.parquet(f"{root}/{c.table}"), c) for c in CHANNELS}


def described(channels: Channels) -> list[tuple[Channel, DataFrame]]:
    """The given channels with their descriptions, always in the fixed channel order."""
    unknown = set(channels) - set(BY_KEY)
    if unknown:
        raise ValueError(f"unknown channels {sorted(unknown)}")
    return [(c, channels[c.key]) for c in CHANNELS if c.key in channels]
