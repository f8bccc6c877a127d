"""Per-customer measures: of one channel, or merged over all channels.

Each channel is aggregated by e-mail on its own, so only its own few columns are shuffled,
already combined on the map side. The channels' results share one hash partitioning, which
a union keeps (Spark 4.1), so merging them per customer needs neither a join nor another
shuffle. A hot e-mail is one row per map task throughout.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.schemas import CHANNELS, ROLLUPS, Channel
from tessera.sources.tables import Channels, described

_COMBINE = {"count": "sum", "sum": "sum", "max": "max"}

CHANNELS_USED = (
    "array_compact(array("
    + ", ".join(f"if({c.count} > 0, '{c.key}', null)" for c in CHANNELS)
    + ")) as channels_used"
)
CHANNEL_COUNT = (
    " + ".join(f"if({c.count} > 0, 1, 0)" for c in CHANNELS) + " as channel_count"
)
# Zero where the customer has no row. A row without an e-mail belongs to no customer, so it
# adds nothing.
ZERO_FILLED = {
    r.name: f"cast(coalesce(if(email is null, null, {r.name}), 0) as {r.type.simpleString()}) "
    f"as {r.name}"
    for r in ROLLUPS
}


def channel_rollup(
    df: DataFrame, channel: Channel, *more: Column, keys: tuple[str, ...] = ("email",)
) -> DataFrame:
    """One row per e-mail, or other keys, of one channel: its roll-ups and any further
    aggregates."""
    measures = (f"{r.how}({r.source or '*'}) as {r.name}" for r in channel.rollups)
    return df.groupBy(*keys).agg(*map(F.expr, measures), *more)


def completed(df: DataFrame) -> DataFrame:
    """Adds what is missing to a frame with one row per e-mail and some channels' roll-ups:
    zeros, the list of channels and their count."""
    absent = [
        f"cast(null as {r.type.simpleString()}) as {r.name}"
        for r in ROLLUPS
        if r.name not in df.columns
    ]
    if absent:
        df = df.selectExpr("*", *absent)
    others = [c for c in df.columns if c not in ZERO_FILLED]
    return df.selectExpr(*others, *ZERO_FILLED.values()).selectExpr(
        "*", CHANNELS_USED, CHANNEL_COUNT
    )


def stacked(summaries: dict[str, DataFrame]) -> DataFrame:
    """The channels' summaries below each other, null where a channel has no such column."""
    return reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [df for _, df in described(summaries)],
    )


def combined(summaries: DataFrame, *more: Column, keys: tuple[str, ...] = ("email",)) -> DataFrame:
    """Rows with roll-ups, of any channels, merged by key: the roll-ups and further aggregates."""
    totals = [
        f"{_COMBINE[r.how]}({r.name}) as {r.name}" for r in ROLLUPS if r.name in summaries.columns
    ]
    return summaries.groupBy(*keys).agg(*map(F.expr, totals), *more)


def merge_channels(summaries: dict[str, DataFrame], *more: Column) -> DataFrame:
    """One row per e-mail out of one summary per channel, keyed by channel: the roll-ups
    and any further aggregates."""
    return completed(combined(stacked(summaries), *more))


def customer_activity(channels: Channels) -> DataFrame:
    """Every roll-up per e-mail, without the names: what statistics need."""
    return merge_channels({c.key: channel_rollup(df, c) for c, df in described(channels)})
