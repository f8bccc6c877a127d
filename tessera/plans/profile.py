"""Building the profile: flat (roll-ups only) and nested (with event histories)."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.events import collect_events, merge_events, no_events
from tessera.operators.identity import NAME_PARTS, identity_resolution, smallest_identity
from tessera.operators.rollups import (
    channel_rollup,
    combined,
    completed,
    customer_activity,
    merge_channels,
    stacked,
)
from tessera.operators.serve import DEFAULT_LIMIT, check_limit
from tessera.schemas import CHANNELS, FLAT_COLUMNS, IDENTITY, PROFILE_COLUMNS, SUMMARY_COLUMNS
from tessera.sources.tables import Channels, described


def profile_flat_joined(channels: Channels) -> DataFrame:
    """The readable form: identities left-joined to one aggregate per channel.

    Reads each channel twice. `profile_flat` gives the same rows from one reading.
    """
    profile = identity_resolution(channels)
    for channel, df in described(channels):
        profile = profile.join(channel_rollup(df, channel), "email", "left")
    return completed(profile).select(*FLAT_COLUMNS)


def profile_flat(channels: Channels) -> DataFrame:
    """One row per e-mail with every roll-up: each channel read once, no join, and two levels
    of aggregation. Rows are hashed together by the whole identity, within a channel and then,
    without another shuffle, over the channels. The few identities of an e-mail are shuffled
    once more to pick the smallest; only these rows are sorted, which text needs.
    """
    summaries = {c.key: channel_rollup(df, c, keys=IDENTITY) for c, df in described(channels)}
    identities = combined(stacked(summaries), keys=IDENTITY)
    merged = completed(combined(identities, smallest_identity()))
    return merged.select("*", "identity.*").select(*FLAT_COLUMNS)


def customers_top(channels: Channels, limit: int = DEFAULT_LIMIT) -> DataFrame:
    """The rows of `serve.customers_top` straight from the channels, names last: the list is
    ranked on `customer_activity`, which needs none, and identities are resolved for its e-mails
    alone. These are at most `serve.MAX_LIMIT`, so they can be sent to every task.
    """
    check_limit(limit)
    ranking = (F.col("channel_count").desc(), "email")
    shown = [c for c in SUMMARY_COLUMNS if c not in NAME_PARTS]
    top = customer_activity(channels).select(*shown).orderBy(*ranking).limit(limit)
    rows = reduce(DataFrame.unionByName, [
        df.select(F.col("email").alias("known"), *NAME_PARTS) for _, df in described(channels)
    ])
    wanted = rows.join(F.broadcast(top), F.col("known").eqNullSafe(F.col("email")))
    # In two steps like `identity_resolution`: only distinct identities are sorted.
    known = wanted.groupBy(*shown, *NAME_PARTS).agg(F.count(F.lit(1)).alias("rows"))
    found = known.filter("rows > 0").groupBy(*shown).agg(smallest_identity())
    return (
        found.select("*", "identity.*").select(*SUMMARY_COLUMNS).orderBy(*ranking).limit(limit)
    )


def profile_nested(channels: Channels, as_of: datetime | str | None = None) -> DataFrame:
    """The full profile: one row per e-mail with the roll-ups and every event.

    A customer's whole history is one row of one task, however long it is. Where histories
    may outgrow that, `profile_flat` beside `event_pages` holds the same in bounded rows.
    """
    identity = smallest_identity()
    summaries = {
        c.key: channel_rollup(df, c, identity, collect_events(c)) for c, df in described(channels)
    }
    merged = merge_channels(
        summaries,
        F.min("identity").alias("identity"),
        *(merge_events(c) for c, _ in described(channels)),
    )
    absent = {c.events: no_events(c) for c in CHANNELS if c.key not in channels}
    stamp = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    return (
        merged.select("*", "identity.*")
        .withColumns({**absent, "profile_last_updated": stamp})
        .select(*PROFILE_COLUMNS)
    )
