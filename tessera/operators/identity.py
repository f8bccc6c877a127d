"""Who the customers are: one identity row per exact e-mail."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.schemas import IDENTITY
from tessera.sources.tables import Channels, described

NAME_PARTS = tuple(c for c in IDENTITY if c != "email")


def identity_union(channels: Channels) -> DataFrame:
    """The distinct identities seen in any channel."""
    rows = [df.select(*IDENTITY) for _, df in described(channels)]
    return reduce(DataFrame.unionByName, rows).distinct()


def smallest_identity():
    """One whole row per e-mail, never a mix of two; independent of the row order."""
    return F.min(F.struct(*NAME_PARTS)).alias("identity")


def identity_resolution(channels: Channels) -> DataFrame:
    """One identity per e-mail, in two steps: rows are hashed together by the whole identity,
    then the smallest is picked among the few that an e-mail has, which alone are sorted."""
    rows = reduce(DataFrame.unionByName, [df.select(*IDENTITY) for _, df in described(channels)])
    # Without the count the optimizer would leave out the first step and sort every row.
    known = rows.groupBy(*IDENTITY).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 0")
    return (
        known
        .groupBy("email")
        .agg(smallest_identity())
        .select("identity.customer_id", "email", "identity.first_name", "identity.last_name")
    )
