"""A fixed-size, repeatable sample of customers for each channel."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.schemas import IDENTITY, SAMPLE_SEEDS, SAMPLE_SIZE


# Up to so many rows a group, a limit by rank is a top-k that tasks keep before the shuffle.
RANKED_AT_MOST = 1000


def customer_sample(
    customers: DataFrame, size: int = SAMPLE_SIZE, seeds: dict[str, int] = SAMPLE_SEEDS
) -> DataFrame:
    """``size`` customers per channel without replacement, the same on any partitioning.

    Each customer's hash with the channel's seed decides. The customers are computed once: every
    row is drawn for all channels, a task keeps the ``size`` smallest draws of each, and these
    merge to the smallest of all. Samples of more than `RANKED_AT_MOST` are one top-k per channel
    instead, since that is where the engine stops limiting by rank before it shuffles.
    """
    known = customers.filter("email is not null").select(*IDENTITY)
    order = Window.partitionBy("channel").orderBy("draw", "email")
    position = F.row_number().over(order)

    def draw(seed: int):
        return F.md5(F.concat("email", F.lit(f":{seed}")))

    if size <= RANKED_AT_MOST:
        draws = F.array(*(
            F.struct(F.lit(channel).alias("channel"), draw(seed).alias("draw"))
            for channel, seed in seeds.items()
        ))
        drawn = known.select(*IDENTITY, F.inline(draws))
    else:
        drawn = reduce(DataFrame.unionByName, [
            known.select(F.lit(channel).alias("channel"), *IDENTITY, draw(seed).alias("draw"))
            .orderBy("draw", "email").limit(size)
            for channel, seed in seeds.items()
        ])
    return (
        drawn
        .withColumn("position", position)
        .filter(F.col("position") <= size)
        .select("channel", "position", *IDENTITY)
    )
