"""Event histories: rows to arrays per customer, and arrays back to rows for display.

An array lives in one row of one task. `event_histories` gives one row per customer;
`event_pages` gives every history in pages of a stated size; `page_directory` stores them
so that a page can be opened alone.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import display
from tessera.schemas import CARD, MOBILE, PARTNER, WEB, Channel
from tessera.sources.tables import Channels, described

LOT = 65536  # runs of copies that are numbered in one array


def event_struct(channel: Channel) -> Column:
    fields = (
        f"'{f.name}', cast({f.name} as {f.dataType.simpleString()})" for f in channel.event_type
    )
    return F.expr(f"named_struct({', '.join(fields)})")


def collect_events(channel: Channel) -> Column:
    """Ordered by id, then by the other fields. Empty, never null, if there are none.

    Rows without an e-mail belong to nobody's history.
    """
    event = F.when(F.col("email").isNotNull(), event_struct(channel))
    return F.sort_array(F.collect_list(event)).alias(channel.events)


def merge_events(channel: Channel) -> Column:
    """The array out of the channels' merged summaries, only one of which has it."""
    return F.flatten(F.collect_list(channel.events)).alias(channel.events)


def no_events(channel: Channel) -> Column:
    return F.array().cast(T.ArrayType(channel.event_type)).alias(channel.events)


def event_histories(channels: Channels) -> DataFrame:
    """``email`` and the event arrays of the given channels, without the roll-ups: one row per
    customer, whatever the length of the history, so a row must fit into a task's memory.
    `event_pages` is the form without that bound."""
    known = {c.key: df.filter("email is not null") for c, df in described(channels)}
    arrays = [df.groupBy("email").agg(collect_events(c)) for c, df in described(known)]
    if len(arrays) == 1:
        return arrays[0]
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), arrays)
    return merged.groupBy("email").agg(*(merge_events(c) for c, _ in described(known)))


def counted_events(df: DataFrame, channel: Channel) -> DataFrame:
    """(email, event, copies): equal events of a customer are one row with their number, so that
    no two rows are alike and any number of copies is a row per map task."""
    return (
        df.filter("email is not null")
        .groupBy("email", event_struct(channel).alias("event"))
        .agg(F.count(F.lit(1)).alias("copies"))
    )


def _runs(counted: DataFrame, most: int) -> DataFrame:
    """The copies of an event dealt to rows of at most ``most``, numbered by ``run``. In two
    steps, since the numbers of very many runs would not fit into one array."""
    last = F.floor((F.col("copies") - 1) / most)
    lots = counted.withColumn("lot", F.explode(F.sequence(F.lit(0).cast("long"), last, F.lit(LOT))))
    within = F.sequence(F.col("lot"), F.least(F.col("lot") + (LOT - 1), last))
    rest = F.col("copies") - F.col("run") * most
    return lots.withColumn("run", F.explode(within)).select(
        "email", "event", "run", F.least(F.lit(most), rest).alias("copies")
    )


def event_pages(df: DataFrame, channel: Channel, page_events: int) -> DataFrame:
    """(email, event_page, events): each history in pages of at most ``page_events`` events, in
    order of id and then of the other fields, the pages in order of their number. The same
    for every customer.

    No task needs a whole history. Range partitions by e-mail and event cut a hot e-mail into
    several, and each partition cuts its part into pages. The page's number is the partition's,
    shifted, plus the page's within it; it is unique for an e-mail and says nothing else. Equal
    events are counted and told apart by number, so that copies spread over the partitions and
    a task that is run again, on rows in any order, gives the same pages.
    """
    check_page(page_events)
    runs = _runs(counted_events(df, channel), page_events)
    ranged = runs.repartitionByRange("email", "event", "run").withColumn(
        "part", F.spark_partition_id().cast("long")
    )
    before = (
        Window.partitionBy("email", "part").orderBy("event", "run")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = ranged.withColumn("start", F.coalesce(F.sum("copies").over(before), F.lit(0)))
    return (
        _on_pages(placed, page_events)
        .groupBy("email", "part", "page")
        .agg(F.sort_array(F.flatten(F.collect_list(
            F.array_repeat("event", F.col("taken").cast("int"))
        ))).alias("events"))
        .select("email", (F.shiftleft("part", 32) + F.col("page")).alias("event_page"), "events")
    )


def check_page(page_events: int) -> None:
    if page_events < 1:
        raise ValueError("page_events must be 1 or more")


def _on_pages(placed: DataFrame, page_events: int) -> DataFrame:
    """Rows with ``start``, the events before them, and ``copies``: one for each ``page`` that they
    reach, with ``taken``, the copies on it. For rows that reach few pages."""
    end = F.col("start") + F.col("copies")
    pages = F.sequence(F.floor(F.col("start") / page_events), F.floor((end - 1) / page_events))
    on_page = F.least(end, (F.col("page") + 1) * page_events) - F.greatest(
        F.col("start"), F.col("page") * page_events
    )
    return placed.withColumn("page", F.explode(pages)).withColumn("taken", on_page)


def event_rows(df: DataFrame, channel: Channel) -> DataFrame:
    """The channel's events as rows, straight from its table: no shuffle."""
    fields = event_struct(channel).alias("event")
    return df.filter("email is not null").select("email", fields).select("email", "event.*")


def exploded_events(profiles: DataFrame, channel: Channel) -> DataFrame:
    """The channel's events as rows, from the arrays; no row for an empty array."""
    return profiles.select("email", F.inline(channel.events))


def _section(rows: DataFrame, **columns: Column) -> DataFrame:
    return rows.select("email", *(value.alias(name) for name, value in columns.items()))


def _mobile_section(rows):
    return _section(
        rows,
        order_id=F.col("order_id"),
        merchant_category=F.col("merchant_category"),
        bnpl_plan=F.col("bnpl_plan"),
        amount_text=display.whole_dollars("order_amount"),
        status=F.col("status"),
        status_severity=display.severity("status"),
        date_text=display.day_text("order_ts"),
        order_ts=F.col("order_ts"),
    )


def _partner_section(rows):
    return _section(
        rows,
        loan_id=F.col("loan_id"),
        partner_name=F.col("partner_name"),
        principal_text=display.whole_dollars("principal_amount"),
        apr_text=display.percent_text("apr_pct"),
        term_text=display.months_text("term_months"),
        approval_status=F.col("approval_status"),
        status_severity=display.severity("approval_status"),
        date_text=display.day_text("originated_date"),
    )


def _web_section(rows):
    return _section(
        rows,
        application_id=F.col("application_id"),
        utm_source=F.col("utm_source"),
        loan_purpose=F.col("loan_purpose"),
        requested_text=display.whole_dollars("requested_amount"),
        funded_text=display.whole_dollars("funded_amount"),
        credit_score=F.col("credit_score"),
        kyc_status=F.col("kyc_status"),
        status_severity=display.severity("kyc_status"),
        date_text=display.day_text("applied_date"),
    )


def _card_section(rows):
    return _section(
        rows,
        account_id=F.col("account_id"),
        card_partner=F.col("card_partner"),
        limit_text=display.whole_dollars("credit_limit"),
        balance_text=display.whole_dollars("current_balance"),
        utilization_text=display.percent_text("utilization_pct"),
        rewards_tier=F.col("rewards_tier"),
        payment_behavior=F.col("payment_behavior"),
        behavior_severity=display.severity("payment_behavior"),
        account_status=F.col("account_status"),
        status_severity=display.severity("account_status"),
        date_text=display.day_text("account_opened"),
    )


_SECTIONS = {
    MOBILE.key: _mobile_section,
    PARTNER.key: _partner_section,
    WEB.key: _web_section,
    CARD.key: _card_section,
}


def event_view(rows: DataFrame, channel: Channel) -> DataFrame:
    """Event rows as the channel's section of a profile shows them."""
    return _SECTIONS[channel.key](rows)


def event_counts(histories: DataFrame, channels=(MOBILE, PARTNER, WEB, CARD)) -> DataFrame:
    """The length of each array per customer."""
    sizes = [F.size(c.events).cast("bigint").alias(f"{c.key}_events") for c in channels]
    return histories.select("email", *sizes)


def status_severity_summary(channels: Channels) -> DataFrame:
    """How often each status occurs, with its severity.

    Counted per status word before the severity is worked out, on a handful of rows.
    """
    counted = []
    for channel, df in described(channels):
        kinds = F.explode(
            F.array(*(
                F.struct(F.lit(f).alias("field"), F.col(f).alias("status"))
                for f in channel.status_fields
            ))
        )
        counted.append(
            df.select(kinds.alias("s"))
            .groupBy(F.lit(channel.key).alias("channel"), "s.field", "s.status")
            .agg(F.count(F.lit(1)).alias("events"))
        )
    return reduce(DataFrame.unionByName, counted).select(
        "channel", "field", "status", display.severity("status").alias("severity"), "events"
    )
