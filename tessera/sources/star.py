"""Channel tables derived from an order/line-item star schema plus an event log.

Used by the registered queries, the tests and the benchmark. The joins carry no hints:
dimension tables that are small get broadcast by their size, large ones are shuffled. Joins
take the tables' own columns and of a customer the name alone; what is derived from them is
wider and is worked out above the joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.functions.amounts import INSTALLMENT_AMOUNT, MONTHLY_PAYMENT
from tessera.schemas import CARD, MOBILE, PARTNER, WEB
from tessera.sources.tables import Channels, conform

# Stated, so that building a query starts no job to look into the files.
SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_suppkey bigint, l_linenumber int, l_extendedprice double, "
    "l_discount double, l_returnflag string, l_shipdate timestamp_ntz",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "nation": "n_nationkey int, n_name string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double",
}

EMAIL = "concat(lower(replace(c_name, '#', '.')), '@example.com')"

IDENTITY = (
    "concat('CUST', lpad(string(c_custkey), 9, '0')) as customer_id",
    f"{EMAIL} as email",
    "split_part(c_name, '#', 1) as first_name",
    "split_part(c_name, '#', 2) as last_name",
)


def varied(key: str) -> list[str]:
    """Identities as channels know them: some rows by guests without an e-mail, some with the
    e-mail in capitals, under a second customer id, or without a last name."""
    return [
        f"if({key} % 89 = 0, concat(customer_id, '7'), customer_id) as customer_id",
        f"case when {key} % 97 = 0 then null when {key} % 101 = 0 then upper(email) "
        "else email end as email",
        "first_name",
        f"if({key} % 83 = 0, null, last_name) as last_name",
    ]


CUSTOMER = ("customer_id", "email", "first_name", "last_name")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key and identity of every customer."""
    return customer_names(spark, sf_dir).selectExpr("c_custkey", *IDENTITY)


def customer_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the identity of a customer is derived from."""
    return read_table(spark, sf_dir, "customer").select("c_custkey", "c_name")


def mobile_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    rows = orders.join(customer_names(spark, sf_dir), "c_custkey").selectExpr(
        "o_orderkey as row_key",
        *IDENTITY,
        "concat('MOB-', o_orderkey) as order_id",
        "if(o_orderkey % 2 = 0, 'iOS', 'Android') as device_platform",
        "elt(int(o_orderkey % 4) + 1, '6.4.1', '6.5.0', '6.6.2', '7.0.0') as app_version",
        "substr(o_orderpriority, 3) as merchant_category",
        "elt(int(o_orderkey % 3) + 1, 'pay_in_4', '6mo_installments', '12mo_installments') "
        "as bnpl_plan",
        "case when o_orderkey % 50 = 7 then 0 when o_orderkey % 3 = 0 then 4 "
        "when o_orderkey % 3 = 1 then 6 else 12 end as installments",
        "cast(o_totalprice as decimal(10,2)) as order_amount",
        "case o_orderstatus when 'F' then 'completed' when 'O' then 'active' "
        "else 'late_payment' end as status",
        "o_orderdate as order_ts",
    )
    others = [c for c in rows.columns if c not in CUSTOMER]
    rows = rows.selectExpr(*others, *varied("row_key"))
    stored = f"if(row_key % 60 = 11, 1.00, {INSTALLMENT_AMOUNT}) as installment_amount"
    return conform(rows.selectExpr("*", stored), MOBILE)


def partner_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey as l_orderkey", "o_custkey as c_custkey"
    )
    partners = (
        read_table(spark, sf_dir, "supplier")
        .join(read_table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "s_nationkey"),
              "s_nationkey")
        .selectExpr("s_suppkey as l_suppkey", "s_name as partner_name",
                    "n_name as partner_segment")
    )
    rows = (
        read_table(spark, sf_dir, "lineitem")
        # The customers first: so each line item is shuffled once, by its order.
        .join(orders.join(customer_names(spark, sf_dir), "c_custkey"), "l_orderkey")
        .join(partners, "l_suppkey")
        .selectExpr("*", *IDENTITY)
        .selectExpr(
            "concat('PRT-', l_orderkey, '-', l_linenumber) as loan_id",
            *varied("(l_orderkey * 8 + l_linenumber)"),
            "partner_name", "partner_segment",
            "elt(l_linenumber % 3 + 1, 'widget', 'redirect', 'headless_api') "
            "as integration_type",
            "cast(l_extendedprice as decimal(10,2)) as principal_amount",
            "cast(l_discount * 100 as decimal(5,2)) as apr_pct",
            "case when l_orderkey % 70 = 4 then 0 when l_linenumber <= 2 then 3 "
            "when l_linenumber <= 4 then 6 else 12 end as term_months",
            "case l_returnflag when 'A' then 'approved' when 'N' then 'manual_review' "
            "else 'declined' end as approval_status",
            "date(l_shipdate) as originated_date",
        )
    )
    return conform(rows.selectExpr("*", f"{MONTHLY_PAYMENT} as monthly_payment"), PARTNER)


def web_applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = (
        read_table(spark, sf_dir, "events")
        .withColumnRenamed("user_id", "c_custkey")
        .join(customer_names(spark, sf_dir), "c_custkey")
        .selectExpr(
            "event_id as row_key",
            *IDENTITY,
            "concat('WEB-', event_id) as application_id",
            "elt(int(event_id % 6) + 1, 'google_ads', 'meta_ads', 'tiktok', 'organic', 'email', "
            "'referral') as utm_source",
            "elt(int(event_id % 4) + 1, 'medical', 'education', 'travel', 'wedding') "
            "as loan_purpose",
            "cast(value as decimal(10,2)) * 100 as requested_amount",
            "case when event_id % 40 = 9 then cast(value as decimal(10,2)) * 50 "
            "when event_type in ('signup', 'purchase', 'click') "
            "then cast(value as decimal(10,2)) * 80 else 0 end as funded_amount",
            "540 + event_id % 281 as credit_score",
            "if(event_id % 2 = 0, 'full_time', 'contractor') as employment_status",
            "18000 + event_id % 162000 as annual_income",
            "case event_type when 'error' then 'failed' when 'view' then 'manual_review' "
            "else 'passed' end as kyc_status",
            "date(ts) as applied_date",
        )
    )
    others = [c for c in rows.columns if c not in CUSTOMER]
    return conform(rows.selectExpr(*others, *varied("row_key")), WEB)


def card_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = (
        read_table(spark, sf_dir, "customer")
        .selectExpr("*", *IDENTITY)
        .selectExpr(
            "concat('CARD-', c_custkey) as account_id",
            *varied("c_custkey"),
            "c_mktsegment as card_partner",
            "10000 as credit_limit",
            "cast(c_acctbal as decimal(12,2)) as current_balance",
            "bround(cast(round(c_acctbal * 100) as decimal(12,0)) / 10000, 2) "
            "+ if(c_custkey % 7 = 0, 30, 0) as utilization_pct",
            "elt(c_nationkey % 4 + 1, 'standard', 'silver', 'gold', 'platinum') as rewards_tier",
            "elt(int(c_custkey % 4) + 1, 'pays_full', 'pays_minimum', 'revolves', 'behind') "
            "as payment_behavior",
            "case when c_custkey % 28 = 3 then 45 when c_custkey % 20 = 1 then 15 "
            "when c_custkey % 4 = 3 then 30 * (1 + c_custkey % 3) else 0 end "
            "as delinquency_days",
            "case when c_custkey % 6 < 4 then 'active' when c_custkey % 6 = 4 then 'frozen' "
            "else 'closed' end as account_status",
            "date '2024-06-01' as account_opened",
        )
    )
    return conform(rows, CARD)


def channels_from_star(spark: SparkSession, sf_dir: str) -> Channels:
    return {
        MOBILE.key: mobile_orders(spark, sf_dir),
        PARTNER.key: partner_loans(spark, sf_dir),
        WEB.key: web_applications(spark, sf_dir),
        CARD.key: card_accounts(spark, sf_dir),
    }
