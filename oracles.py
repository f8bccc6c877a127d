"""SQL answers to the registered queries, written for DuckDB over the same tables.

They share no code with the Spark side. Halves are rounded to even on whole numbers, since
DuckDB divides decimals as floats.
"""

from __future__ import annotations

VIEWS = {
    "mobile": """
SELECT 'MOB-' || cast(o_orderkey as varchar(20)) AS order_id,
  CASE WHEN o_orderkey % 89 = 0 THEN 'CUST' || lpad(cast(c_custkey as varchar(20)), 9, '0') || '7'
    ELSE 'CUST' || lpad(cast(c_custkey as varchar(20)), 9, '0') END AS customer_id,
  CASE WHEN o_orderkey % 97 = 0 THEN NULL
    WHEN o_orderkey % 101 = 0 THEN upper(replace(c_name, '#', '.') || '@example.com')
    ELSE lower(replace(c_name, '#', '.')) || '@example.com' END AS email,
  split_part(c_name, '#', 1) AS first_name,
  CASE WHEN o_orderkey % 83 <> 0 THEN split_part(c_name, '#', 2) END AS last_name,
  CASE WHEN o_orderkey % 2 = 0 THEN 'iOS' ELSE 'Android' END AS device_platform,
  CASE o_orderkey % 4 WHEN 0 THEN '6.4.1' WHEN 1 THEN '6.5.0' WHEN 2 THEN '6.6.2'
    ELSE '7.0.0' END AS app_version,
  substr(o_orderpriority, 3) AS merchant_category,
  CASE o_orderkey % 3 WHEN 0 THEN 'pay_in_4' WHEN 1 THEN '6mo_installments'
    ELSE '12mo_installments' END AS bnpl_plan,
  cast(CASE WHEN o_orderkey % 50 = 7 THEN 0 WHEN o_orderkey % 3 = 0 THEN 4
    WHEN o_orderkey % 3 = 1 THEN 6 ELSE 12 END as int) AS installments,
  cast(o_totalprice as decimal(10,2)) AS order_amount,
  CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'active'
    ELSE 'late_payment' END AS status,
  o_orderdate AS order_ts, o_orderkey % 60 = 11 AS stored_wrong
FROM orders JOIN customer ON o_custkey = c_custkey""",
    "partner": """
SELECT 'PRT-' || cast(l_orderkey as varchar(20)) || '-' || cast(l_linenumber as varchar(20))
    AS loan_id,
  CASE WHEN (l_orderkey * 8 + l_linenumber) % 89 = 0 THEN 'CUST' || lpad(cast(c_custkey as varchar(20)), 9, '0') || '7'
    ELSE 'CUST' || lpad(cast(c_custkey as varchar(20)), 9, '0') END AS customer_id,
  CASE WHEN (l_orderkey * 8 + l_linenumber) % 97 = 0 THEN NULL
    WHEN (l_orderkey * 8 + l_linenumber) % 101 = 0 THEN upper(replace(c_name, '#', '.') || '@example.com')
    ELSE lower(replace(c_name, '#', '.')) || '@example.com' END AS email,
  split_part(c_name, '#', 1) AS first_name,
  CASE WHEN (l_orderkey * 8 + l_linenumber) % 83 <> 0 THEN split_part(c_name, '#', 2) END AS last_name,
  s_name AS partner_name, n_name AS partner_segment,
  CASE l_linenumber % 3 WHEN 0 THEN 'widget' WHEN 1 THEN 'redirect'
    ELSE 'headless_api' END AS integration_type,
  cast(l_extendedprice as decimal(10,2)) AS principal_amount,
  cast(l_discount * 100 as decimal(5,2)) AS apr_pct,
  cast(CASE WHEN l_orderkey % 70 = 4 THEN 0 WHEN l_linenumber <= 2 THEN 3
    WHEN l_linenumber <= 4 THEN 6 ELSE 12 END as int)
    AS term_months,
  CASE l_returnflag WHEN 'A' THEN 'approved' WHEN 'N' THEN 'manual_review'
    ELSE 'declined' END AS approval_status,
  cast(l_shipdate as date) AS originated_date
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey""",
    "web": """
SELECT 'WEB-' || cast(event_id as varchar(20)) AS application_id,
  CASE WHEN event_id % 89 = 0 THEN 'CUST' || lpad(cast(c_custkey as varchar(20)), 9, '0') || '7'
    ELSE 'CUST' || lpad(cast(c_custkey as varchar(20)), 9, '0') END AS customer_id,
  CASE WHEN event_id % 97 = 0 THEN NULL
    WHEN event_id % 101 = 0 THEN upper(replace(c_name, '#', '.') || '@example.com')
    ELSE lower(replace(c_name, '#', '.')) || '@example.com' END AS email,
  split_part(c_name, '#', 1) AS first_name,
  CASE WHEN event_id % 83 <> 0 THEN split_part(c_name, '#', 2) END AS last_name,
  CASE event_id % 6 WHEN 0 THEN 'google_ads' WHEN 1 THEN 'meta_ads' WHEN 2 THEN 'tiktok'
    WHEN 3 THEN 'organic' WHEN 4 THEN 'email' ELSE 'referral' END AS utm_source,
  CASE event_id % 4 WHEN 0 THEN 'medical' WHEN 1 THEN 'education' WHEN 2 THEN 'travel'
    ELSE 'wedding' END AS loan_purpose,
  cast(cast(value as decimal(10,2)) * 100 as decimal(12,2)) AS requested_amount,
  cast(CASE WHEN event_id % 40 = 9 THEN cast(value as decimal(10,2)) * 50
    WHEN event_type IN ('signup','purchase','click') THEN cast(value as decimal(10,2)) * 80 ELSE 0 END as decimal(12,2)) AS funded_amount,
  cast(540 + event_id % 281 as int) AS credit_score,
  CASE event_id % 2 WHEN 0 THEN 'full_time' ELSE 'contractor' END AS employment_status,
  cast(18000 + event_id % 162000 as decimal(12,2)) AS annual_income,
  CASE event_type WHEN 'error' THEN 'failed' WHEN 'view' THEN 'manual_review'
    ELSE 'passed' END AS kyc_status,
  cast(ts as date) AS applied_date
FROM events JOIN customer ON user_id = c_custkey""",
    "card": """
SELECT 'CARD-' || cast(c_custkey as varchar(20)) AS account_id,
  CASE WHEN c_custkey % 89 = 0 THEN 'CUST' || lpad(cast(c_custkey as varchar(20)), 9, '0') || '7'
    ELSE 'CUST' || lpad(cast(c_custkey as varchar(20)), 9, '0') END AS customer_id,
  CASE WHEN c_custkey % 97 = 0 THEN NULL
    WHEN c_custkey % 101 = 0 THEN upper(replace(c_name, '#', '.') || '@example.com')
    ELSE lower(replace(c_name, '#', '.')) || '@example.com' END AS email,
  split_part(c_name, '#', 1) AS first_name,
  CASE WHEN c_custkey % 83 <> 0 THEN split_part(c_name, '#', 2) END AS last_name,
  c_mktsegment AS card_partner, cast(10000 as decimal(12,2)) AS credit_limit,
  cast(c_acctbal as decimal(12,2)) AS current_balance,
  cast((q + CASE WHEN r > 50 OR (r = 50 AND q % 2 <> 0) THEN 1
      WHEN r < -50 OR (r = -50 AND q % 2 <> 0) THEN -1 ELSE 0 END
    + CASE WHEN c_custkey % 7 = 0 THEN 3000 ELSE 0 END)
    * cast(0.01 as decimal(3,2)) as decimal(5,2)) AS utilization_pct,
  CASE c_nationkey % 4 WHEN 0 THEN 'standard' WHEN 1 THEN 'silver' WHEN 2 THEN 'gold'
    ELSE 'platinum' END AS rewards_tier,
  CASE c_custkey % 4 WHEN 0 THEN 'pays_full' WHEN 1 THEN 'pays_minimum' WHEN 2 THEN 'revolves'
    ELSE 'behind' END AS payment_behavior,
  cast(CASE WHEN c_custkey % 28 = 3 THEN 45 WHEN c_custkey % 20 = 1 THEN 15
    WHEN c_custkey % 4 = 3 THEN 30 * (1 + c_custkey % 3) ELSE 0 END as int)
    AS delinquency_days,
  CASE WHEN c_custkey % 6 < 4 THEN 'active' WHEN c_custkey % 6 = 4 THEN 'frozen'
    ELSE 'closed' END AS account_status,
  cast('2024-06-01' as date) AS account_opened
FROM (SELECT *, cast((w - w % 100) / 100 as int) AS q, cast(w % 100 as int) AS r
      FROM (SELECT *, cast(round(c_acctbal * 100) as int) AS w FROM customer) a) b""",
    "union_ids": """
SELECT customer_id, email, first_name, last_name FROM mobile
UNION SELECT customer_id, email, first_name, last_name FROM partner
UNION SELECT customer_id, email, first_name, last_name FROM web
UNION SELECT customer_id, email, first_name, last_name FROM card""",
    "ids": """
SELECT customer_id, email, first_name, last_name FROM union_ids
QUALIFY row_number() OVER (PARTITION BY email ORDER BY customer_id NULLS FIRST,
  first_name NULLS FIRST, last_name NULLS FIRST) = 1""",
    "m": "SELECT email, count(*) AS n, sum(order_amount) AS s FROM mobile GROUP BY email",
    "p": "SELECT email, count(*) AS n, sum(principal_amount) AS s FROM partner GROUP BY email",
    "w": """
SELECT email, count(*) AS n, sum(funded_amount) AS s, max(credit_score) AS x
FROM web GROUP BY email""",
    "c": """
SELECT email, count(*) AS n, sum(credit_limit) AS l, sum(current_balance) AS s,
  max(delinquency_days) AS x FROM card GROUP BY email""",
    "stacked": """
SELECT email, 'mobile_app' AS channel, order_amount AS amount, NULL AS other, NULL AS top
FROM mobile
UNION ALL SELECT email, 'partner_checkout', principal_amount, NULL, NULL FROM partner
UNION ALL SELECT email, 'web_portal', funded_amount, NULL, credit_score FROM web
UNION ALL SELECT email, 'cobranded_card', current_balance, credit_limit, delinquency_days
FROM card""",
    "totals": """
SELECT email,
  count(*) FILTER (channel = 'mobile_app') AS mobile_app_order_count,
  coalesce(sum(amount) FILTER (channel = 'mobile_app'), 0) AS mobile_app_total_spend,
  count(*) FILTER (channel = 'partner_checkout') AS partner_loan_count,
  coalesce(sum(amount) FILTER (channel = 'partner_checkout'), 0) AS partner_total_principal,
  count(*) FILTER (channel = 'web_portal') AS web_application_count,
  coalesce(sum(amount) FILTER (channel = 'web_portal'), 0) AS web_total_funded,
  coalesce(max(top) FILTER (channel = 'web_portal'), 0) AS web_max_credit_score,
  count(*) FILTER (channel = 'cobranded_card') AS card_account_count,
  coalesce(sum(other) FILTER (channel = 'cobranded_card'), 0) AS card_total_credit_limit,
  coalesce(sum(amount) FILTER (channel = 'cobranded_card'), 0) AS card_total_balance,
  coalesce(max(top) FILTER (channel = 'cobranded_card'), 0) AS card_max_delinquency_days,
  list_filter(['mobile_app', 'partner_checkout', 'web_portal', 'cobranded_card'],
    lambda c: list_contains(list(DISTINCT channel), c)) AS used
FROM stacked WHERE email IS NOT NULL GROUP BY email""",
    "profile": """
SELECT email, customer_id, first_name, last_name, t.* EXCLUDE (email, used),
  array_to_string(used, ',') AS channels_used, cast(len(used) as int) AS channel_count
FROM ids JOIN totals t USING (email)
UNION ALL SELECT email, customer_id, first_name, last_name, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0,
  '', 0 FROM ids WHERE email IS NULL""",
    "member": """
SELECT email, channel FROM profile, unnest(string_split(channels_used, ',')) AS u(channel)
WHERE channels_used <> ''""",
    "wanted": """
SELECT upper(replace(c_name, '#', '.') || CASE WHEN c_custkey % 3 = 0 THEN '@other.com'
  ELSE '@example.com' END) AS email FROM customer""",
}

NEEDS = {
    "union_ids": ("mobile", "partner", "web", "card"),
    "ids": ("union_ids",),
    "m": ("mobile",),
    "p": ("partner",),
    "w": ("web",),
    "c": ("card",),
    "stacked": ("mobile", "partner", "web", "card"),
    "totals": ("stacked",),
    "profile": ("ids", "totals"),
    "member": ("profile",),
}


def _with(views: str, body: str) -> str:
    wanted: list[str] = []

    def add(name):
        for needed in NEEDS.get(name, ()):
            add(needed)
        if name not in wanted:
            wanted.append(name)

    for name in views.split():
        add(name)
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n]})" for n in wanted) + "\n" + body.strip()


def _half_even(num: str, den: str) -> str:
    q, r = f"(({num}) // ({den}))", f"(({num}) % ({den}))"
    return (
        f"({q} + CASE WHEN 2 * {r} > ({den}) OR (2 * {r} = ({den}) AND {q} % 2 = 1) "
        "THEN 1 ELSE 0 END)"
    )


def _cents(amount: str) -> str:
    return f"cast({amount} * 100 as bigint)"


def _severity(status: str) -> str:
    s = f"lower({status})"
    return f"""CASE WHEN {s} LIKE '%late%' OR {s} LIKE '%declined%' OR {s} LIKE '%failed%'
    OR {s} IN ('behind', 'frozen', 'closed') THEN 'bad'
    WHEN {s} LIKE '%review%' OR {s} IN ('pays_minimum', 'revolves') THEN 'warn'
    ELSE 'ok' END"""


def _money(amount: str) -> str:
    c = f"cast({amount} * 100 as bigint)"
    return (
        f"CASE WHEN {c} < 0 THEN '-' ELSE '' END || '$' || "
        f"format('{{:,}}', (abs({c}) + 50) // 100)"
    )


def _percent(number: str) -> str:
    text = f"cast(cast({number} as decimal(5,2)) as varchar)"
    return f"rtrim(rtrim({text}, '0'), '.') || '%'"


def _label(key: str) -> str:
    return (
        f"CASE {key} WHEN 'mobile_app' THEN 'Mobile App' WHEN 'partner_checkout' THEN "
        f"'Partner Checkout' WHEN 'web_portal' THEN 'Web Portal' WHEN 'cobranded_card' THEN "
        f"'Co-branded Card' ELSE {key} END"
    )


def _rules(channel: str, view: str, rules: dict[str, str]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{channel}' AS channel, '{rule}' AS rule, count(*) AS rows_checked, "
        f"count(*) FILTER (WHERE {broken}) AS violations FROM {view}"
        for rule, broken in rules.items()
    )


FLAT = """customer_id, email, first_name, last_name, mobile_app_order_count,
  cast(mobile_app_total_spend as double) AS mobile_app_total_spend, partner_loan_count,
  cast(partner_total_principal as double) AS partner_total_principal, web_application_count,
  cast(web_total_funded as double) AS web_total_funded, web_max_credit_score,
  card_account_count, cast(card_total_credit_limit as double) AS card_total_credit_limit,
  cast(card_total_balance as double) AS card_total_balance, card_max_delinquency_days,
  channels_used, channel_count"""

SUMMARY = """customer_id, email, first_name, last_name, channel_count, channels_used,
  mobile_app_order_count, partner_loan_count, web_application_count, card_account_count"""

STATS = """SELECT count(DISTINCT email) + count(DISTINCT 1) FILTER (email IS NULL)
    AS total_customers,
  count(DISTINCT email) FILTER (several) AS multi_channel_customers,
  count(*) FILTER (channel = 'mobile_app' AND email IS NOT NULL) AS total_mobile_orders,
  count(*) FILTER (channel = 'partner_checkout' AND email IS NOT NULL) AS total_partner_loans,
  count(*) FILTER (channel = 'web_portal' AND email IS NOT NULL) AS total_web_applications,
  count(*) FILTER (channel = 'cobranded_card' AND email IS NOT NULL) AS total_card_accounts,
  sum(amount) FILTER (channel = 'mobile_app' AND email IS NOT NULL) AS total_mobile_spend,
  sum(amount) FILTER (channel = 'partner_checkout' AND email IS NOT NULL)
    AS total_partner_principal,
  sum(amount) FILTER (channel = 'web_portal' AND email IS NOT NULL) AS total_web_funded,
  sum(amount) FILTER (channel = 'cobranded_card' AND email IS NOT NULL) AS total_card_balance
FROM (SELECT *, min(channel) OVER same <> max(channel) OVER same AS several
      FROM stacked WINDOW same AS (PARTITION BY email))"""

MOBILE_VIEW = f"""SELECT email, order_id, merchant_category, bnpl_plan,
  {_money("order_amount")} AS amount_text, status, {_severity("status")} AS status_severity,
  strftime(order_ts, '%Y-%m-%d') AS date_text,
  strftime(order_ts, '%Y-%m-%d %H:%M:%S') AS order_ts FROM mobile
  WHERE email IS NOT NULL"""

PARTNER_VIEW = f"""SELECT email, loan_id, partner_name,
  {_money("principal_amount")} AS principal_text, {_percent("apr_pct")} AS apr_text,
  cast(term_months as varchar) || 'mo' AS term_text, approval_status,
  {_severity("approval_status")} AS status_severity,
  strftime(originated_date, '%Y-%m-%d') AS date_text FROM partner
  WHERE email IS NOT NULL"""

WEB_VIEW = f"""SELECT email, application_id, utm_source, loan_purpose,
  {_money("requested_amount")} AS requested_text, {_money("funded_amount")} AS funded_text,
  credit_score, kyc_status, {_severity("kyc_status")} AS status_severity,
  strftime(applied_date, '%Y-%m-%d') AS date_text FROM web
  WHERE email IS NOT NULL"""

CARD_VIEW = f"""SELECT email, account_id, card_partner, {_money("credit_limit")} AS limit_text,
  {_money("current_balance")} AS balance_text,
  {_percent("utilization_pct")} AS utilization_text, rewards_tier, payment_behavior,
  {_severity("payment_behavior")} AS behavior_severity, account_status,
  {_severity("account_status")} AS status_severity,
  strftime(account_opened, '%Y-%m-%d') AS date_text FROM card
  WHERE email IS NOT NULL"""

_STATUSES = (
    ("mobile_app", "mobile", "status"),
    ("partner_checkout", "partner", "approval_status"),
    ("web_portal", "web", "kyc_status"),
    ("cobranded_card", "card", "payment_behavior"),
    ("cobranded_card", "card", "account_status"),
)

# The columns of each channel.
_COLUMNS = {
    "mobile": (
        "order_id", "customer_id", "email", "first_name", "last_name", "device_platform",
        "app_version", "merchant_category", "bnpl_plan", "installments", "order_amount",
        "installment_amount", "status", "order_ts",
    ),
    "partner": (
        "loan_id", "customer_id", "email", "first_name", "last_name", "partner_name",
        "partner_segment", "integration_type", "principal_amount", "apr_pct",
        "term_months", "monthly_payment", "approval_status", "originated_date",
    ),
    "web": (
        "application_id", "customer_id", "email", "first_name", "last_name", "utm_source",
        "loan_purpose", "requested_amount", "funded_amount", "credit_score",
        "employment_status", "annual_income", "kyc_status", "applied_date",
    ),
    "card": (
        "account_id", "customer_id", "email", "first_name", "last_name", "card_partner",
        "credit_limit", "current_balance", "utilization_pct", "rewards_tier",
        "payment_behavior", "delinquency_days", "account_status", "account_opened",
    ),
}
_CHANNEL = {
    "mobile": "mobile_app",
    "partner": "partner_checkout",
    "web": "web_portal",
    "card": "cobranded_card",
}
# Derived columns the views leave out, by the column they are null with.
_DERIVED = {
    "installment_amount": "(CASE WHEN installments <> 0 OR stored_wrong THEN 1 END)",
    "monthly_payment": "nullif(term_months, 0)",
}


def _in(column: str, *words: str) -> str:
    quoted = ", ".join(f"'{w}'" for w in words)
    return f"{column} NOT IN ({quoted})"


# The accepted words.
_ACCEPTED = "\nUNION ALL ".join((
    _rules("mobile_app", "mobile", {
        "device_platform": _in("device_platform", "iOS", "Android"),
        "app_version": _in("app_version", "6.4.1", "6.5.0", "6.6.2", "7.0.0"),
        "merchant_category": _in("merchant_category", "Electronics", "Apparel", "Home Goods",
                                 "Beauty", "Sports", "Travel"),
        "bnpl_plan": _in("bnpl_plan", "pay_in_4", "6mo_installments", "12mo_installments"),
        "status": _in("status", "completed", "active", "late_payment"),
    }),
    _rules("partner_checkout", "partner", {
        "integration_type": _in("integration_type", "widget", "redirect", "headless_api"),
        "term_months": "term_months NOT IN (3, 6, 9, 12, 18, 24)",
        "approval_status": _in("approval_status", "approved", "manual_review", "declined"),
        "partner_and_segment": """(partner_name, partner_segment) NOT IN (
  ('MercadoBuy', 'marketplace'), ('ElektroMart', 'electronics'), ('ModaPlus', 'fashion'),
  ('HogarTotal', 'home'), ('ViajaYa', 'travel'), ('DeporteMax', 'sports'),
  ('FarmaPlus', 'pharmacy'))""",
    }),
    _rules("web_portal", "web", {
        "utm_source": _in("utm_source", "google_ads", "meta_ads", "tiktok", "organic", "email",
                          "referral"),
        "loan_purpose": _in("loan_purpose", "debt_consolidation", "home_improvement",
                            "auto_repair", "medical", "education", "wedding", "travel",
                            "small_business"),
        "kyc_status": _in("kyc_status", "passed", "manual_review", "failed"),
        "employment_status": _in("employment_status", "full_time", "self_employed", "part_time",
                                 "contractor", "unemployed"),
    }),
    _rules("cobranded_card", "card", {
        "card_partner": _in(
            "card_partner", "PayLater MercadoBuy Visa", "PayLater ModaPlus Mastercard",
            "PayLater ElektroMart Visa", "PayLater ViajaYa World Elite"),
        "credit_limit": "credit_limit NOT IN (1500, 3000, 5000, 7500, 10000, 15000, 25000)",
        "rewards_tier": _in("rewards_tier", "standard", "silver", "gold", "platinum"),
        "payment_behavior": _in("payment_behavior", "pays_full", "pays_minimum", "revolves",
                                "behind"),
        "account_status": _in("account_status", "active", "frozen", "closed"),
    }),
))


def _id_rules(view: str, id_column: str, prefix: str) -> str:
    start = f"'{prefix}-' || customer_id || '-'"
    name = "lower(first_name) || '.' || lower(last_name)"
    rest = f"substr(email, length({name}) + 1)"
    return _rules(_CHANNEL[view], view, {
        id_column: f"NOT coalesce(starts_with({id_column}, {start}) AND "
        f"regexp_matches(substr({id_column}, length({start}) + 1), '^[0-9]{{3,}}$'), false)",
        "customer_id": "NOT coalesce(regexp_matches(customer_id, '^CUST[0-9]{4,}$'), false)",
        "email_names": f"NOT coalesce(starts_with(email, {name}), false)",
        "email": f"NOT coalesce(starts_with(email, {name}) AND "
        f"regexp_matches({rest}, '^[0-9]{{3,}}@[^@]+$'), false)",
    })


_IDS = "\nUNION ALL ".join((
    _id_rules("mobile", "order_id", "MOB"),
    _id_rules("partner", "loan_id", "PRT"),
    _id_rules("web", "application_id", "WEB"),
    _id_rules("card", "account_id", "CARD"),
))

_RANGES = "\nUNION ALL ".join((
    _rules("mobile_app", "mobile", {
        "order_ts": "order_ts NOT BETWEEN timestamp '2026-01-01' AND "
        "timestamp '2026-01-01' + interval 110 day + interval 1440 minute",
        "order_amount": "order_amount NOT BETWEEN 35 AND 1800",
    }),
    _rules("partner_checkout", "partner", {
        "originated_date": "originated_date NOT BETWEEN date '2025-11-01' AND "
        "date '2025-11-01' + 170",
        "principal_amount": "principal_amount NOT BETWEEN 150 AND 6500",
        "apr_pct": "apr_pct NOT BETWEEN 0 AND cast(28.5 as decimal(5,2))",
    }),
    _rules("web_portal", "web", {
        "applied_date": "applied_date NOT BETWEEN date '2025-09-01' AND date '2025-09-01' + 230",
        "requested_amount": "requested_amount NOT BETWEEN 500 AND 25000",
        "credit_score": "credit_score NOT BETWEEN 540 AND 820",
        "annual_income": "annual_income NOT BETWEEN 18000 AND 180000",
    }),
    _rules("cobranded_card", "card", {
        "account_opened": "account_opened NOT BETWEEN date '2024-06-01' AND "
        "date '2024-06-01' + 600",
        "utilization_pct": "utilization_pct NOT BETWEEN 0 AND 105",
        "current_balance": "current_balance < 0 OR "
        f"{_cents('current_balance')} > {_half_even(_cents('credit_limit') + ' * 105', '100')}",
    }),
))

_NULLS = "\nUNION ALL ".join(
    _rules(_CHANNEL[view], view, {c: f"{_DERIVED.get(c, c)} IS NULL" for c in columns})
    for view, columns in _COLUMNS.items()
)

_SEEDS = (
    "(VALUES ('mobile_app', 101), ('partner_checkout', 202), ('web_portal', 303), "
    "('cobranded_card', 404)) AS seeds(channel, seed)"
)


def _event_text(view: str, id_column: str, fields: str, order: str) -> str:
    parts = " || '|' || ".join(f.strip() for f in fields.split(";"))
    return (
        f"SELECT email, string_agg({parts}, ',' ORDER BY {id_column}, {order}) AS events "
        f"FROM {view} GROUP BY email"
    )


_JSON = f"""
SELECT profile.email, customer_id, first_name, last_name, channels_used, channel_count,
  mobile_app_order_count, cast(mobile_app_total_spend as double) AS mobile_app_total_spend,
  partner_loan_count, cast(partner_total_principal as double) AS partner_total_principal,
  web_application_count, cast(web_total_funded as double) AS web_total_funded,
  web_max_credit_score, card_account_count,
  cast(card_total_credit_limit as double) AS card_total_credit_limit,
  cast(card_total_balance as double) AS card_total_balance, card_max_delinquency_days,
  coalesce(me.events, '') AS mobile_app_events, coalesce(pe.events, '') AS partner_loan_events,
  coalesce(we.events, '') AS web_application_events,
  coalesce(ce.events, '') AS card_account_events,
  '2026-05-01T12:30:00+00:00' AS profile_last_updated
FROM profile
LEFT JOIN ({_event_text("mobile", "order_id",
    "order_id; merchant_category; bnpl_plan; cast(order_amount as varchar); status; "
    "strftime(order_ts, '%Y-%m-%d %H:%M:%S')",
    "merchant_category, bnpl_plan, order_amount, status, order_ts")}) me
  ON me.email = profile.email
LEFT JOIN ({_event_text("partner", "loan_id",
    "loan_id; partner_name; cast(principal_amount as varchar); cast(apr_pct as varchar); "
    "cast(term_months as varchar); approval_status; cast(originated_date as varchar)",
    "partner_name, principal_amount, apr_pct, term_months, approval_status, originated_date")}) pe
  ON pe.email = profile.email
LEFT JOIN ({_event_text("web", "application_id",
    "application_id; utm_source; loan_purpose; cast(requested_amount as varchar); "
    "cast(funded_amount as varchar); cast(credit_score as varchar); kyc_status; "
    "cast(applied_date as varchar)",
    "utm_source, loan_purpose, requested_amount, funded_amount, credit_score, kyc_status, "
    "applied_date")}) we
  ON we.email = profile.email
LEFT JOIN ({_event_text("card", "account_id",
    "account_id; card_partner; cast(credit_limit as varchar); "
    "cast(current_balance as varchar); cast(utilization_pct as varchar); rewards_tier; "
    "payment_behavior; cast(delinquency_days as varchar); account_status; "
    "cast(account_opened as varchar)",
    "card_partner, credit_limit, current_balance, utilization_pct, rewards_tier, "
    "payment_behavior, delinquency_days, account_status, account_opened")}) ce
  ON ce.email = profile.email"""

_TILES = f"""
SELECT 1 AS position, 'Customers' AS label, format('{{:,}}', total_customers) AS value FROM s
UNION ALL SELECT 2, 'Multi-channel', format('{{:,}}', multi_channel_customers) FROM s
UNION ALL SELECT 3, 'Mobile orders', format('{{:,}}', total_mobile_orders) FROM s
UNION ALL SELECT 4, 'Partner loans', format('{{:,}}', total_partner_loans) FROM s
UNION ALL SELECT 5, 'Web apps', format('{{:,}}', total_web_applications) FROM s
UNION ALL SELECT 6, 'Card accounts', format('{{:,}}', total_card_accounts) FROM s
UNION ALL SELECT 7, 'Mobile $', {_money("total_mobile_spend")} FROM s
UNION ALL SELECT 8, 'Partner $', {_money("total_partner_principal")} FROM s
UNION ALL SELECT 9, 'Web funded $', {_money("total_web_funded")} FROM s
UNION ALL SELECT 10, 'Card balance $', {_money("total_card_balance")} FROM s"""

_SECTIONS = """
SELECT email, 'mobile_app_events' AS section,
  cast(mobile_app_order_count as varchar) || ' events' AS events
FROM profile WHERE mobile_app_order_count > 0
UNION ALL SELECT email, 'partner_loan_events',
  cast(partner_loan_count as varchar) || ' events' FROM profile WHERE partner_loan_count > 0
UNION ALL SELECT email, 'web_application_events',
  cast(web_application_count as varchar) || ' events' FROM profile
  WHERE web_application_count > 0
UNION ALL SELECT email, 'card_account_events',
  cast(card_account_count as varchar) || ' events' FROM profile WHERE card_account_count > 0"""


_FULL_NAME = "lower(first_name || ' ' || last_name)"
# The searches through the index, as scans.
_INDEXED = {
    "customers_search_index":
        f"contains(lower(email), 'mer 00000001') OR contains({_FULL_NAME}, 'mer 00000001')",
    "customers_search_index_email":
        f"contains(lower(email), '.00000001') OR contains({_FULL_NAME}, '.00000001')",
    "customers_search_index_wildcard":
        f"lower(email) LIKE '%er_0%7@ex%' OR {_FULL_NAME} LIKE '%er_0%7@ex%'",
    "customers_search_index_short":
        f"contains(lower(email), '7@') OR contains({_FULL_NAME}, '7@')",
}


def oracle_sql() -> dict[str, str]:
    flat = _with("profile", f"SELECT {FLAT} FROM profile")
    views = {
        "mobile": _with("mobile", MOBILE_VIEW),
        "partner": _with("partner", PARTNER_VIEW),
        "web": _with("web", WEB_VIEW),
        "card": _with("card", CARD_VIEW),
    }
    return {
        "channel_scan_counts": _with(
            "mobile partner web card",
            "\nUNION ALL ".join(
                f"SELECT '{_CHANNEL[v]}' AS channel, count(*) AS row_count, "
                f"count(DISTINCT email) AS customers FROM {v}"
                for v in _CHANNEL
            ),
        ),
        "customer_union": _with("union_ids", "SELECT * FROM union_ids"),
        "identity_resolution": _with("ids", "SELECT * FROM ids"),
        "mobile_rollup": _with(
            "m",
            "SELECT email, n AS mobile_app_order_count, "
            "cast(s as double) AS mobile_app_total_spend FROM m",
        ),
        "partner_rollup": _with(
            "p",
            "SELECT email, n AS partner_loan_count, "
            "cast(s as double) AS partner_total_principal FROM p",
        ),
        "web_rollup": _with(
            "w",
            "SELECT email, n AS web_application_count, cast(s as double) AS web_total_funded, "
            "x AS web_max_credit_score FROM w",
        ),
        "card_rollup": _with(
            "c",
            "SELECT email, n AS card_account_count, "
            "cast(l as double) AS card_total_credit_limit, "
            "cast(s as double) AS card_total_balance, x AS card_max_delinquency_days FROM c",
        ),
        "profile_flat": flat,
        "profile_flat_single_pass": flat,
        "channel_membership": _with("member", "SELECT email, channel FROM member"),
        "channel_labels": _with("member", f"SELECT email, {_label('channel')} AS label FROM member"),
        "multi_channel_customers": _with(
            "profile", f"SELECT {FLAT} FROM profile WHERE channel_count > 1"
        ),
        "load_report": _with(
            "profile",
            "SELECT count(*) AS total_customers, "
            "count(*) FILTER (WHERE channel_count > 1) AS multi_channel_customers FROM profile",
        ),
        **{
            name: _with(
                "stacked",
                "SELECT * REPLACE (cast(total_mobile_spend as double) AS total_mobile_spend, "
                "cast(total_partner_principal as double) AS total_partner_principal, "
                "cast(total_web_funded as double) AS total_web_funded, "
                f"cast(total_card_balance as double) AS total_card_balance) FROM ({STATS})",
            )
            for name in ("portfolio_stats", "portfolio_stats_partials")
        },
        "portfolio_tiles": _with("stacked", f"SELECT * FROM (WITH s AS ({STATS}) {_TILES})"),
        "customers_top": _with(
            "profile",
            f"SELECT {SUMMARY} FROM profile ORDER BY channel_count DESC, email LIMIT 50",
        ),
        "customers_search": _with(
            "profile",
            f"""SELECT {SUMMARY} FROM profile
WHERE contains(lower(email), lower('mer 00000001')) OR
  contains(lower(first_name || ' ' || last_name), lower('mer 00000001'))
ORDER BY email LIMIT 500""",
        ),
        "customers_search_wildcard": _with(
            "profile",
            f"""SELECT {SUMMARY} FROM profile
WHERE lower(email) LIKE lower('%ER_0%7@Ex%') OR
  lower(first_name || ' ' || last_name) LIKE lower('%ER_0%7@Ex%')
ORDER BY email LIMIT 500""",
        ),
        **{
            name: _with("profile", f"""SELECT {SUMMARY} FROM profile WHERE {found}
ORDER BY email LIMIT 500""")
            for name, found in _INDEXED.items()
        },
        "profile_lookup": _with(
            "profile wanted",
            f"SELECT {FLAT} FROM profile WHERE lower(email) IN "
            "(SELECT lower(email) FROM wanted)",
        ),
        "profile_missing": _with(
            "ids wanted",
            "SELECT DISTINCT email FROM wanted WHERE lower(email) NOT IN "
            "(SELECT lower(email) FROM ids WHERE email IS NOT NULL)",
        ),
        **{f"{name}_event_view": sql for name, sql in views.items()},
        **{f"{name}_event_rows": sql for name, sql in views.items()},
        "event_counts": _with(
            "profile",
            "SELECT email, mobile_app_order_count AS mobile_app_events, "
            "partner_loan_count AS partner_checkout_events, "
            "web_application_count AS web_portal_events, "
            "card_account_count AS cobranded_card_events FROM profile WHERE email IS NOT NULL",
        ),
        "section_titles": _with("profile", _SECTIONS),
        "profile_json": _with("profile", _JSON),
        "profile_nested": _with("profile", _JSON),
        "customers_search_email": _with(
            "profile",
            f"""SELECT {SUMMARY} FROM profile WHERE contains(lower(email), '.00000001')
ORDER BY email LIMIT 500""",
        ),
        "profile_lookup_one": _with(
            "profile",
            f"""SELECT {FLAT} FROM profile WHERE lower(email) = 'customer.000000101@example.com'
ORDER BY email LIMIT 1""",
        ),
        "profile_stamp": _with(
            "ids",
            "SELECT count(*) AS customers, cast(1 as bigint) AS stamps, "
            "cast(0 as bigint) AS missing FROM ids",
        ),
        "partner_event_pages": _with(
            "partner",
            "SELECT email, count(*) AS events, true AS bounded, "
            "string_agg(loan_id, ',' ORDER BY loan_id) AS loan_ids FROM partner "
            "WHERE email IS NOT NULL GROUP BY email",
        ),
        "partner_page_directory": _with(
            "partner",
            "SELECT email, count(*) AS events, true AS connected, true AS enough, "
            "true AS no_empty_page FROM partner WHERE email IS NOT NULL GROUP BY email",
        ),
        "derived_amount_violations": _with("mobile partner", "\nUNION ALL ".join((
            _rules("mobile_app", "mobile", {
                "installment_amount": "stored_wrong AND 100 <> "
                + _half_even(_cents("order_amount"), "nullif(installments, 0)"),
                "installments_zero": "installments = 0",
            }),
            _rules("partner_checkout", "partner", {
                "monthly_payment": "false", "term_months_zero": "term_months = 0",
            }),
        ))),
        "profile_display": _with(
            "profile",
            f"""SELECT email, customer_id, first_name || ' ' || last_name AS display_name,
  (SELECT string_agg({_label("k")}, ', ' ORDER BY i) FROM (SELECT
     unnest(string_split(channels_used, ',')) AS k,
     generate_subscripts(string_split(channels_used, ','), 1) AS i)) AS channels,
  cast(channel_count as varchar) AS channel_count,
  format('{{:,}}', mobile_app_order_count) AS mobile_orders,
  {_money("mobile_app_total_spend")} AS mobile_spend,
  format('{{:,}}', partner_loan_count) AS partner_loans,
  {_money("partner_total_principal")} AS partner_principal,
  format('{{:,}}', web_application_count) AS web_applications,
  {_money("web_total_funded")} AS web_funded,
  format('{{:,}}', card_account_count) AS cards,
  {_money("card_total_balance")} AS card_balance FROM profile""",
        ),
        "status_severity_summary": _with(
            "mobile partner web card",
            "\nUNION ALL ".join(
                f"SELECT '{channel}' AS channel, '{field}' AS field, {field} AS status, "
                f"{_severity(field)} AS severity, count(*) AS events FROM {view} GROUP BY {field}"
                for channel, view, field in _STATUSES
            ),
        ),
        "installment_amounts": _with(
            "mobile",
            f"SELECT order_id, cast({_half_even(_cents('order_amount'), 'nullif(installments, 0)')} "
            "as double) / 100 AS installment_amount FROM mobile",
        ),
        "monthly_payments": _with(
            "partner",
            "SELECT loan_id, cast("
            + _half_even(
                f"{_cents('principal_amount')} * (10000 + {_cents('apr_pct')})",
                "10000 * nullif(term_months, 0)",
            )
            + " as double) / 100 AS monthly_payment FROM partner",
        ),
        "installment_check": _with(
            "mobile",
            _rules("mobile_app", "mobile", {
                "installments_of_plan": "installments IS DISTINCT FROM CASE bnpl_plan "
                "WHEN 'pay_in_4' THEN 4 WHEN '6mo_installments' THEN 6 "
                "WHEN '12mo_installments' THEN 12 END"
            }),
        ),
        "utilization_check": _with(
            "card",
            _rules("cobranded_card", "card", {
                "utilization_of_balance": f"abs({_cents('utilization_pct')} - "
                + _half_even(_cents("current_balance") + " * 10000", _cents("credit_limit"))
                + ") > 1",
                "utilization_over_100": "utilization_pct > 100",
            }),
        ),
        "funding_rule_violations": _with(
            "web",
            _rules("web_portal", "web", {
                "unfunded_unless_passed": "kyc_status <> 'passed' AND funded_amount <> 0",
                "funded_share_when_passed": "kyc_status = 'passed' AND NOT ("
                f"{_cents('funded_amount')} >= "
                + _half_even(_cents("requested_amount") + " * 6", "10")
                + " AND funded_amount <= requested_amount)",
            }),
        ),
        "delinquency_rule_violations": _with(
            "card",
            _rules("cobranded_card", "card", {
                "no_days_unless_behind": "payment_behavior <> 'behind' AND delinquency_days <> 0",
                "days_30_60_90_when_behind": "payment_behavior = 'behind' AND "
                "delinquency_days NOT IN (30, 60, 90)",
            }),
        ),
        "accepted_values_report": _with("mobile partner web card", _ACCEPTED),
        "id_format_violations": _with("mobile partner web card", _IDS),
        "range_report": _with("mobile partner web card", _RANGES),
        "null_report": _with("mobile partner web card", _NULLS),
        "reject_reasons": _with(
            "mobile partner web card",
            "SELECT channel, rule || ': is null' AS reason, violations AS rows "
            f"FROM (\n{_NULLS}\n) WHERE violations > 0",
        ),
        "customer_sample": _with(
            "ids",
            f"""SELECT channel, cast(position as int) AS position, customer_id, email, first_name,
  last_name FROM (SELECT channel, ids.*, row_number() OVER (PARTITION BY channel
    ORDER BY md5(email || ':' || cast(seed as varchar)), email) AS position
  FROM ids, {_SEEDS} WHERE email IS NOT NULL) WHERE position <= 100""",
        ),
    }
