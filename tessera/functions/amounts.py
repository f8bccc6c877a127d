"""Derived amounts. All round half to even, on exact decimals; a zero divisor gives null.

Each formula is stated once, as SQL over the channel tables' own columns.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.schemas import INSTALLMENTS

INSTALLMENT_AMOUNT = "bround(order_amount / nullif(installments, 0), 2)"
# Flat (not amortised): principal plus one year's interest, spread over the term.
MONTHLY_PAYMENT = "bround(principal_amount * (1 + apr_pct / 100) / nullif(term_months, 0), 2)"
UTILIZATION_PCT = "bround(current_balance * 100 / nullif(credit_limit, 0), 2)"


def plan_installments(plan) -> Column:
    """Number of instalments of a payment plan; null for an unknown plan."""
    lookup = F.create_map(*(F.lit(x) for x in chain.from_iterable(INSTALLMENTS.items())))
    return F.try_element_at(lookup, plan if isinstance(plan, Column) else F.col(plan))


def installment_amount() -> Column:
    return F.expr(f"cast({INSTALLMENT_AMOUNT} as decimal(10,2))")


def monthly_payment() -> Column:
    return F.expr(f"cast({MONTHLY_PAYMENT} as decimal(10,2))")


def utilization_pct() -> Column:
    return F.expr(UTILIZATION_PCT)
