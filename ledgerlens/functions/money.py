"""Exact money arithmetic and EUR conversion.

Amounts are integer cents in the sources. They are turned into decimals
(never doubles) before any division, so ``round(x, 2)`` is the exact HALF_UP
rounding the reports expect; doubles appear only at the result edge.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F

RATE_TYPE = "decimal(12,6)"
HUNDREDTH = Decimal("0.01")

# EUR rates by ISO code used by the sold-products report.
RATES_BY_CODE_SALES = {
    "TRY": "0.12", "CLP": "0.00023", "USD": "0.85", "GBP": "1.10", "PLN": "0.23",
    "KRW": "0.00071", "SEK": "0.097", "NZD": "0.57", "ARS": "0.012", "EUR": "1",
}
# EUR rates by ISO code used by the cost report.
RATES_BY_CODE_COST = {"ARS": "0.012", "DOP": "0.015", "TRY": "0.12", "USD": "0.85", "EUR": "1"}
# EUR rates by currency id used by the export, summary and dump reports.
RATES_BY_ID = {
    12: "0.85", 34: "0.00070", 21: "1.12", 20: "0.11", 8: "0.23", 4: "0.0079",
    28: "0.56", 24: "0.011", 9: "0.095", 23: "0.0011", 3: "1",
}
# The cost variant adds the Dominican peso.
RATES_BY_ID_COST = {**RATES_BY_ID, 26: "0.015"}
EUR_ID = 3


def to_units(cents: Column) -> Column:
    """Integer cents -> exact decimal units (cents * 0.01)."""
    return cents.cast("decimal(20,0)") * F.lit(HUNDREDTH)


def product(amount: Column, counts: list[Column]) -> Column:
    """An integer amount times row counts, exact beyond the range of a long."""
    out = amount.cast("decimal(38,0)")
    for n in counts:
        out = (out * n.cast("decimal(19,0)")).cast("decimal(38,0)")
    return out


def product_eur(cents: Column, counts: list[Column], key: Column, rates: dict) -> Column:
    """``cents`` added up over ``counts`` copies, then converted to EUR units
    (HALF_UP to whole cents); NULL for an unknown key. Whole cents times a rate
    of six decimals are exact in a decimal(38,6)."""
    return F.round(product(cents, counts) * rate_of(key, rates), 0).cast("decimal(36,0)") * F.lit(HUNDREDTH)


def rate_map(rates: dict) -> Column:
    """A literal map expression; lookups stay inside whole-stage codegen."""
    pairs = []
    for k, v in rates.items():
        pairs += [F.lit(k), F.lit(Decimal(v)).cast(RATE_TYPE)]
    return F.create_map(*pairs)


def rate_of(key: Column, rates: dict) -> Column:
    """Rate for ``key``; NULL when the key is NULL or not in the table."""
    return F.try_element_at(rate_map(rates), key)


def to_eur(amount: Column, key: Column, rates: dict, *, on_unknown: str = "null",
           digits: int | None = 2) -> Column:
    """Convert a decimal amount to EUR with a fixed rate table.

    ``digits``      round the converted amount (HALF_UP) or leave it exact (None).
    ``on_unknown``  "null": unknown currency gives NULL; "passthrough": the
                    amount is kept unconverted.
    """
    converted = amount * rate_of(key, rates)
    if digits is not None:
        converted = F.round(converted, digits)
    if on_unknown == "passthrough":
        known = F.array(*[F.lit(k) for k in rates])
        converted = F.when(F.array_contains(known, key), converted).otherwise(amount)
    elif on_unknown != "null":
        raise ValueError(f"on_unknown must be 'null' or 'passthrough', not {on_unknown!r}")
    return converted


def to_eur_cents(cents: Column, key: Column, rates: dict) -> Column:
    """Per-row conversion rounded to whole cents (HALF_UP), as bigint.

    ``round(cents * 0.01 * rate, 2)`` in integer cents, so a column of these
    sums as a long; NULL for an unknown key.
    """
    return F.round(cents.cast("decimal(20,0)") * rate_of(key, rates), 0).cast("bigint")


def as_money(c: Column) -> Column:
    """Result-edge type for money columns."""
    return c.cast("double")
