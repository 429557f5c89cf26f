"""Portfolio measures over transactions, products, prices and exchange rates.

Transactions are summed per product before they meet the products, so the join sees one row
per product code whatever the distribution of the transactions is. Sums run on decimals and
do not depend on row order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.columns import ref

LOAN = "LN"
MONEY = "decimal(18,4)"


def net_by_product(transactions: DataFrame) -> DataFrame:
    amount = ref("transaction-quantity").cast(MONEY) * ref("transaction-price").cast(MONEY)
    return transactions.groupBy(ref("product-code").alias("code")).agg(
        F.sum(amount).alias("net")
    )


def loan_exposure(transactions: DataFrame, products: DataFrame) -> DataFrame:
    """Net value of loan transactions, two decimals; exactly zero means no exposure (null)."""
    loans = products.where(ref("product-type") == LOAN).select(ref("product-code").alias("code"))
    total = net_by_product(transactions).join(loans.distinct(), "code").agg(
        F.round(F.sum("net"), 2).alias("total")
    )
    return total.select(F.nullif("total", F.lit(0)).cast("double").alias("loan_exposure"))


def latest_values(series: DataFrame, columns: list[str], as_of) -> DataFrame:
    """The greatest value of each column at the latest date on or before `as_of`.

    Dates are found by date, never by value. Null if the latest row has none."""
    dated = series.where(ref("price-date") <= as_of)
    return dated.agg(
        *[F.max(F.struct(ref("price-date"), ref(c)))[c].alias(c) for c in columns]
    )


def portfolio_value(transactions: DataFrame, prices: DataFrame, fx: DataFrame) -> DataFrame:
    """P1 in EUR at the EURUSD rate plus P2 in USD, as of the last transaction date.

    The price date and the rate date are looked up independently. The last transaction date
    is a single value and enters the two lookups as a literal, so their scans can skip files
    and row groups."""
    last = transactions.agg(F.max(ref("transaction-date")).alias("d")).first()["d"]
    moment = F.lit(last) if last is not None else F.lit(None).cast("date")
    price = latest_values(prices, ["P1-EUR", "P2-USD"], moment)
    rate = latest_values(fx, ["EURUSD"], moment)
    single = F.lit(1).alias("one")  # both sides are one aggregated row
    return price.select("*", single).join(rate.select("*", single), "one").select(
        (ref("P1-EUR") * ref("EURUSD") + ref("P2-USD")).alias("portfolio_value")
    )


def loan_exposure_share(
    transactions: DataFrame, products: DataFrame, prices: DataFrame, fx: DataFrame
) -> DataFrame:
    """Loan exposure over portfolio value; null when either is."""
    single = F.lit(1).alias("one")
    exposure = loan_exposure(transactions, products).select("*", single)
    value = portfolio_value(transactions, prices, fx).select("*", single)
    return exposure.join(value, "one").select(
        F.try_divide("loan_exposure", "portfolio_value").alias("loan_exposure_pct")
    )


def average_ltv(products: DataFrame, low: float | None, high: float | None) -> DataFrame:
    """Mean of 1/ratio over loans inside the outlier fences, also in percent."""
    ratio = ref("loan-property-value-ratio").cast("double")
    kept = ref("product-type") == LOAN
    if low is not None:
        outside = (ratio < low) | (ratio > high)
        kept = kept & ~F.coalesce(outside, F.lit(False))
    ltv = products.where(kept).agg(F.avg(F.try_divide(F.lit(1.0), ratio)).alias("avg_ltv"))
    return ltv.select("avg_ltv", (F.col("avg_ltv") * 100).alias("avg_ltv_pct"))
