"""Payment reconciliation (Q09, Q11-Q13).

Two inputs, each one scan:

settlements  order_info, arn, txn_date, settlement_date, txn_amount
refunds      order_number, return_id, pps_id, amount, attempted, status
Amounts are compared as decimal(18,2).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.operators.joins import join_on
from tidemill.operators.scale import attach, top_per_key
from tidemill.operators.windows import missing_dates
from tidemill.session import materialise

MONEY = "decimal(18,2)"
PAY_KEY = ["order_number", "amount"]


def clean_refunds(refunds: DataFrame) -> DataFrame:
    """Newest attempt per order, return, payment step and amount."""
    money = refunds.withColumn("amount", F.abs(F.col("amount").cast(MONEY))).dropna(subset=["order_number"])
    return top_per_key(money, ["order_number", "return_id", "pps_id", "amount"], [F.desc("attempted"), F.col("status")])


def clean_settlements(settlements: DataFrame) -> DataFrame:
    money = settlements.withColumn("amount", F.abs(F.col("txn_amount").cast(MONEY))).drop("txn_amount")
    return money.withColumnRenamed("order_info", "order_number").dropna(subset=["order_number", "arn"]).distinct()


def pay_keys(df: DataFrame) -> DataFrame:
    return df.select(*PAY_KEY).distinct()


def mark_paid(refunds: DataFrame, settlements: DataFrame) -> DataFrame:
    """Add ``_paid``: whether a settlement of that order and amount exists.

    Membership in the distinct (order, amount) set decides, so repeated amounts of
    an order do not multiply rows.
    """
    paid = pay_keys(settlements).withColumn("_paid", F.lit(True))
    return refunds.join(paid, PAY_KEY, "left").withColumn("_paid", F.coalesce("_paid", F.lit(False)))


def split_refunds(marked: DataFrame) -> dict[str, DataFrame]:
    """Refunds by status and by whether they were settled."""
    ok = F.col("status") == "SUCCESS"
    pick = lambda cond: marked.where(cond).drop("_paid")
    return {
        "matched": pick(ok & F.col("_paid")),
        "not_settled": pick(ok & ~F.col("_paid")),
        "failed_settled": pick(~ok & F.col("_paid")),
        "failed_open": pick(~ok & ~F.col("_paid")),
    }


def isolated(settlements: DataFrame, refunds: DataFrame) -> DataFrame:
    """Settlements that no refund accounts for."""
    return settlements.join(pay_keys(refunds), PAY_KEY, "left_anti")


def short_paid(open_refunds: DataFrame, lonely: DataFrame) -> DataFrame:
    """Orders whose open refunds add up to more than their unexplained settlements."""
    asked = open_refunds.groupBy("order_number").agg(F.sum("amount").alias("refund_sum"), F.count(F.lit(1)).alias("refunds"))
    paid = lonely.groupBy("order_number").agg(F.sum("amount").alias("settled_sum"))
    return asked.join(paid, "order_number").where(F.col("refund_sum") > F.col("settled_sum"))


def repeat_counts(df: DataFrame) -> DataFrame:
    """(order, amount, n) of repeated pairs only."""
    return df.groupBy(*PAY_KEY).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def unexplained_repeats(refunds: DataFrame, settlements: DataFrame) -> DataFrame:
    """Repeated refunds without as many settlements, unless the order's totals agree."""
    a, b = repeat_counts(refunds), repeat_counts(settlements)
    odd = a.join(b, [*PAY_KEY, "n"], "left_anti")
    left = refunds.groupBy("order_number").agg(F.sum("amount").alias("total"))
    right = settlements.groupBy("order_number").agg(F.sum("amount").alias("total"))
    settled = left.join(right, ["order_number", "total"]).select("order_number")
    return odd.join(settled, "order_number", "left_anti")


def status_by_day(refunds: DataFrame) -> DataFrame:
    """Refunds per day, a column for each status that occurs."""
    return refunds.groupBy(F.col("attempted").cast("date").alias("day")).pivot("status").agg(F.count(F.lit(1))).fillna(0)


def reconcile(refunds: DataFrame, settlements: DataFrame) -> dict[str, DataFrame]:
    """All sections of the reconciliation report.

    The cleaned inputs feed every section, so they are written once.
    """
    s = materialise(clean_settlements(settlements))
    marked = materialise(mark_paid(clean_refunds(refunds), s))
    r = marked.drop("_paid")
    sections = split_refunds(marked)
    lonely = isolated(s, r)
    sections["isolated"] = lonely
    sections["short_paid"] = short_paid(sections["failed_open"], lonely)
    sections["repeats"] = unexplained_repeats(r, s)
    sections["missing_days"] = missing_dates(s, "txn_date")
    return sections


def summary(sections: dict[str, DataFrame]) -> DataFrame:
    """(section, n, amount): the amount is the refund or settlement total."""
    rows = None
    for name, df in sections.items():
        money = F.sum("amount") if "amount" in df.columns else F.sum("refund_sum") if "refund_sum" in df.columns else F.lit(None)
        one = df.agg(F.count(F.lit(1)).alias("n"), money.cast("double").alias("amount")).select(F.lit(name).alias("section"), "n", "amount")
        rows = one if rows is None else rows.unionByName(one)
    return rows


def settled_without_order(settlements: DataFrame, refunds: DataFrame) -> DataFrame:
    """Fraud check: settlements of orders that no refund mentions."""
    return settlements.join(refunds.select("order_number").distinct(), "order_number", "left_anti")


def declined_but_settled(refunds: DataFrame, settlements: DataFrame) -> DataFrame:
    """Refunds that failed everywhere although their order was settled."""
    good = refunds.where("status = 'SUCCESS'").select("order_number").distinct()
    bad = refunds.where("status <> 'SUCCESS'").join(good, "order_number", "left_anti")
    return bad.join(settlements.select("order_number").distinct(), "order_number", "left_semi")


def failure_classes(failures: DataFrame, raised: str = "ticket raised", opened: str = "ticket opened") -> DataFrame:
    """Class of a failed payment from its ticket reference and state."""
    none = F.col("ticket").isNull()
    label = (
        F.when(none & ~F.col("state").isin(raised, opened), "no_ticket")
        .when(none & (F.col("state") == raised), "ticket_missing")
        .otherwise("other")
    )
    return failures.withColumn("class", label)


def notify_list(matched: DataFrame, refunds: DataFrame, settlements: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Contacts for settled refunds: one row per refund with customer and product.

    Orders with repeated refunds or settlements, explained or not, are left out; ``kind`` tells orders with one refund from those with several.
    """
    # Unexplained repeats are repeats, so one count by order, amount and side tells all orders to skip.
    sides = [df.select(*PAY_KEY, F.lit(side).alias("side")) for side, df in enumerate((refunds, settlements))]
    each = sides[0].unionByName(sides[1]).groupBy("order_number", "amount", "side").agg(F.count(F.lit(1)).alias("n"))
    skip = each.where("n > 1").select("order_number").distinct()
    kept = materialise(matched.join(skip, "order_number", "left_anti"))
    sizes = kept.groupBy("order_number").agg(F.count(F.lit(1)).alias("_n"))
    sized = attach(kept, sizes, ["order_number"], "_n").withColumn("kind", F.when(F.col("_n") > 1, "multiple").otherwise("single"))
    named = join_on(sized, orders, [("order_number", "contact_order")], "left")
    return join_on(named, products, [("return_id", "product_id")], "left").drop("_n", "contact_order", "product_id")
