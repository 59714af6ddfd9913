"""V07, V12, V22 and V26 kept up to date from deltas by retracting old rows and adding new ones.

A ``Totals`` is a grouped sum over a base table.  Of a delta it needs only the images of the changed keys:
rows before count with sign -1, rows after with sign 1, so its cost follows the delta, not the table.  Groups
carry their number of rows and go when it is zero.  All measures are integers, thus sums never drift and any
order of deltas gives what a recomputation gives.

NULL keys are a group of their own, a NULL measure counts as zero beside a count of the values that are
there.  Names of locations, branches and item types are not part of the totals but joined when a mart is
read, so a renamed branch needs no delta (circulation rows carry their branch name themselves).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import codes
from shelfwise.functions.plan import bounded_broadcast
from shelfwise.operators import marts
from shelfwise.plans.snapshots import SIGN

ROWS = "n_rows"


@dataclass(frozen=True)
class Totals:
    """Sums of integer ``measures`` by ``keys``; both name columns of the base table's projection."""
    keys: dict[str, Callable[[], Column]]
    measures: dict[str, Callable[[], Column]]


def _there(name: str) -> Callable[[], Column]:
    return lambda: F.col(name).isNotNull().cast("long")


def _value(name: str) -> Callable[[], Column]:
    return lambda: F.coalesce(F.col(name).cast("long"), F.lit(0).cast("long"))


#: V07 and V12.
ITEMS = Totals(
    {"location_code": lambda: F.col("location_code"), "item_format": lambda: F.col("item_format"),
     "is_active": lambda: F.coalesce(F.col("item_status_code").isin(*codes.ACTIVE_STATUS), F.lit(False))},
    {"n_items": _there("item_record_num"), "n_due": _there("due_date"), "n_prices": _there("price_cents"),
     "price_cents": _value("price_cents")})
#: V26.
GENRES = Totals({"genre": lambda: F.explode("genres")}, {"n_bibs": _there("bib_record_num")})
#: V22.
CIRCULATION = Totals(
    {"transaction_month": lambda: F.substring("transaction_day", 1, 7), "branch_name": lambda: F.col("branch_name"),
     "itype_code_num": lambda: F.col("itype_code_num"), "op_code": lambda: F.col("op_code")},
    {"n_transactions": _value("count_op_code")})


# ------------------------------------------------------------------ maintenance
def change(images: DataFrame, totals: Totals) -> DataFrame:
    """What images (rows with ``SIGN``) add to each group."""
    rows = images.select(SIGN, *[c().alias(n) for n, c in (totals.keys | totals.measures).items()])
    return rows.groupBy(*totals.keys).agg(
        F.sum(SIGN).alias(ROWS), *[F.sum(F.col(m) * F.col(SIGN)).alias(m) for m in totals.measures])


def computed(table: DataFrame, totals: Totals) -> DataFrame:
    """The totals of a whole table."""
    return change(table.withColumn(SIGN, F.lit(1).cast("long")), totals)


def add(state: DataFrame, *changes: DataFrame, totals: Totals) -> DataFrame:
    """The totals after changes; groups without rows go."""
    rows = state
    for more in changes:
        rows = rows.unionByName(more)
    return (rows.groupBy(*totals.keys).agg(*[F.sum(m).alias(m) for m in (ROWS, *totals.measures)])
            .filter(F.col(ROWS) != 0))


# ------------------------------------------------------------------ marts read from totals
def collection_value_branch(state: DataFrame, t) -> DataFrame:
    """V07."""
    price = F.when(F.sum("n_prices") > 0, F.sum("price_cents") / F.lit(100.0))
    return (state.join(bounded_broadcast(marts.named_locations(t).drop("location_id")), "location_code")
            .groupBy("branch_name", "location_name", "item_format")
            .agg(F.sum("n_items").alias("count_items"), price.alias("sum_price")))


def location_percent_checkout(state: DataFrame, t) -> DataFrame:
    """V12."""
    return marts.percent_checkout(
        state.filter("is_active").groupBy("location_code")
        .agg(F.sum("n_items").alias("count_total"), F.sum("n_due").alias("count_checkout")), t)


def circ_agg_branch(state: DataFrame, t) -> DataFrame:
    """V22."""
    names = t["itype_property"].select(F.col("itype_code").alias("itype_code_num"), "itype_name")
    of = lambda op: F.sum(F.when(F.col("op_code") == op, F.col("n_transactions")))
    return marts.checkout_types(
        state.filter(F.col("op_code").isin("f", "o")).join(bounded_broadcast(names), "itype_code_num")
        .groupBy("transaction_month", "branch_name", "itype_name").agg(of("o").alias("o_sum"), of("f").alias("f_sum")))


def genres(state: DataFrame, t=None) -> DataFrame:
    """V26."""
    return marts.linked_genres(state.select("genre", F.col("n_bibs").alias("count_bibs")))
