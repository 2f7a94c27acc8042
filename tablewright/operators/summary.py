"""Grouped summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.functions.numbers import money_sum
from tablewright.names import quote


def summarize(
    df: DataFrame,
    by: str | Sequence[str],
    measures: Mapping[str, Column] | None = None,
    order_by: Sequence[Column | str] = (),
) -> DataFrame:
    """Groups with the given measures; a plain row count `n` if none are given."""
    groups = [by] if isinstance(by, str) else list(by)
    measures = measures or {"n": F.count("*")}
    out = df.groupBy(*(quote(g) for g in groups)).agg(*(m.alias(name) for name, m in measures.items()))
    return out.orderBy(*order_by) if order_by else out


def daily_engagement_kpis(
    events: DataFrame,
    ts: str = "ts",
    user: str = "user_id",
    kind: str = "event_type",
    value: str = "value",
    view: str = "view",
    interest: tuple[str, str] = ("click", "clicks"),
    purchase: str = "purchase",
) -> DataFrame:
    """Per day: active users, views, clicks, purchases, revenue, and purchases per view.

    `interest` is the event between view and purchase and the name of its count; a shop log without
    clicks would pass ("add_to_cart", "add_to_carts"). Distinct users are counted by first reducing
    to (day, user) pairs in every task, so neither a busy day nor a busy user makes a large group.
    """
    kind_col = F.col(quote(kind))
    views = F.count_if(kind_col == view)
    purchases = F.count_if(kind_col == purchase)
    return events.groupBy(F.to_date(F.col(quote(ts))).alias("event_date")).agg(
        F.count_distinct(F.col(quote(user))).alias("active_users"),
        views.alias("views"),
        F.count_if(kind_col == interest[0]).alias(interest[1]),
        purchases.alias("purchases"),
        F.coalesce(money_sum(F.when(kind_col == purchase, F.col(quote(value)))), F.lit(0.0)).alias("revenue"),
        F.try_divide(purchases.cast("double"), views).alias("conversion"),
    )
