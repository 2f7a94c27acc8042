"""The same work once with row-at-a-time Python, as small ETL programs often do it, once with columns.

Prints seconds per variant (median of 3 after a warm-up) on the orders of BENCH_SF_DIR, repeated
BENCH_REPEAT times (20) and written to the shared folder first.
"""

import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tablewright.functions import strict_double, to_cents  # noqa: E402
from tablewright.operators import latest_per_key, resolve_choice  # noqa: E402
from tablewright.plans.queries import _choices, _raw_orders  # noqa: E402
from tablewright.session import build_session, materialize  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "rowwise", f"local[{cpus}]", spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
        spark__driver__memory="16g",
        spark__sql__shuffle__partitions=cpus,
    )
    spark.sparkContext.setLogLevel("ERROR")
    repeat = F.explode(F.sequence(F.lit(1), F.lit(int(os.environ.get("BENCH_REPEAT", "20")))))
    orders = materialize(_raw_orders(spark, sf_dir).withColumn("copy", repeat).repartition(int(cpus)))
    events = materialize(_choices(spark, sf_dir).withColumn("copy", repeat).repartition(int(cpus)))

    @F.udf("double")
    def cents(text):
        try:
            return float(text) * 100.0
        except (TypeError, ValueError):
            return None

    @F.udf("double")
    def double_or_zero(text):
        return float(text) if text and text != "n/a" else 0.0

    @F.udf("boolean")
    def is_shipped(status):
        return status == "shipped"

    @F.udf("struct<long:bigint,double:double,string:string>")
    def by_type(v):
        v = v.toPython() if v is not None else None
        if v is None:
            return None
        if isinstance(v, int):
            return (v, None, None)
        return (None, None, v) if isinstance(v, str) else (None, float(v), None)

    kinds = {"points": ["long", "double", "string"]}
    variants = {
        "filter shipped": (
            lambda: orders.filter(is_shipped("status")),
            lambda: orders.filter(F.col("status") == "shipped"),
        ),
        "amount to cents": (
            lambda: orders.withColumn("cents", cents("order total")),
            lambda: orders.withColumn("cents", to_cents("order total")),
        ),
        "amount or zero": (
            lambda: orders.withColumn("total", double_or_zero("order total")),
            lambda: orders.withColumn(
                "total", strict_double(F.when(F.col("order total") != "n/a", F.col("order total")))
            ),
        ),
        "choice to struct": (
            lambda: events.select("event_id", by_type("points").alias("points")),
            lambda: resolve_choice(events.select("event_id", "points"), choice="make_struct", types=kinds),
        ),
        "latest per customer": (
            lambda: orders.select("cust id", "order date", "order id").groupBy("cust id").applyInPandas(
                lambda pdf: pdf.sort_values(["order date", "order id"]).tail(1),
                "`cust id` string, `order date` string, `order id` string",
            ),
            lambda: latest_per_key(
                orders.select("cust id", "order date", "order id"), "cust id", ["order date", "order id"]
            ),
        ),
    }
    for name, pair in variants.items():
        seconds = []
        for build in pair:
            times = []
            for _ in range(4):
                start = time.perf_counter()
                build().write.format("noop").mode("overwrite").save()
                times.append(time.perf_counter() - start)
            seconds.append(statistics.median(times[1:]))
        print(f"{name:22s} row by row {seconds[0]:7.2f}  columns {seconds[1]:7.2f}  factor {seconds[0] / seconds[1]:6.1f}")
    spark.stop()


if __name__ == "__main__":
    main()
