"""Times alternatives of the same result, for the choices explained in README.

Prints one JSON line: seconds per variant, fastest of BENCH_RUNS runs.
"""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, functions as F

from bench import timed
from starmart.operators.bridge import weighted_sum
from starmart.operators.star import reduce_fact, star_join
from starmart.operators.temporal import temporal_join
from starmart.session import local_session
from starmart.sources.testdata import SampleMart

REVENUE = {"revenue": "Total_Including_Tax"}


def by_group(mart: SampleMart, reduce_first: bool, salt: int = 1) -> DataFrame:
    """Revenue per historical buying group and year."""
    sale = mart.table("Fact_Sale", "Customer_Key", "Invoice_Date_Key", "Total_Including_Tax")
    if reduce_first:
        sale = reduce_fact(sale, ["Customer_Key", "Invoice_Date_Key"], REVENUE)
    else:
        sale = sale.withColumnRenamed("Total_Including_Tax", "revenue")
    versions = mart.table("Dimension_Customer_SCD2", "Customer_Key", "Buying_Group", "Valid_From", "Valid_To")
    grouped = temporal_join(sale, versions, "Customer_Key", "Invoice_Date_Key", ["Buying_Group"], salt=salt)
    calendar = mart.table("Dimension_Date", "Date", "Calendar_Year")
    dated = star_join(grouped, calendar, "Invoice_Date_Key", "Date", ["Calendar_Year"])
    return reduce_fact(dated, ["Buying_Group", "Calendar_Year"], {"revenue": "revenue"})


def by_segment(mart: SampleMart, reduce_first: bool) -> DataFrame:
    """Weighted revenue per segment."""
    sale = mart.table("Fact_Sale", "Customer_Key", "Total_Including_Tax")
    if reduce_first:
        sale = reduce_fact(sale, ["Customer_Key"], REVENUE)
    else:
        sale = sale.withColumnRenamed("Total_Including_Tax", "revenue")
    bridge, segments = mart.table("Bridge_CustomerSegment"), mart.table("Dimension_CustomerSegment")
    return weighted_sum(sale, bridge, segments, "Customer_Key", "Segment_Key", "Segment", ["revenue"])


def by_year(mart: SampleMart, plain: bool) -> DataFrame:
    sale = mart.table("Fact_Sale", "Invoice_Date_Key", "Total_Including_Tax")
    if plain:
        return sale.groupBy("Invoice_Date_Key").agg(F.sum("Total_Including_Tax").alias("revenue"))
    return reduce_fact(sale, ["Invoice_Date_Key"], REVENUE)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), 8, "bench_variants")
    spark.sparkContext.setLogLevel("ERROR")
    mart = SampleMart(spark, folder)
    seconds = {}
    for joins, threshold in (("broadcast", "100MB"), ("sort-merge", "-1")):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        variants = {
            f"temporal join, reduced first, {joins}": lambda: by_group(mart, True),
            f"temporal join, direct, {joins}": lambda: by_group(mart, False),
            f"segment bridge, reduced first, {joins}": lambda: by_segment(mart, True),
            f"segment bridge, direct, {joins}": lambda: by_segment(mart, False),
        }
        if threshold == "-1":
            variants["temporal join, reduced first, salted by 8, sort-merge"] = lambda: by_group(mart, True, 8)
        else:
            variants["sum per day, 64-bit units"] = lambda: by_year(mart, False)
            variants["sum per day, wide decimals"] = lambda: by_year(mart, True)
        for name, run in variants.items():
            timed(run)
            seconds[name] = round(min(timed(run) for _ in range(runs)), 3)
    print(json.dumps(seconds))
    spark.stop()


if __name__ == "__main__":
    main()
