"""The star schema over the sample parquet tables (orders, lineitem, part, ...).

Money is worked out in whole cents as 64-bit integers and turned into decimals at
the end. Keys stay as they are stored, so filters on them reach the scan.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from starmart.functions.sqltext import day
from starmart.operators import generators, scd2
from starmart.plans import enrich
from starmart.plans.mart import During, Mart, within

#: First versions are open to the past, so that no fact is too early for them.
OPENED = dt.date(1900, 1, 1)

GROUP_RECODE = {
    "AUTOMOBILE": "BUILDING",
    "BUILDING": "FURNITURE",
    "FURNITURE": "HOUSEHOLD",
    "HOUSEHOLD": "MACHINERY",
    "MACHINERY": "AUTOMOBILE",
}
GROUP_ERA = scd2.Era(OPENED, dt.date(1998, 12, 31))
PRICE_ERAS = (
    scd2.Era(OPENED, dt.date(1998, 12, 31), Decimal("0.85")),
    scd2.Era(dt.date(1999, 1, 1), dt.date(1999, 12, 31), Decimal("0.92")),
)
PRICE_CURRENT_FROM = dt.date(2000, 1, 1)

# The columns that the mart needs, as they are stored.
STORED = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
}


# First and last day of the facts, by state of the files.
_SPANS: dict[tuple, tuple] = {}


def _cents(column: str) -> str:
    """A two-digit double as whole cents (or hundredths)."""
    return f"CAST(rint({column} * 100) AS BIGINT)"


def _money(cents: str) -> str:
    return f"CAST(CAST({cents} AS DECIMAL(14,0)) * 0.01BD AS DECIMAL(18,2))"


_LIST = _cents("l_extendedprice")
_NET = f"(({_LIST} * (100 - {_cents('l_discount')}) + 50) div 100)"
_TAX = f"(({_NET} * {_cents('l_tax')} + 50) div 100)"
_COST = f"(({_LIST} * (60 + 5 * (l_partkey % 5)) + 50) div 100)"

_SALE_FROM_LINE = {
    "Sale_Key": "l_orderkey * 10 + l_linenumber",
    "City_Key": "CAST(l_orderkey % 25 AS INT)",
    "Stock_Item_Key": "l_partkey",
    "Supplier_Key": "l_suppkey",
    "Salesperson_Key": "l_suppkey",
    "Invoice_Date_Key": "CAST(l_shipdate AS DATE)",
    "Delivery_Date_Key": "date_add(CAST(l_shipdate AS DATE), l_linenumber)",
    "Quantity": "CAST(l_quantity AS INT)",
    "Total_Excluding_Tax": _money(_NET),
    "Tax_Amount": _money(_TAX),
    "Total_Including_Tax": _money(f"{_NET} + {_TAX}"),
    "Profit": _money(f"{_NET} - {_COST}"),
}
_SALE_FROM_ORDER = {"Customer_Key": "o_custkey", "Bill_To_Customer_Key": "o_custkey - o_custkey % 10"}

_PAYMENT_METHOD_KEY = "CAST(substring(o_orderpriority, 1, 1) AS INT) AS Payment_Method_Key"
_TRANSACTION_TYPE_KEY = "IF(l_returnflag = 'R', 2, 1) AS Transaction_Type_Key"


class SampleMart(Mart):
    """Star tables derived from a folder of sample parquet files."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        """The stored table; a column that is missing or has another type is an error, not a column of NULLs."""
        stored = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        expected = T.StructType.fromDDL(STORED[name])
        found = {f.name: f.dataType for f in stored.schema}
        wrong = [f"{f.name} {f.dataType.simpleString()}" for f in expected if found.get(f.name) != f.dataType]
        if wrong:
            raise ValueError(f"{name} lacks {', '.join(wrong)}; it has {stored.schema.simpleString()}")
        return stored

    def table(self, name: str, *columns: str, during: During | None = None) -> DataFrame:
        """Each table but the largest has a method of its name, in lower case."""
        if name == "Fact_Sale":
            return self._fact_sale(columns, during)
        build = getattr(self, f"_{name.lower()}", None)
        if build is None:
            raise ValueError(f"no table {name}")
        df = within(build(), during)
        return df.select(*columns) if columns else df

    # dimensions

    def _dimension_date(self) -> DataFrame:
        """Every day from the facts' first date to their last, whatever these are.

        The two days are looked up once for each state of the stored facts; the calendar itself reads no data.
        """
        lo, hi = self._span()
        if lo is None:
            days = self.spark.range(0).selectExpr("CAST(NULL AS DATE) AS Date")
        else:
            days = self.spark.range(0, (hi - lo).days + 1, 1, 1).selectExpr(f"date_add({day(lo)}, CAST(id AS INT)) AS Date")
        return days.selectExpr(
            "Date",
            "day(Date) AS Day",
            "date_format(Date, 'MMMM') AS Month",
            "month(Date) AS Calendar_Month_Number",
            "year(Date) AS Calendar_Year",
            "month(Date) AS Fiscal_Month_Number",
            "year(Date) AS Fiscal_Year",
            "weekofyear(Date) AS ISO_Week_Number",
        )

    def _span(self) -> tuple[dt.date | None, dt.date | None]:
        """First and last day of the facts' dates; both None without facts."""
        state = (self.spark.sparkContext.applicationId, self.folder, *map(self._state, ("lineitem", "orders")))
        if state not in _SPANS:
            shipped = self.raw("lineitem").selectExpr(
                "min(CAST(l_shipdate AS DATE)) AS lo", "max(date_add(CAST(l_shipdate AS DATE), l_linenumber)) AS hi"
            )
            ordered = self.raw("orders").selectExpr(
                "min(CAST(o_orderdate AS DATE)) AS lo", "max(date_add(CAST(o_orderdate AS DATE), CAST(o_orderkey % 5 AS INT))) AS hi"
            )
            _SPANS[state] = tuple(shipped.unionAll(ordered).selectExpr("min(lo)", "max(hi)").first())
        return _SPANS[state]

    def _state(self, name: str) -> tuple[int, int, int]:
        """Number, size and latest change of a stored table's files."""
        at = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}.parquet")
        fs = at.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        files = list(fs.listStatus(at))
        return len(files), sum(f.getLen() for f in files), max((f.getModificationTime() for f in files), default=0)

    def _dimension_city(self) -> DataFrame:
        """The nations, of which every sample has 25."""
        nation, region = self.raw("nation"), self.raw("region")
        return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).selectExpr(
            "n_nationkey AS City_Key", "n_name AS City", "r_name AS Region"
        )

    def _dimension_customer(self) -> DataFrame:
        return self.raw("customer").selectExpr(
            "c_custkey AS Customer_Key",
            "c_name AS Customer",
            "c_mktsegment AS Buying_Group",
            f"CAST({day(OPENED)} AS TIMESTAMP) AS Valid_From",
            "CAST(DATE'9999-12-31' AS TIMESTAMP) AS Valid_To",
        )

    def _dimension_employee(self) -> DataFrame:
        """Each supplier's account manager."""
        return self.raw("supplier").selectExpr(
            "s_suppkey AS Employee_Key", "'Manager of ' || s_name AS Employee", "s_suppkey % 2 = 0 AS Is_Salesperson"
        )

    def _dimension_stock_item(self) -> DataFrame:
        price = _cents("p_retailprice")
        return self.raw("part").selectExpr(
            "p_partkey AS Stock_Item_Key",
            "p_name AS Stock_Item",
            "p_brand AS Brand",
            "CAST(p_size AS STRING) AS Size",
            f"{_money(price)} AS Unit_Price",
            f"{_money(f'({price} * 140 + 50) div 100')} AS Recommended_Retail_Price",
        )

    def _dimension_supplier(self) -> DataFrame:
        return self.raw("supplier").selectExpr("s_suppkey AS Supplier_Key", "s_name AS Supplier")

    def _dimension_payment_method(self) -> DataFrame:
        """The order priorities stand for payment methods."""
        name = "substring(o_orderpriority, 3, 40) AS Payment_Method"
        return self.raw("orders").selectExpr(_PAYMENT_METHOD_KEY, name).distinct()

    def _dimension_transaction_type(self) -> DataFrame:
        """Returned lines stand for receipts, the others for issues."""
        return self.spark.range(1, 3, 1, 1).selectExpr(
            "CAST(id AS INT) AS Transaction_Type_Key",
            "element_at(array('Stock Issue', 'Stock Receipt'), CAST(id AS INT)) AS Transaction_Type",
        )

    # facts

    def _fact_sale(self, columns: tuple[str, ...], during: During | None) -> DataFrame:
        available = {**_SALE_FROM_LINE, **_SALE_FROM_ORDER}
        wanted = columns or tuple(available)
        lines = self.raw("lineitem")
        by_invoice = during is not None and during[0] == "Invoice_Date_Key"
        if by_invoice:
            # On the stored timestamp, so that the scan can skip row groups.
            _, lo, hi = during
            if lo is not None:
                lines = lines.filter(f"l_shipdate >= TIMESTAMP_NTZ'{lo} 00:00:00'")
            if hi is not None:
                lines = lines.filter(f"l_shipdate < TIMESTAMP_NTZ'{hi + dt.timedelta(days=1)} 00:00:00'")
        # Joined only where the wanted columns need it: each line has its order.
        if set(wanted) & set(_SALE_FROM_ORDER):
            orders = self.raw("orders").select("o_orderkey", "o_custkey")
            lines = lines.join(orders, F.expr("l_orderkey = o_orderkey"))
        sales = lines.selectExpr(*[f"{available[c]} AS {c}" for c in wanted])
        return sales if by_invoice else within(sales, during)

    def _fact_order(self) -> DataFrame:
        n_employees = self.raw("supplier").agg(F.count(F.lit(1))).scalar()
        ordered = "CAST(o_orderdate AS DATE)"
        return self.raw("orders").withColumn("__n", n_employees).selectExpr(
            "o_orderkey AS Order_Key",
            "o_custkey AS Customer_Key",
            f"{ordered} AS Order_Date_Key",
            f"date_add({ordered}, CAST(o_orderkey % 5 AS INT)) AS Picked_Date_Key",
            "o_orderkey % __n AS Salesperson_Key",
            "(o_orderkey + 1) % __n AS Picker_Key",
            f"{_money(_cents('o_totalprice'))} AS Total_Including_Tax",
        )

    def _fact_purchase(self) -> DataFrame:
        outers = "CAST(l_quantity AS INT)"
        return self.raw("lineitem").selectExpr(
            "l_orderkey * 10 + l_linenumber AS Purchase_Key",
            "CAST(l_shipdate AS DATE) AS Date_Key",
            "l_suppkey AS Supplier_Key",
            "l_partkey AS Stock_Item_Key",
            f"{outers} AS Ordered_Outers",
            f"{outers} * 12 AS Ordered_Quantity",
            f"IF(l_linestatus = 'F', {outers}, CAST({outers} div 2 AS INT)) AS Received_Outers",
            "l_linestatus = 'F' AS Is_Order_Finalized",
        )

    def _fact_movement(self) -> DataFrame:
        quantity = "CAST(l_quantity AS INT)"
        return self.raw("lineitem").selectExpr(
            "l_orderkey * 10 + l_linenumber AS Movement_Key",
            "CAST(l_shipdate AS DATE) AS Date_Key",
            "l_partkey AS Stock_Item_Key",
            "l_suppkey AS Supplier_Key",
            _TRANSACTION_TYPE_KEY,
            f"IF(l_returnflag = 'R', {quantity}, -{quantity}) AS Quantity",
        )

    def _fact_stock_holding(self) -> DataFrame:
        return self.raw("part").selectExpr(
            "p_partkey AS Stock_Holding_Key",
            "p_partkey AS Stock_Item_Key",
            "CAST(p_partkey * 37 % 100 AS INT) AS Quantity_On_Hand",
            "CAST(p_partkey * 17 % 60 AS INT) AS Reorder_Level",
        )

    def _fact_transaction(self) -> DataFrame:
        total = _cents("o_totalprice")
        still_open = f"CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'P' THEN {total} div 2 ELSE {total} END"
        return self.raw("orders").selectExpr(
            "o_orderkey AS Transaction_Key",
            "CAST(o_orderdate AS DATE) AS Date_Key",
            "o_custkey AS Customer_Key",
            "o_custkey - o_custkey % 10 AS Bill_To_Customer_Key",
            _PAYMENT_METHOD_KEY,
            f"{_money(total)} AS Total_Including_Tax",
            f"{_money(still_open)} AS Outstanding_Balance",
            "o_orderstatus = 'F' AS Is_Finalized",
        )

    # enrichment

    def changed_customers(self) -> Column:
        """The first tenth of the keys, by a scalar subquery."""
        return F.col("Customer_Key") <= self.raw("customer").selectExpr("max(c_custkey) div 10").scalar()

    def changed_items(self) -> Column:
        """The first half of the keys."""
        return F.col("Stock_Item_Key") <= self.raw("part").selectExpr("max(p_partkey) div 2").scalar()

    def _dimension_customer_scd2(self) -> DataFrame:
        e = enrich.Enrichment(
            changed_customers=self.changed_customers(), group_recode=GROUP_RECODE, group_era=GROUP_ERA
        )
        return enrich.customer_versions(self._dimension_customer(), e)

    def _dimension_stockitem_scd2(self) -> DataFrame:
        return self.item_versions(unchanged_from=OPENED)

    def item_versions(self, unchanged_from: dt.date | None) -> DataFrame:
        e = enrich.Enrichment(
            changed_items=self.changed_items(),
            price_eras=PRICE_ERAS,
            price_current_from=PRICE_CURRENT_FROM,
            unchanged_items_from=unchanged_from,
        )
        return enrich.stock_item_versions(self._dimension_stock_item(), e)

    def _dimension_customersegment(self) -> DataFrame:
        return generators.segment_dimension(self.spark)

    def _bridge_customersegment(self) -> DataFrame:
        return enrich.customer_segments(self._dimension_customer(), enrich.Enrichment(first_key=0))

    def _bridge_suppliersubstitution(self) -> DataFrame:
        e = enrich.Enrichment(
            substitution_rows=None, substitutes_per_item="1 + (Stock_Item_Key div 3) % 3", first_key=0
        )
        return enrich.supplier_substitutes(self._dimension_stock_item(), self._dimension_supplier(), e)

    def _vw_customer_current(self) -> DataFrame:
        return scd2.current_versions(self._dimension_customer_scd2())

    def _vw_stockitem_current(self) -> DataFrame:
        return scd2.current_versions(self._dimension_stockitem_scd2())
