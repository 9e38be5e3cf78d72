"""SQL per registered query. Money is whole cents until the last step, then a double."""

from __future__ import annotations

from oracle.star import with_tables as q


def money(expression: str, name: str) -> str:
    """Cents, summed or not, as a double."""
    return f"CAST(CAST({expression} AS BIGINT) / 100 AS DOUBLE) AS {name}"


def weighted(cents: str, name: str) -> str:
    """Sum of cents times hundredths of weight, rounded half up to cents."""
    return f"CAST(CAST((sum({cents} * weight_c) + 50) // 100 AS BIGINT) / 100 AS DOUBLE) AS {name}"


def day(expression: str, name: str | None = None) -> str:
    return f"CAST({expression} AS VARCHAR) AS {name or expression.split('.')[-1]}"


_DATE = "JOIN dimension_date d ON s.Invoice_Date_Key = d.Date"
_SEGMENT = (
    "JOIN bridge_customersegment b ON s.Customer_Key = b.Customer_Key "
    "JOIN dimension_customersegment g ON b.Segment_Key = g.Segment_Key"
)


def _customer_at(op: str = "<=", kind: str = "JOIN") -> str:
    return (
        f"{kind} dimension_customer_scd2 c ON s.Customer_Key = c.Customer_Key "
        f"AND s.Invoice_Date_Key >= c.Valid_From AND s.Invoice_Date_Key {op} c.Valid_To"
    )


def _group_by_year(op: str, kind: str = "JOIN") -> str:
    return q(
        f"""SELECT c.Buying_Group, d.Calendar_Year, {money('sum(gross_c)', 'revenue')}
            FROM fact_sale s {_customer_at(op, kind)} {_DATE} GROUP BY ALL""",
        "fact_sale", "dimension_customer_scd2", "dimension_date",
    )


def _segment_group(op: str) -> str:
    return q(
        f"""SELECT g.Segment, c.Buying_Group, {weighted('gross_c', 'weighted_revenue')}
            FROM fact_sale s {_DATE} {_customer_at(op)} {_SEGMENT}
            WHERE d.Calendar_Year = 1998 GROUP BY ALL""",
        "fact_sale", "dimension_date", "dimension_customer_scd2", "bridge_customersegment",
        "dimension_customersegment",
    )


def _adding_up(group: str, source: str, *tables: str) -> str:
    """Shares in hundredths of cents, cut to cents; the cents missing to the rounded total go to the largest remainders."""
    by = f"PARTITION BY {group}" if group else ""
    lead = f"{group}, " if group else ""
    return q(
        f"""WITH parts AS ({source}),
            cut AS (SELECT *, part // 100 AS whole, part % 100 AS rest, (sum(part) OVER ({by}) + 50) // 100 AS total FROM parts),
            short AS (SELECT *, total - sum(whole) OVER ({by}) AS missing, row_number() OVER ({by} ORDER BY rest DESC, Segment) AS place FROM cut)
            SELECT {lead}Segment, {money("whole + CASE WHEN place <= missing THEN 1 ELSE 0 END", "weighted_revenue")} FROM short""",
        *tables,
    )


_SHARES = "SELECT {columns}g.Segment, sum(gross_c * weight_c) AS part FROM fact_sale s {dates} " + _SEGMENT + " {where} GROUP BY ALL"
_SHARED = ("fact_sale", "bridge_customersegment", "dimension_customersegment")
_AFTER_ORDERS = q(
    f"""WITH daily AS (
          SELECT Buying_Group, Order_Date_Key AS day, sum(total_c) AS ordered
          FROM fact_order JOIN dimension_customer USING (Customer_Key) GROUP BY ALL),
        sold AS (SELECT Buying_Group, Invoice_Date_Key, gross_c FROM fact_sale JOIN dimension_customer USING (Customer_Key))
        SELECT s.Buying_Group, count(*) AS n_sales, count(day) AS n_after_orders, {money('sum(gross_c)', 'revenue')},
               {money('sum(ordered)', 'ordered_before')}, CAST(sum(Invoice_Date_Key - day) AS BIGINT) AS days_since
        FROM sold s ASOF LEFT JOIN daily d ON s.Buying_Group = d.Buying_Group AND s.Invoice_Date_Key >= d.day
        GROUP BY ALL""",
    "fact_sale", "fact_order", "dimension_customer",
)


def _at_each_sale(op: str) -> str:
    return q(
        f"""SELECT s.Sale_Key, {day('s.Invoice_Date_Key')}, c.Customer, c.Buying_Group, {day('c.Valid_From')},
                   {day('c.Valid_To')}
            FROM fact_sale s {_customer_at(op)} WHERE s.Customer_Key = 50""",
        "fact_sale", "dimension_customer_scd2",
    )


def _margin(op: str, where: str) -> str:
    return q(
        f"""SELECT d.Calendar_Year, i.Stock_Item, {money('i.price_c', 'price_at_time')},
                   {money('sum(profit_c)', 'total_profit')},
                   round(avg(CAST(profit_c AS DOUBLE) / NULLIF(gross_c, 0) * 100), 1) AS avg_margin_pct
            FROM fact_sale s {_DATE}
            JOIN dimension_stockitem_scd2 i ON s.Stock_Item_Key = i.Stock_Item_Key
             AND s.Invoice_Date_Key >= i.Valid_From AND s.Invoice_Date_Key {op} i.Valid_To
            WHERE {where} GROUP BY d.Calendar_Year, i.Stock_Item, i.price_c""",
        "fact_sale", "dimension_date", "dimension_stockitem_scd2",
    )


def _suppliers(where: str) -> str:
    """Both roles from one list of names: each link is looked up per end, then the ends are put side by side."""
    return q(
        f"""WITH links AS (SELECT row_number() OVER () AS link, * FROM bridge_suppliersubstitution WHERE {where}),
            ends AS (
              SELECT link, 1 AS role, Primary_Supplier_Key AS k FROM links
              UNION ALL SELECT link, 2, Substitute_Supplier_Key FROM links),
            named AS (
              SELECT link, max(Supplier) FILTER (role = 1) AS primary_supplier, max(Supplier) FILTER (role = 2) AS substitute_supplier
              FROM ends, dimension_supplier WHERE k = Supplier_Key GROUP BY link)
            SELECT (SELECT Stock_Item FROM dimension_stock_item i WHERE i.Stock_Item_Key = links.Stock_Item_Key) AS Stock_Item,
                   primary_supplier, substitute_supplier, Relationship_Type,
                   CAST(Lead_Time_Days AS INTEGER) AS Lead_Time_Days, {money('premium_c', 'Unit_Cost_Premium_Pct')}
            FROM links, named WHERE links.link = named.link""",
        "bridge_suppliersubstitution", "dimension_stock_item", "dimension_supplier",
    )


def _exposure(where: str) -> str:
    extra = "(i.price_c * b.premium_c + 5000) // 10000"
    return q(
        f"""SELECT i.Stock_Item, p.Supplier AS primary_supplier, u.Supplier AS substitute_supplier,
                   b.Relationship_Type, CAST(b.Lead_Time_Days AS INTEGER) AS Lead_Time_Days,
                   {money('b.premium_c', 'Unit_Cost_Premium_Pct')}, {money('i.price_c', 'Unit_Price')},
                   {money(extra, 'extra_cost')}, {money('i.price_c + ' + extra, 'exposed_price')}
            FROM bridge_suppliersubstitution b
            JOIN dimension_stock_item i ON b.Stock_Item_Key = i.Stock_Item_Key
            JOIN dimension_supplier p ON b.Primary_Supplier_Key = p.Supplier_Key
            JOIN dimension_supplier u ON b.Substitute_Supplier_Key = u.Supplier_Key WHERE {where}""",
        "bridge_suppliersubstitution", "dimension_stock_item", "dimension_supplier",
    )


def _emergency_only(where: str) -> str:
    return q(
        f"""SELECT b.Stock_Item_Key, i.Stock_Item, {money('b.premium_c', 'Unit_Cost_Premium_Pct')},
                   CAST(b.Lead_Time_Days AS INTEGER) AS Lead_Time_Days
            FROM bridge_suppliersubstitution b JOIN dimension_stock_item i ON b.Stock_Item_Key = i.Stock_Item_Key
            WHERE {where} AND b.Relationship_Type = 'Emergency' AND b.Stock_Item_Key NOT IN
             (SELECT Stock_Item_Key FROM bridge_suppliersubstitution
              WHERE {where} AND Relationship_Type = 'Secondary')""",
        "bridge_suppliersubstitution", "dimension_stock_item",
    )


_AVERAGES = """SELECT sum(price_c) FILTER (Valid_From <= DATE '1998-12-31' AND Valid_To >= DATE '1998-01-01') AS s1,
       count(*) FILTER (Valid_From <= DATE '1998-12-31' AND Valid_To >= DATE '1998-01-01') AS n1,
       sum(price_c) FILTER (Valid_From <= DATE '2000-12-31' AND Valid_To >= DATE '2000-01-01') AS s2,
       count(*) FILTER (Valid_From <= DATE '2000-12-31' AND Valid_To >= DATE '2000-01-01') AS n2
FROM dimension_stockitem_scd2 WHERE Stock_Item_Key <= 10"""

_BELOW = q(
    """SELECT i.Stock_Item, CAST(h.Quantity_On_Hand AS INTEGER) AS Quantity_On_Hand,
              CAST(h.Reorder_Level AS INTEGER) AS Reorder_Level
       FROM fact_stock_holding h JOIN dimension_stock_item i ON h.Stock_Item_Key = i.Stock_Item_Key
       WHERE h.Quantity_On_Hand < h.Reorder_Level""",
    "fact_stock_holding", "dimension_stock_item",
)


def _reconcile(where: str = "true") -> str:
    return f"""SELECT sum(gross_c) AS t, sum(w) AS w, sum(gross_c * n) AS u
FROM (SELECT s.gross_c, coalesce(n, 0) AS n, s.gross_c * coalesce(wc, 0) AS w
      FROM fact_sale s LEFT JOIN (SELECT Customer_Key, count(*) AS n, sum(weight_c) AS wc
                                  FROM bridge_customersegment GROUP BY 1) b ON s.Customer_Key = b.Customer_Key
      WHERE {where}) x"""


def _coverage(versions: str, key: str, op: str) -> str:
    return f"""SELECT n AS n_versions, CAST(count(*) AS BIGINT) AS n_fact_rows
FROM (SELECT f.r, count(v.Valid_From) AS n
      FROM (SELECT *, row_number() OVER () AS r FROM fact_sale) f
      LEFT JOIN {versions} v ON f.{key} = v.{key} AND f.Invoice_Date_Key >= v.Valid_From
       AND f.Invoice_Date_Key {op} v.Valid_To GROUP BY f.r) x GROUP BY n"""


def _scd2_customer(null_unknown: bool) -> str:
    unknown = "NULL" if null_unknown else "c_mktsegment"
    return f"""SELECT c_custkey AS Customer_Key, c_name AS Customer,
       CASE c_mktsegment WHEN 'BUILDING' THEN 'MACHINERY' WHEN 'MACHINERY' THEN 'BUILDING'
                         WHEN 'AUTOMOBILE' THEN 'BUILDING' ELSE {unknown} END AS Buying_Group,
       '1900-01-01' AS Valid_From, '1998-12-31' AS Valid_To, false AS Is_Current
FROM customer WHERE c_custkey <= (SELECT max(c_custkey) // 10 FROM customer)"""


_CUSTOMER_VERSIONS = q(
    f"""SELECT Customer_Key, Customer, Buying_Group, {day('Valid_From')}, {day('Valid_To')}, Is_Current
        FROM dimension_customer_scd2""",
    "dimension_customer_scd2",
)


def _item_versions(where: str = "true", late: bool = False) -> str:
    start = "CASE WHEN era_from IS NULL THEN NULL ELSE era_from END" if late else "Valid_From"
    if late:
        return q(
            f"""SELECT Stock_Item_Key, Stock_Item, Brand, Size, {money('(price_c * pct + 50) // 100', 'Unit_Price')},
                       {money('(retail_c * pct + 50) // 100', 'Recommended_Retail_Price')},
                       {day('era_from', 'Valid_From')}, {day('era_to', 'Valid_To')}, now AS Is_Current
                FROM dimension_stock_item i JOIN item_eras e
                  ON e.now OR i.Stock_Item_Key <= (SELECT max(p_partkey) // 2 FROM part)""",
            "dimension_stock_item", "item_eras",
        )
    return q(
        f"""SELECT Stock_Item_Key, Stock_Item, Brand, Size, {money('price_c', 'Unit_Price')},
                   {money('retail_c', 'Recommended_Retail_Price')}, {day(start)}, {day('Valid_To')}, Is_Current
            FROM dimension_stockitem_scd2 WHERE {where}""",
        "dimension_stockitem_scd2",
    )


_FOREIGN_KEYS = [
    ("Fact_Sale", "City_Key", "Dimension_City", "lineitem", "l_orderkey % 25", "nation", "n_nationkey"),
    ("Fact_Sale", "Bill_To_Customer_Key", "Dimension_Customer", "fact_sale", "Bill_To_Customer_Key", "customer", "c_custkey"),
    ("Fact_Sale", "Salesperson_Key", "Dimension_Employee", "lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("Fact_Sale", "Supplier_Key", "Dimension_Supplier", "lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("Fact_Sale", "Invoice_Date_Key", "Dimension_Date", "fact_sale", "Invoice_Date_Key", "dimension_date", "Date"),
    ("Fact_Sale", "Delivery_Date_Key", "Dimension_Date", "fact_sale", "Delivery_Date_Key", "dimension_date", "Date"),
    ("Fact_Order", "Order_Date_Key", "Dimension_Date", "orders", "CAST(o_orderdate AS DATE)", "dimension_date", "Date"),
    ("Fact_Order", "Picked_Date_Key", "Dimension_Date", "orders", "CAST(o_orderdate AS DATE) + CAST(o_orderkey % 5 AS INTEGER)", "dimension_date", "Date"),
    ("Fact_Order", "Salesperson_Key", "Dimension_Employee", "fact_order", "Salesperson_Key", "supplier", "s_suppkey"),
    ("Fact_Order", "Picker_Key", "Dimension_Employee", "fact_order", "Picker_Key", "supplier", "s_suppkey"),
    ("Fact_Purchase", "Date_Key", "Dimension_Date", "lineitem", "CAST(l_shipdate AS DATE)", "dimension_date", "Date"),
    ("Fact_Purchase", "Stock_Item_Key", "Dimension_Stock_Item", "lineitem", "l_partkey", "part", "p_partkey"),
    ("Fact_Movement", "Date_Key", "Dimension_Date", "lineitem", "CAST(l_shipdate AS DATE)", "dimension_date", "Date"),
    ("Fact_Movement", "Stock_Item_Key", "Dimension_Stock_Item", "lineitem", "l_partkey", "part", "p_partkey"),
    ("Fact_Movement", "Supplier_Key", "Dimension_Supplier", "lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("Fact_Movement", "Transaction_Type_Key", "Dimension_Transaction_Type", "lineitem", "CASE l_returnflag WHEN 'R' THEN 2 ELSE 1 END", "(VALUES (1), (2)) t(k)", "k"),
    ("Fact_Transaction", "Date_Key", "Dimension_Date", "orders", "CAST(o_orderdate AS DATE)", "dimension_date", "Date"),
    ("Fact_Transaction", "Bill_To_Customer_Key", "Dimension_Customer", "orders", "o_custkey - o_custkey % 10", "customer", "c_custkey"),
    ("Fact_Transaction", "Payment_Method_Key", "Dimension_Payment_Method", "orders", "substr(o_orderpriority, 1, 1)", "orders", "substr(o_orderpriority, 1, 1)"),
    ("Fact_Sale", "Customer_Key", "Dimension_Customer", "lineitem JOIN orders ON l_orderkey = o_orderkey",
     "o_custkey", "customer", "c_custkey"),
    ("Fact_Sale", "Stock_Item_Key", "Dimension_Stock_Item", "lineitem", "l_partkey", "part", "p_partkey"),
    ("Fact_Order", "Customer_Key", "Dimension_Customer", "orders", "o_custkey", "customer", "c_custkey"),
    ("Fact_Purchase", "Supplier_Key", "Dimension_Supplier", "lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("Fact_Transaction", "Customer_Key", "Dimension_Customer", "orders", "o_custkey", "customer", "c_custkey"),
    ("Fact_Stock_Holding", "Stock_Item_Key", "Dimension_Stock_Item", "part", "p_partkey", "part", "p_partkey"),
]


def _foreign_keys(customers: str = "true") -> str:
    parts = [
        f"""SELECT '{fact}' AS fact, '{key}' AS fact_key, '{dim}' AS dimension,
                   count(DISTINCT {fk}) AS n_orphan_keys, count({fk}) AS n_orphan_rows
            FROM {source} WHERE {fk} NOT IN (SELECT {dk} FROM {target} WHERE {customers if target == 'customer' else 'true'})"""
        for fact, key, dim, source, fk, target, dk in _FOREIGN_KEYS
    ]
    return q("\nUNION ALL\n".join(parts), "fact_sale", "fact_order", "dimension_date")


def _row_counts() -> str:
    sources = {
        "Dimension_Date": "dimension_date", "Dimension_City": "nation", "Dimension_Customer": "customer",
        "Dimension_Employee": "supplier", "Dimension_Stock_Item": "part", "Dimension_Supplier": "supplier",
        "Dimension_Payment_Method": "(SELECT DISTINCT o_orderpriority FROM orders) p",
        "Dimension_Transaction_Type": "(VALUES (1), (2)) t", "Fact_Sale": "lineitem", "Fact_Order": "orders",
        "Fact_Purchase": "lineitem", "Fact_Movement": "lineitem", "Fact_Stock_Holding": "part", "Fact_Transaction": "orders",
        "Dimension_Customer_SCD2": "dimension_customer_scd2", "Dimension_StockItem_SCD2": "dimension_stockitem_scd2",
        "Dimension_CustomerSegment": "dimension_customersegment", "Bridge_CustomerSegment": "bridge_customersegment",
        "Bridge_SupplierSubstitution": "bridge_suppliersubstitution",
    }
    counts = " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n_rows FROM {t}" for n, t in sources.items())
    return q(
        f"""SELECT coalesce(table_name, 'TOTAL') AS table_name, CAST(sum(n_rows) AS BIGINT) AS n_rows
            FROM ({counts}) c GROUP BY ROLLUP (table_name)""",
        "dimension_date", "dimension_customer_scd2", "dimension_stockitem_scd2", "dimension_customersegment",
        "bridge_customersegment", "bridge_suppliersubstitution",
    )


QUERIES: dict[str, str] = {
    "q01_revenue_by_year": q(
        f"SELECT d.Calendar_Year, {money('sum(gross_c)', 'revenue')} FROM fact_sale s {_DATE} GROUP BY 1",
        "fact_sale", "dimension_date",
    ),
    "q02_top_items_by_units": q(
        """SELECT i.Stock_Item, CAST(sum(s.Quantity) AS BIGINT) AS units_sold FROM fact_sale s
           JOIN dimension_stock_item i ON s.Stock_Item_Key = i.Stock_Item_Key
           GROUP BY 1 ORDER BY units_sold DESC, i.Stock_Item LIMIT 10""",
        "fact_sale", "dimension_stock_item",
    ),
    "q03_below_reorder_level_by_shortfall": _BELOW,
    "q04_group_at_each_sale": _at_each_sale("<="),
    "q04_group_at_each_sale_half_open": _at_each_sale("<"),
    "q05_item_price_during": q(
        f"""SELECT Stock_Item, {money('price_c', 'Unit_Price')}, {day('Valid_From')}, {day('Valid_To')}
            FROM dimension_stockitem_scd2 WHERE Stock_Item_Key = 50
             AND Valid_From <= DATE '1998-12-31' AND Valid_To >= DATE '1998-01-01'""",
        "dimension_stockitem_scd2",
    ),
    "q06_revenue_by_historical_group": _group_by_year("<="),
    "q06_revenue_by_historical_group_half_open": _group_by_year("<"),
    "q06_revenue_by_historical_group_left": _group_by_year("<", "LEFT JOIN"),
    "q06_revenue_by_historical_group_salted": _group_by_year("<="),
    "q06_revenue_by_historical_group_in_order": _group_by_year("<="),
    "q06_revenue_by_historical_group_in_order_left": _group_by_year("<", "LEFT JOIN"),
    "j03_sales_after_orders": _AFTER_ORDERS,
    "j03_sales_after_orders_copied": _AFTER_ORDERS,
    "q08_segment_revenue_adding_up": _adding_up("", _SHARES.format(columns="", dates="", where=""), *_SHARED),
    "q10_segment_revenue_by_year_adding_up": _adding_up(
        "Calendar_Year", _SHARES.format(columns="d.Calendar_Year, ", dates=_DATE, where=""), *_SHARED, "dimension_date"
    ),
    "r04_segment_revenue_of_year_adding_up": _adding_up(
        "", _SHARES.format(columns="", dates=_DATE, where="WHERE d.Calendar_Year = 1998"), *_SHARED, "dimension_date"
    ),
    "v03_apportioned_totals": q(
        f"""SELECT CAST(0 AS INTEGER) AS Calendar_Year, {money('sum(gross_c)', 'allocated')}, {money('sum(gross_c)', 'total_revenue')},
                   CAST(0 AS DOUBLE) AS missing FROM fact_sale
            UNION ALL
            SELECT CAST(year(Invoice_Date_Key) AS INTEGER), {money('sum(gross_c)', 'allocated')}, {money('sum(gross_c)', 'total_revenue')},
                   CAST(0 AS DOUBLE) FROM fact_sale GROUP BY 1""",
        "fact_sale",
    ),
    "q07_customers_with_changes": q(
        f"""SELECT Customer_Key, Customer, Buying_Group, {day('Valid_From')}, {day('Valid_To')}, Is_Current
            FROM dimension_customer_scd2 QUALIFY count(*) OVER (PARTITION BY Customer_Key) >= 2""",
        "dimension_customer_scd2",
    ),
    "q08_segment_revenue": q(
        f"SELECT g.Segment, {weighted('gross_c', 'weighted_revenue')} FROM fact_sale s {_SEGMENT} GROUP BY 1",
        "fact_sale", "bridge_customersegment", "dimension_customersegment",
    ),
    "q08_segment_revenue_unallocated": q(
        """SELECT Segment, CAST(CAST((sum(part) + 50) // 100 AS BIGINT) / 100 AS DOUBLE) AS weighted_revenue FROM (
             SELECT g.Segment, s.gross_c * w AS part
             FROM fact_sale s JOIN short_bridge USING (Customer_Key) JOIN dimension_customersegment g USING (Segment_Key)
             UNION ALL
             SELECT 'Unallocated', s.gross_c * (100 - coalesce(total, 0))
             FROM fact_sale s LEFT JOIN (SELECT Customer_Key, sum(w) AS total FROM short_bridge GROUP BY 1) t USING (Customer_Key)) x
           GROUP BY 1""",
        "fact_sale", "short_bridge", "dimension_customersegment",
    ),
    # The customers with several memberships, counted beside each of them.
    "q09_multi_segment_customers": q(
        f"""WITH counted AS (
              SELECT Customer_Key, Segment_Key, weight_c, count(*) OVER (PARTITION BY Customer_Key) AS memberships
              FROM bridge_customersegment)
            SELECT (SELECT Customer FROM dimension_customer d WHERE d.Customer_Key = counted.Customer_Key) AS Customer,
                   (SELECT Segment FROM dimension_customersegment d WHERE d.Segment_Key = counted.Segment_Key) AS Segment,
                   {money('weight_c', 'Allocation_Weight')}
            FROM counted WHERE memberships > 1""",
        "bridge_customersegment", "dimension_customer", "dimension_customersegment",
    ),
    "q10_segment_revenue_by_year": q(
        f"""SELECT d.Calendar_Year, g.Segment, {weighted('gross_c', 'weighted_revenue')}
            FROM fact_sale s {_DATE} {_SEGMENT} GROUP BY ALL""",
        "fact_sale", "dimension_date", "bridge_customersegment", "dimension_customersegment",
    ),
    "q11_suppliers_of_item": _suppliers("Is_Active AND Stock_Item_Key = 10"),
    "q11_suppliers_of_all_items": _suppliers("true"),
    "q12_emergency_suppliers": q(
        f"""WITH dear AS (
              SELECT Stock_Item_Key AS item, Substitute_Supplier_Key AS supplier_id, premium_c,
                     CAST(Lead_Time_Days AS INTEGER) AS Lead_Time_Days
              FROM bridge_suppliersubstitution
              WHERE (Relationship_Type, Is_Active) = ('Emergency', true) AND premium_c / 100 > 10)
            SELECT Stock_Item, Supplier AS emergency_supplier, Lead_Time_Days, {money('premium_c', 'Unit_Cost_Premium_Pct')}
            FROM dear, dimension_stock_item, dimension_supplier WHERE Stock_Item_Key = item AND Supplier_Key = supplier_id""",
        "bridge_suppliersubstitution", "dimension_stock_item", "dimension_supplier",
    ),
    "q13_segment_and_historical_group": _segment_group("<="),
    "q13_segment_and_historical_group_half_open": _segment_group("<"),
    "q14_average_price_comparison": q(
        f"""SELECT CAST((2 * s1 + n1) // (2 * n1) AS DOUBLE) / 100 AS avg_price_1998,
                   CAST((2 * s2 + n2) // (2 * n2) AS DOUBLE) / 100 AS avg_price_2000 FROM ({_AVERAGES}) a""",
        "dimension_stockitem_scd2",
    ),
    "q15_margin_at_historical_price": _margin("<=", "s.Stock_Item_Key <= 10"),
    "q15_margin_at_historical_price_half_open": _margin("<", "s.Stock_Item_Key <= 10"),
    "q15_margin_at_historical_price_all_items": _margin("<=", "true"),
    "q16_total_revenue": q(f"SELECT {money('sum(gross_c)', 'total_revenue')} FROM fact_sale", "fact_sale"),
    "q17_top_customers_by_revenue": q(
        f"""SELECT c.Customer, {money('sum(gross_c)', 'revenue')} FROM fact_sale s
            JOIN dimension_customer c ON s.Customer_Key = c.Customer_Key
            GROUP BY 1 ORDER BY sum(gross_c) DESC, c.Customer LIMIT 10""",
        "fact_sale", "dimension_customer",
    ),
    "q18_monthly_revenue": q(
        f"""SELECT d.Calendar_Year, d.Calendar_Month_Number, {money('sum(gross_c)', 'revenue')}
            FROM fact_sale s {_DATE} GROUP BY ALL""",
        "fact_sale", "dimension_date",
    ),
    "q19_below_reorder_level": _BELOW,
    "r01_total_revenue_of_year": q(
        f"SELECT {money('sum(gross_c)', 'total_revenue')} FROM fact_sale WHERE year(Invoice_Date_Key) = 1998",
        "fact_sale",
    ),
    "r02_group_members": q(
        f"""SELECT Customer_Key, Customer, {day('Valid_From')}, {day('Valid_To')},
                   CASE WHEN Is_Current THEN 'current' ELSE 'former' END AS status
            FROM dimension_customer_scd2 WHERE Buying_Group = 'BUILDING'""",
        "dimension_customer_scd2",
    ),
    "r03_cost_exposure": _exposure("b.Is_Active AND b.Stock_Item_Key = 10"),
    "r03_cost_exposure_all_items": _exposure("b.Is_Active"),
    "r04_segment_revenue_of_year": q(
        f"""SELECT g.Segment, {weighted('gross_c', 'weighted_revenue')} FROM fact_sale s {_SEGMENT}
            WHERE year(s.Invoice_Date_Key) = 1998 GROUP BY 1""",
        "fact_sale", "bridge_customersegment", "dimension_customersegment",
    ),
    "r05_group_changes": q(
        f"""SELECT Customer_Key, Customer, "before", Buying_Group AS "after", {day('f', 'before_from')},
                   {day('t', 'before_to')}, {day('Valid_From', 'after_from')}, {day('Valid_To', 'after_to')}
            FROM (SELECT *, lag(Buying_Group) OVER w AS "before", lag(Valid_From) OVER w AS f, lag(Valid_To) OVER w AS t
                  FROM dimension_customer_scd2 WINDOW w AS (PARTITION BY Customer_Key ORDER BY Valid_From)) x
            WHERE f IS NOT NULL AND "before" IS DISTINCT FROM Buying_Group""",
        "dimension_customer_scd2",
    ),
    "r06_emergency_only_items": _emergency_only("Is_Active"),
    "r06_emergency_only_items_with_inactive": _emergency_only("true"),
    "r07_price_increase": q(
        f"""SELECT round((CAST(s2 AS DOUBLE) / n2 - CAST(s1 AS DOUBLE) / n1) / (CAST(s1 AS DOUBLE) / n1) * 100, 2)
                   AS increase_pct FROM ({_AVERAGES}) a""",
        "dimension_stockitem_scd2",
    ),
    "r08_orders_and_sales_by_year": q(
        f"""SELECT coalesce(o.y, s.y) AS Calendar_Year, {money('o.c', 'ordered')}, {money('s.c', 'invoiced')}
            FROM (SELECT year(Order_Date_Key) AS y, sum(total_c) AS c FROM fact_order GROUP BY 1) o
            FULL JOIN (SELECT year(Invoice_Date_Key) AS y, sum(gross_c) AS c FROM fact_sale GROUP BY 1) s ON o.y = s.y""",
        "fact_order", "fact_sale",
    ),
    "r09_net_stock_movement": q(
        """SELECT Stock_Item_Key, CAST(sum(greatest(Quantity, 0)) AS BIGINT) AS quantity_in,
                  CAST(sum(greatest(-Quantity, 0)) AS BIGINT) AS quantity_out, CAST(sum(Quantity) AS BIGINT) AS net_quantity
           FROM fact_movement GROUP BY 1""",
        "fact_movement",
    ),
    "r09_movement_by_type": q(
        """SELECT Transaction_Type, CAST(sum(Quantity) AS BIGINT) AS net_quantity, count(*) AS n_movements
           FROM fact_movement GROUP BY 1""",
        "fact_movement",
    ),
    "r10_balances_by_year": q(
        f"""SELECT year(Date_Key) AS Calendar_Year, Is_Finalized, {money('sum(total_c)', 'total')},
                   {money('sum(open_c)', 'outstanding')}, count(*) AS n_transactions FROM fact_transaction GROUP BY 1, 2""",
        "fact_transaction",
    ),
    "r10_outstanding_by_payment_method": q(
        f"""SELECT Payment_Method, {money('sum(open_c)', 'outstanding')} FROM fact_transaction
            WHERE NOT Is_Finalized GROUP BY 1""",
        "fact_transaction",
    ),
    "r11_purchases_by_supplier": q(
        """SELECT Supplier, Is_Order_Finalized, CAST(sum(Ordered_Outers) AS BIGINT) AS ordered_outers,
                  CAST(sum(Received_Outers) AS BIGINT) AS received_outers, count(*) AS n_purchases,
                  CAST(sum(Ordered_Outers) - sum(Received_Outers) AS BIGINT) AS open_outers
           FROM fact_purchase p JOIN dimension_supplier s ON p.Supplier_Key = s.Supplier_Key GROUP BY 1, 2""",
        "fact_purchase", "dimension_supplier",
    ),
    "r12_double_count": q(
        f"""SELECT {money('t', 'true_total')}, {money('(w + 50) // 100', 'weighted_total')}, {money('u', 'unweighted_total')},
                   round(CAST(u AS DOUBLE) / CAST(t AS DOUBLE) * 100, 2) AS inflation_pct FROM ({_reconcile()}) r""",
        "fact_sale", "bridge_customersegment",
    ),
    "r12_double_count_of_year": q(
        f"""SELECT {money('t', 'true_total')}, {money('(w + 50) // 100', 'weighted_total')}, {money('u', 'unweighted_total')},
                   round(CAST(u AS DOUBLE) / CAST(t AS DOUBLE) * 100, 2) AS inflation_pct
            FROM ({_reconcile('year(s.Invoice_Date_Key) = 1998')}) r""",
        "fact_sale", "bridge_customersegment",
    ),
    "r13_segment_profit_and_units": q(
        f"""SELECT g.Segment, {weighted('profit_c', 'weighted_profit')},
                   CAST(CAST(sum(Quantity * weight_c) AS BIGINT) / 100 AS DOUBLE) AS weighted_units
            FROM fact_sale s {_SEGMENT} GROUP BY 1""",
        "fact_sale", "bridge_customersegment", "dimension_customersegment",
    ),
    "j11_top_bill_to_customers": q(
        f"""SELECT c.Customer AS Bill_To_Customer, {money('sum(gross_c)', 'revenue')} FROM fact_sale s
            JOIN dimension_customer c ON s.Bill_To_Customer_Key = c.Customer_Key
            GROUP BY 1 ORDER BY sum(gross_c) DESC, c.Customer LIMIT 10""",
        "fact_sale", "dimension_customer",
    ),
    "j11_revenue_by_salesperson": q(
        f"""SELECT e.Employee AS Salesperson, {money('sum(gross_c)', 'revenue')} FROM fact_sale s
            JOIN dimension_employee e ON s.Salesperson_Key = e.Employee_Key GROUP BY 1""",
        "fact_sale", "dimension_employee",
    ),
    "j11_orders_by_picker": q(
        f"""SELECT a.Employee AS Salesperson, b.Employee AS Picker, count(*) AS n_orders, {money('sum(total_c)', 'total')}
            FROM fact_order o JOIN dimension_employee a ON o.Salesperson_Key = a.Employee_Key
            JOIN dimension_employee b ON o.Picker_Key = b.Employee_Key GROUP BY 1, 2""",
        "fact_order", "dimension_employee",
    ),
    "j11_invoiced_and_delivered_by_month": q(
        f"""SELECT year(Invoice_Date_Key) AS invoice_year, month(Invoice_Date_Key) AS invoice_month,
                   year(Delivery_Date_Key) AS delivery_year, month(Delivery_Date_Key) AS delivery_month,
                   {money('sum(gross_c)', 'revenue')} FROM fact_sale GROUP BY 1, 2, 3, 4""",
        "fact_sale",
    ),
    "j01_revenue_by_city": q(
        f"""SELECT r_name AS Region, n_name AS City, {money('sum(gross_c)', 'revenue')} FROM fact_sale s
            JOIN nation ON s.City_Key = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2""",
        "fact_sale",
    ),
    "e01_current_versions": """SELECT c_custkey AS Customer_Key, c_name AS Customer, c_mktsegment AS Buying_Group,
       '1900-01-01' AS Valid_From, '9999-12-31' AS Valid_To, true AS Is_Current FROM customer""",
    "e02_history_unknown_null": _scd2_customer(True),
    "e02_history_unknown_kept": _scd2_customer(False),
    "e03_reopened_versions": """SELECT c_custkey AS Customer_Key, c_name AS Customer, c_mktsegment AS Buying_Group,
       CASE WHEN c_custkey <= (SELECT max(c_custkey) // 10 FROM customer) THEN '1999-01-01' ELSE '1900-01-01' END
           AS Valid_From, '9999-12-31' AS Valid_To, true AS Is_Current FROM customer""",
    "e04_customer_versions": _CUSTOMER_VERSIONS,
    "u01_customer_versions_by_union": _CUSTOMER_VERSIONS,
    "e05_stock_item_versions": _item_versions(),
    "e05_stock_item_versions_late_start": _item_versions(late=True),
    "e06_supplier_substitutes": q(
        f"""SELECT Stock_Item_Key, Primary_Supplier_Key, Substitute_Supplier_Key, Relationship_Type,
                   CAST(Lead_Time_Days AS INTEGER) AS Lead_Time_Days, {money('premium_c', 'Unit_Cost_Premium_Pct')},
                   Is_Active FROM bridge_suppliersubstitution""",
        "bridge_suppliersubstitution",
    ),
    "e08_segment_sizes": q(
        """SELECT g.Segment_Key, g.Segment, count(b.Customer_Key) AS n_customers FROM dimension_customersegment g
           LEFT JOIN bridge_customersegment b ON g.Segment_Key = b.Segment_Key GROUP BY 1, 2""",
        "dimension_customersegment", "bridge_customersegment",
    ),
    "e09_segment_bridge": q(
        f"SELECT Customer_Key, Segment_Key, {money('weight_c', 'Allocation_Weight')} FROM bridge_customersegment",
        "bridge_customersegment",
    ),
    "p12_current_customers": q(
        f"""SELECT Customer_Key, Customer, Buying_Group, {day('Valid_From')}, {day('Valid_To')}, Is_Current
            FROM dimension_customer_scd2 WHERE Is_Current""",
        "dimension_customer_scd2",
    ),
    "p13_current_stock_items": _item_versions("Is_Current"),
    "s12_view_of_current_items": _item_versions("Is_Current"),
    "s12_view_of_current_customers": q(
        f"""SELECT Customer_Key, Customer, Buying_Group, {day('Valid_From')}, {day('Valid_To')}, Is_Current
            FROM dimension_customer_scd2 WHERE Is_Current""",
        "dimension_customer_scd2",
    ),
    "p10_versions_on_a_day": q(
        f"""SELECT Customer_Key, Customer, Buying_Group, {day('Valid_From')}, {day('Valid_To')}, Is_Current
            FROM dimension_customer_scd2 WHERE DATE '1998-12-31' BETWEEN Valid_From AND Valid_To""",
        "dimension_customer_scd2",
    ),
    "e04_customer_versions_by_refresh": _CUSTOMER_VERSIONS,
    # After the second snapshot, with the third: customers 3 of 5 leave, 2 of 7 lose their name.
    "e03_refreshed_customers": q(
        f"""WITH seen AS (
              SELECT *, Customer_Key % 5 = 3 AS gone, Customer_Key % 5 <> 3 AND Customer_Key % 7 = 2 AND Customer IS NOT NULL AS renamed
              FROM dimension_customer_scd2)
            SELECT Customer_Key, Customer, Buying_Group, {day('Valid_From')},
                   CASE WHEN Is_Current AND (gone OR renamed) THEN '2000-05-31' ELSE CAST(Valid_To AS VARCHAR) END AS Valid_To,
                   Is_Current AND NOT gone AND NOT renamed AS Is_Current FROM seen
            UNION ALL
            SELECT Customer_Key, NULL, Buying_Group, '2000-06-01', '9999-12-31', true FROM seen WHERE Is_Current AND renamed""",
        "dimension_customer_scd2",
    ),
    "e03_refresh_counts": """
        WITH c AS (SELECT count(*) AS n, count(*) FILTER (c_custkey <= (SELECT max(c_custkey) // 10 FROM customer)) AS changed,
                          count(*) FILTER (c_custkey % 5 = 3) AS gone,
                          count(*) FILTER (c_custkey % 5 <> 3 AND c_custkey % 7 = 2) AS renamed FROM customer)
        SELECT CAST(1 AS INTEGER) AS step, n AS opened, CAST(0 AS BIGINT) AS closed, CAST(0 AS BIGINT) AS dropped FROM c
        UNION ALL SELECT 2, changed, changed, 0 FROM c UNION ALL SELECT 3, 0, 0, 0
        UNION ALL SELECT 4, renamed, gone + renamed, 0 FROM c""",
    "s09_schema_replacement": """
        SELECT CAST(o_orderkey AS VARCHAR) AS Order_Key, o_custkey AS Customer_Key, CAST(year(o_orderdate) AS INTEGER) AS Order_Year
        FROM orders, range(2) t(copy) WHERE copy = 0 OR o_custkey % 2 = 0""",
    "s06_export_tables": """
        SELECT 'Customers_With_Photo' AS table_name, count(*) AS n_rows, 'Customer Key,Customer,Third Part' AS header FROM customer
        UNION ALL SELECT 'Order_Totals', count(*), 'Order Key,Total Including Tax' FROM orders
        UNION ALL SELECT 'Supplier_Names', count(*), 'Supplier Key,Supplier' FROM supplier
        UNION ALL SELECT 'TOTAL', (SELECT count(*) FROM customer) + (SELECT count(*) FROM orders) + (SELECT count(*) FROM supplier), NULL""",
    "s01_files_with_other_headers": """
        SELECT p_partkey AS Stock_Item_Key, p_name AS Stock_Item, CASE WHEN p_partkey % 3 <> 2 THEN p_brand END AS Brand,
               CAST(CAST(round(p_retailprice * 100) AS BIGINT) / 100 AS DOUBLE) AS Unit_Price FROM part""",
    "p09_year_by_partition": q(
        f"SELECT {money('sum(gross_c)', 'total_revenue')} FROM fact_sale WHERE year(Invoice_Date_Key) = 1998", "fact_sale"
    ),
    "f13_formatted_counts": f"SELECT table_name, format('{{:,}}', n_rows) AS n_rows FROM ({_row_counts()}) x",
    "a11_key_ranges": """SELECT 'Dimension_Customer' AS table_name, min(c_custkey) AS first_key, max(c_custkey) AS last_key FROM customer
           UNION ALL SELECT 'Dimension_Stock_Item', min(p_partkey), max(p_partkey) FROM part
           UNION ALL SELECT 'Dimension_Supplier', min(s_suppkey), max(s_suppkey) FROM supplier""",
    "a15_version_counts": q(
        """SELECT Customer_Key, count(*) AS n_versions FROM dimension_customer_scd2 GROUP BY 1 HAVING count(*) > 1""",
        "dimension_customer_scd2",
    ),
    "v01_weight_sum_violations": q(
        """SELECT Customer_Key, CAST(sum(weight_c) AS DOUBLE) / 100 AS weight_sum FROM bridge_customersegment
           GROUP BY 1 HAVING sum(weight_c) <> 100""",
        "bridge_customersegment",
    ),
    "v01_weights_without_a_segment": q(
        """SELECT Customer_Key, CAST(sum(weight_c) AS DOUBLE) / 100 AS weight_sum FROM bridge_customersegment
           WHERE Segment_Key <> 7 GROUP BY 1 HAVING sum(weight_c) <> 100""",
        "bridge_customersegment",
    ),
    "v02_membership_violations": q(
        """SELECT Customer_Key, count(*) AS n_rows, count(DISTINCT Segment_Key) AS n_members FROM bridge_customersegment
           GROUP BY 1 HAVING count(*) NOT BETWEEN 1 AND 3 OR count(*) <> count(DISTINCT Segment_Key)""",
        "bridge_customersegment",
    ),
    "v02_members_of_one_segment": q(
        """SELECT Customer_Key, count(*) AS n_rows, count(DISTINCT Segment_Key) AS n_members FROM bridge_customersegment
           GROUP BY 1 HAVING count(*) < 2""",
        "bridge_customersegment",
    ),
    "v03_allocation_reconciliation": q(
        f"""SELECT {money('t', 'true_total')}, {money('(w + 50) // 100', 'weighted_total')},
                   {money('t - (w + 50) // 100', 'difference')} FROM ({_reconcile()}) r""",
        "fact_sale", "bridge_customersegment",
    ),
    "v04_customer_era_violations": q(
        f"""SELECT Customer_Key, {day('Valid_From')}, {day('Valid_To')}, {day('p', 'previous_to')},
                   CASE WHEN Valid_From <= p THEN 'overlap' ELSE 'gap' END AS problem
            FROM (SELECT *, lag(Valid_To) OVER (PARTITION BY Customer_Key ORDER BY Valid_From) AS p
                  FROM dimension_customer_scd2) x WHERE Valid_From <> p + 1""",
        "dimension_customer_scd2",
    ),
    "v04_eras_ending_early": """SELECT c_custkey AS Customer_Key, '1999-01-01' AS Valid_From, '9999-12-31' AS Valid_To,
       '1998-06-30' AS previous_to, 'gap' AS problem
       FROM customer WHERE c_custkey <= (SELECT max(c_custkey) // 10 FROM customer)""",
    "v04_eras_ending_late": """SELECT c_custkey AS Customer_Key, '1999-01-01' AS Valid_From, '9999-12-31' AS Valid_To,
       '1999-03-31' AS previous_to, 'overlap' AS problem
       FROM customer WHERE c_custkey <= (SELECT max(c_custkey) // 10 FROM customer)""",
    "v05_customer_coverage": q(
        _coverage("dimension_customer_scd2", "Customer_Key", "<="), "fact_sale", "dimension_customer_scd2"
    ),
    "v05_customer_coverage_half_open": q(
        _coverage("dimension_customer_scd2", "Customer_Key", "<"), "fact_sale", "dimension_customer_scd2"
    ),
    "v05_item_coverage": q(
        _coverage("dimension_stockitem_scd2", "Stock_Item_Key", "<="), "fact_sale", "dimension_stockitem_scd2"
    ),
    "v05_item_coverage_late_start": q(
        """SELECT n AS n_versions, count(*) AS n_fact_rows
           FROM (SELECT CASE WHEN Stock_Item_Key <= (SELECT max(p_partkey) // 2 FROM part)
                               OR Invoice_Date_Key >= DATE '2000-01-01' THEN 1 ELSE 0 END AS n FROM fact_sale) x
           GROUP BY 1""",
        "fact_sale",
    ),
    "v06_current_violations": q(
        """SELECT Customer_Key, count(*) FILTER (Is_Current) AS n_current,
                  count(*) FILTER (Is_Current AND Valid_To = DATE '9999-12-31') AS n_open
           FROM dimension_customer_scd2 GROUP BY 1 HAVING n_current <> 1 OR n_open <> 1""",
        "dimension_customer_scd2",
    ),
    "v06_closed_group": q(
        """SELECT Customer_Key, count(*) FILTER (Is_Current) AS n_current,
                  count(*) FILTER (Is_Current AND Buying_Group <> 'FURNITURE') AS n_open
           FROM dimension_customer_scd2 GROUP BY 1 HAVING n_current <> 1 OR n_open <> 1""",
        "dimension_customer_scd2",
    ),
    "v07_emergency_from_primary": q(
        """SELECT Stock_Item_Key, Primary_Supplier_Key, Primary_Supplier_Key AS Substitute_Supplier_Key, Relationship_Type
           FROM bridge_suppliersubstitution WHERE Relationship_Type = 'Emergency'""",
        "bridge_suppliersubstitution",
    ),
    "v07_self_substitutes": q(
        """SELECT Stock_Item_Key, Primary_Supplier_Key, Substitute_Supplier_Key, Relationship_Type
           FROM bridge_suppliersubstitution WHERE Primary_Supplier_Key = Substitute_Supplier_Key""",
        "bridge_suppliersubstitution",
    ),
    "v08_foreign_keys": _foreign_keys(),
    "v08_foreign_keys_of_unknown_customers": _foreign_keys("c_custkey % 11 <> 3"),
    "v09_row_counts": _row_counts(),
    "s01_csv_round_trip": """SELECT p_partkey AS "Stock Item Key", p_name AS "Stock Item", p_brand AS "Brand",
           CAST(p_size AS VARCHAR) AS "Size", CAST(CAST(round(p_retailprice * 100) AS BIGINT) / 100 AS DOUBLE) AS "Unit Price"
           FROM part""",
    "s07_table_round_trip": """SELECT o_orderkey AS Order_Key, o_custkey AS Customer_Key,
           CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS Order_Date_Key,
           CAST(CAST(round(o_totalprice * 100) AS BIGINT) / 100 AS DOUBLE) AS Total_Including_Tax FROM orders""",
    "s14_export_summary": """SELECT 'Dimension_Customer' AS table_name, count(*) AS n_rows FROM customer
           UNION ALL SELECT 'Fact_Order', count(*) FROM orders
           UNION ALL SELECT 'TOTAL', (SELECT count(*) FROM customer) + (SELECT count(*) FROM orders)""",
}
