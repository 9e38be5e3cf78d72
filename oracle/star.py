"""The star schema as SQL over the sample tables."""

from __future__ import annotations

_DRAW = "(((((({i}) % 2147483647) * 48271 + {c}) % 2147483647) * 69621 + {stream}) % 2147483647) % ({bound})"


def draw(i: str, stream: int, bound: str | int, seed: int = 42) -> str:
    return _DRAW.format(i=i, c=seed * 7919 + stream * 104729 + 1, stream=stream, bound=bound)


# name -> (other tables used, SQL)
TABLES: dict[str, tuple[tuple[str, ...], str]] = {
    "line_cents": (
        (),
        """SELECT *, CAST(round(l_extendedprice * 100) AS BIGINT) AS list_c,
                  (CAST(round(l_extendedprice * 100) AS BIGINT)
                   * (100 - CAST(round(l_discount * 100) AS BIGINT)) + 50) // 100 AS net_c
           FROM lineitem""",
    ),
    "fact_sale": (
        ("line_cents",),
        """SELECT l_orderkey * 10 + l_linenumber AS Sale_Key, o_custkey AS Customer_Key,
                  o_custkey - o_custkey % 10 AS Bill_To_Customer_Key, l_orderkey % 25 AS City_Key, l_partkey AS Stock_Item_Key,
                  l_suppkey AS Salesperson_Key, CAST(l_shipdate AS DATE) AS Invoice_Date_Key,
                  CAST(l_shipdate AS DATE) + l_linenumber AS Delivery_Date_Key,
                  CAST(l_quantity AS BIGINT) AS Quantity,
                  net_c + (net_c * CAST(round(l_tax * 100) AS BIGINT) + 50) // 100 AS gross_c,
                  net_c - (list_c * (60 + 5 * (l_partkey % 5)) + 50) // 100 AS profit_c
           FROM line_cents JOIN orders ON l_orderkey = o_orderkey""",
    ),
    "dimension_date": (
        (),
        """SELECT CAST(r AS DATE) AS Date, year(r) AS Calendar_Year, month(r) AS Calendar_Month_Number
           FROM (SELECT unnest(generate_series(least(s1, o1), greatest(s2, o2), INTERVAL 1 DAY)) AS r
                 FROM (SELECT min(CAST(l_shipdate AS DATE)) AS s1, max(CAST(l_shipdate AS DATE) + CAST(l_linenumber AS INTEGER)) AS s2
                       FROM lineitem),
                      (SELECT min(CAST(o_orderdate AS DATE)) AS o1,
                              max(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 5 AS INTEGER)) AS o2 FROM orders)) days""",
    ),
    "dimension_customer": (
        (),
        "SELECT c_custkey AS Customer_Key, c_name AS Customer, c_mktsegment AS Buying_Group FROM customer",
    ),
    "dimension_employee": (
        (),
        "SELECT s_suppkey AS Employee_Key, 'Manager of ' || s_name AS Employee FROM supplier",
    ),
    "dimension_stock_item": (
        (),
        """SELECT p_partkey AS Stock_Item_Key, p_name AS Stock_Item, p_brand AS Brand, CAST(p_size AS VARCHAR) AS Size,
                  CAST(round(p_retailprice * 100) AS BIGINT) AS price_c,
                  (CAST(round(p_retailprice * 100) AS BIGINT) * 140 + 50) // 100 AS retail_c FROM part""",
    ),
    "dimension_supplier": ((), "SELECT s_suppkey AS Supplier_Key, s_name AS Supplier FROM supplier"),
    "customer_recode": (
        (),
        """SELECT * FROM (VALUES ('AUTOMOBILE','BUILDING'), ('BUILDING','FURNITURE'), ('FURNITURE','HOUSEHOLD'),
                                 ('HOUSEHOLD','MACHINERY'), ('MACHINERY','AUTOMOBILE')) t(old, new)""",
    ),
    "dimension_customer_scd2": (
        ("dimension_customer", "customer_recode"),
        """SELECT Customer_Key, Customer, new AS Buying_Group, DATE '1900-01-01' AS Valid_From,
                  DATE '1998-12-31' AS Valid_To, false AS Is_Current
           FROM dimension_customer LEFT JOIN customer_recode ON Buying_Group = old
           WHERE Customer_Key <= (SELECT max(c_custkey) // 10 FROM customer)
           UNION ALL
           SELECT Customer_Key, Customer, Buying_Group,
                  CASE WHEN Customer_Key <= (SELECT max(c_custkey) // 10 FROM customer)
                       THEN DATE '1999-01-01' ELSE DATE '1900-01-01' END,
                  DATE '9999-12-31', true
           FROM dimension_customer""",
    ),
    "item_eras": (
        (),
        """SELECT * FROM (VALUES (85, DATE '1900-01-01', DATE '1998-12-31', false),
                                 (92, DATE '1999-01-01', DATE '1999-12-31', false),
                                 (100, DATE '2000-01-01', DATE '9999-12-31', true)) t(pct, era_from, era_to, now)""",
    ),
    "dimension_stockitem_scd2": (
        ("dimension_stock_item", "item_eras"),
        """SELECT Stock_Item_Key, Stock_Item, Brand, Size, (price_c * pct + 50) // 100 AS price_c,
                  (retail_c * pct + 50) // 100 AS retail_c,
                  CASE WHEN changed THEN era_from ELSE DATE '1900-01-01' END AS Valid_From,
                  era_to AS Valid_To, now AS Is_Current
           FROM (SELECT *, Stock_Item_Key <= (SELECT max(p_partkey) // 2 FROM part) AS changed
                 FROM dimension_stock_item) i
           JOIN item_eras e ON i.changed OR e.now""",
    ),
    "dimension_customersegment": (
        (),
        """SELECT * FROM (VALUES (1,'High Value'), (2,'Growth'), (3,'Loyal'), (4,'Seasonal'), (5,'At Risk'),
                                 (6,'New Business'), (7,'Tail')) t(Segment_Key, Segment)""",
    ),
    "segment_plan": (
        (),
        f"""SELECT c_custkey AS k, {draw('c_custkey', 1, 3)} + 1 AS n, {draw('c_custkey', 2, 7)} AS a,
                   {draw('c_custkey', 3, 6)} + 1 AS step, {draw('c_custkey', 4, 41)} + 30 AS half,
                   {draw('c_custkey', 5, 31)} + 20 AS third FROM customer""",
    ),
    "bridge_customersegment": (
        ("segment_plan",),
        f"""SELECT k AS Customer_Key, CAST((a + step * j) % 7 + 1 AS INTEGER) AS Segment_Key,
                   CAST(CASE WHEN n = 1 THEN 100
                             WHEN n = 2 THEN CASE j WHEN 0 THEN half ELSE 100 - half END
                             WHEN j = 0 THEN third WHEN j = 1 THEN second ELSE 100 - third - second END
                        AS BIGINT) AS weight_c
            FROM (SELECT *, {draw('k', 6, '71 - third')} + 20 AS second FROM segment_plan) p
            JOIN (VALUES (0), (1), (2)) t(j) ON j < n""",
    ),
    # Without customer 0, some memberships missing, some weights NULL (which allocate nothing).
    "short_bridge": (
        ("bridge_customersegment",),
        """SELECT Customer_Key, Segment_Key, CASE WHEN Customer_Key % 5 = 2 THEN 0 ELSE weight_c END AS w
           FROM bridge_customersegment
           WHERE Customer_Key >= 1 AND NOT (Customer_Key % 7 = 1 AND Segment_Key > 4)""",
    ),
    "substitution_rows": (
        (),
        """SELECT p_partkey AS k, p_partkey + j * (SELECT max(p_partkey) + 1 FROM part) AS i,
                  (SELECT max(s_suppkey) + 1 FROM supplier) AS s
           FROM part JOIN (VALUES (0), (1), (2)) t(j) ON j < 1 + (p_partkey // 3) % 3""",
    ),
    "bridge_suppliersubstitution": (
        ("substitution_rows",),
        f"""SELECT k AS Stock_Item_Key, i % s AS Primary_Supplier_Key,
                   CASE WHEN (i + off) % s = i % s THEN (i % s + 1) % s ELSE (i + off) % s END
                       AS Substitute_Supplier_Key,
                   ['Primary', 'Secondary', 'Emergency'][i % 3 + 1] AS Relationship_Type,
                   {draw('i', 2, 45)} + 1 AS Lead_Time_Days, {draw('i', 3, 2501)} AS premium_c,
                   {draw('i', 4, 100)} < 85 AS Is_Active
            FROM (SELECT *, {draw('i', 1, 'greatest(s - 1, 1)')} + 1 AS off FROM substitution_rows) r""",
    ),
    "fact_order": (
        (),
        """SELECT o_orderkey AS Order_Key, o_custkey AS Customer_Key, CAST(o_orderdate AS DATE) AS Order_Date_Key,
                  o_orderkey % (SELECT count(*) FROM supplier) AS Salesperson_Key,
                  (o_orderkey + 1) % (SELECT count(*) FROM supplier) AS Picker_Key,
                  CAST(round(o_totalprice * 100) AS BIGINT) AS total_c FROM orders""",
    ),
    "fact_stock_holding": (
        (),
        """SELECT p_partkey AS Stock_Item_Key, p_partkey * 37 % 100 AS Quantity_On_Hand,
                  p_partkey * 17 % 60 AS Reorder_Level FROM part""",
    ),
    "fact_movement": (
        (),
        """SELECT l_partkey AS Stock_Item_Key,
                  CASE WHEN l_returnflag = 'R' THEN 'Stock Receipt' ELSE 'Stock Issue' END AS Transaction_Type,
                  CAST(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE -l_quantity END AS BIGINT) AS Quantity
           FROM lineitem""",
    ),
    "fact_purchase": (
        (),
        """SELECT l_suppkey AS Supplier_Key, l_linestatus = 'F' AS Is_Order_Finalized,
                  CAST(l_quantity AS BIGINT) AS Ordered_Outers,
                  CASE WHEN l_linestatus = 'F' THEN CAST(l_quantity AS BIGINT)
                       ELSE CAST(l_quantity AS BIGINT) // 2 END AS Received_Outers FROM lineitem""",
    ),
    "fact_transaction": (
        (),
        """SELECT o_custkey AS Customer_Key, CAST(o_orderdate AS DATE) AS Date_Key, o_orderstatus = 'F' AS Is_Finalized,
                  substr(o_orderpriority, 3, 40) AS Payment_Method,
                  CAST(round(o_totalprice * 100) AS BIGINT) AS total_c,
                  CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'P' THEN CAST(round(o_totalprice * 100) AS BIGINT) // 2
                       ELSE CAST(round(o_totalprice * 100) AS BIGINT) END AS open_c FROM orders""",
    ),
}


def with_tables(body: str, *names: str) -> str:
    """A query over the named star tables and what they need, as common table expressions."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in TABLES[name][0]:
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    if not ordered:
        return body
    ctes = ",\n".join(f"{n} AS ({TABLES[n][1]})" for n in ordered)
    own = body.lstrip()
    return f"WITH {ctes},\n{own[5:]}" if own.startswith("WITH ") else f"WITH {ctes}\n{body}"
