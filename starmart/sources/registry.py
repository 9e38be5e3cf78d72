"""The warehouse's tables: typed columns, keys, foreign keys."""

from __future__ import annotations

from dataclasses import dataclass, field

_MONEY = "decimal(18,2)"


@dataclass(frozen=True)
class TableSpec:
    """What the loader must know of a table; columns not named here stay strings."""

    name: str
    key: str
    types: dict[str, str]
    foreign_keys: dict[str, tuple[str, str]] = field(default_factory=dict)
    columns: tuple[str, ...] | None = None
    #: Columns that files name with the short name of the source system in front, whatever that is.
    source_ids: tuple[str, ...] = ()

    @property
    def file_name(self) -> str:
        return f"{self.name}.csv"

    def casts(self, header: list[str]) -> dict[str, str]:
        """Casts for a file with this header."""
        casts, missing = {}, []
        for column, kind in self.types.items():
            found = self.spelled(column, header)
            if len(found) != 1:
                missing.append(column)
            else:
                casts[found[0]] = kind
        if missing:
            raise ValueError(f"{self.name}: columns not found: {missing}")
        return casts

    def spelled(self, column: str, header: list[str]) -> list[str]:
        """The header's columns that may be meant by ``column``: itself, or for a source id with one word in front."""
        if column not in self.source_ids:
            return [h for h in header if h == column]
        return [h for h in header if h.endswith(f" {column}") and " " not in h[: -len(column) - 1]]


_CITY = {"City_Key": ("Dimension_City", "City_Key")}
_CUSTOMER = {"Customer_Key": ("Dimension_Customer", "Customer_Key")}
_BILL_TO = {"Bill_To_Customer_Key": ("Dimension_Customer", "Customer_Key")}
_ITEM = {"Stock_Item_Key": ("Dimension_Stock_Item", "Stock_Item_Key")}
_SUPPLIER = {"Supplier_Key": ("Dimension_Supplier", "Supplier_Key")}
_SALESPERSON = {"Salesperson_Key": ("Dimension_Employee", "Employee_Key")}
_PICKER = {"Picker_Key": ("Dimension_Employee", "Employee_Key")}
_TRANSACTION_TYPE = {"Transaction_Type_Key": ("Dimension_Transaction_Type", "Transaction_Type_Key")}
_PAYMENT = {"Payment_Method_Key": ("Dimension_Payment_Method", "Payment_Method_Key")}


def _dated(*names: str) -> dict[str, tuple[str, str]]:
    return {n: ("Dimension_Date", "Date") for n in names}


# Table names, typed columns and relationships of the warehouse.
_SPECS = (
    TableSpec(
        "Dimension_Date",
        "Date",
        {
            "Date": "date",
            "Day Number": "int",
            "Day": "int",
            "Calendar Month Number": "int",
            "Calendar Year": "int",
            "Fiscal Month Number": "int",
            "Fiscal Year": "int",
            "ISO Week Number": "int",
        },
    ),
    TableSpec(
        "Dimension_City",
        "City Key",
        {
            "City Key": "int",
            "City ID": "int",
            "Latest Recorded Population": "long",
            "Valid From": "timestamp",
            "Valid To": "timestamp",
            "Lineage Key": "int",
        },
        columns=(
            "City Key", "City ID", "City", "State Province", "Country", "Continent", "Sales Territory",
            "Region", "Subregion", "Latest Recorded Population", "Valid From", "Valid To", "Lineage Key",
        ),
        source_ids=("City ID",),
    ),
    TableSpec(
        "Dimension_Customer",
        "Customer Key",
        {
            "Customer Key": "int",
            "Customer ID": "int",
            "Valid From": "timestamp",
            "Valid To": "timestamp",
            "Lineage Key": "int",
        },
        source_ids=("Customer ID",),
    ),
    TableSpec(
        "Dimension_Employee",
        "Employee Key",
        {
            "Employee Key": "int",
            "Employee ID": "int",
            "Is Salesperson": "boolean",
            "Valid From": "timestamp",
            "Valid To": "timestamp",
            "Lineage Key": "int",
        },
        columns=(
            "Employee Key", "Employee ID", "Employee", "Preferred Name", "Is Salesperson",
            "Valid From", "Valid To", "Lineage Key",
        ),
        source_ids=("Employee ID",),
    ),
    TableSpec(
        "Dimension_Payment_Method",
        "Payment Method Key",
        {
            "Payment Method Key": "int",
            "Payment Method ID": "int",
            "Valid From": "timestamp",
            "Valid To": "timestamp",
            "Lineage Key": "int",
        },
        source_ids=("Payment Method ID",),
    ),
    TableSpec(
        "Dimension_Stock_Item",
        "Stock Item Key",
        {
            "Stock Item Key": "int",
            "Stock Item ID": "int",
            "Lead Time Days": "int",
            "Quantity Per Outer": "int",
            "Is Chiller Stock": "boolean",
            "Tax Rate": "decimal(18,3)",
            "Unit Price": _MONEY,
            "Recommended Retail Price": _MONEY,
            "Typical Weight Per Unit": "decimal(18,3)",
            "Valid From": "timestamp",
            "Valid To": "timestamp",
            "Lineage Key": "int",
        },
        columns=(
            "Stock Item Key", "Stock Item ID", "Stock Item", "Color", "Selling Package", "Buying Package",
            "Brand", "Size", "Lead Time Days", "Quantity Per Outer", "Is Chiller Stock", "Barcode", "Tax Rate",
            "Unit Price", "Recommended Retail Price", "Typical Weight Per Unit", "Valid From", "Valid To",
            "Lineage Key",
        ),
        source_ids=("Stock Item ID",),
    ),
    TableSpec(
        "Dimension_Supplier",
        "Supplier Key",
        {
            "Supplier Key": "int",
            "Supplier ID": "int",
            "Payment Days": "int",
            "Valid From": "timestamp",
            "Valid To": "timestamp",
            "Lineage Key": "int",
        },
        source_ids=("Supplier ID",),
    ),
    TableSpec(
        "Dimension_Transaction_Type",
        "Transaction Type Key",
        {
            "Transaction Type Key": "int",
            "Transaction Type ID": "int",
            "Valid From": "timestamp",
            "Valid To": "timestamp",
            "Lineage Key": "int",
        },
        source_ids=("Transaction Type ID",),
    ),
    TableSpec(
        "Fact_Sale",
        "Sale Key",
        {
            "Sale Key": "long",
            "City Key": "int",
            "Customer Key": "int",
            "Bill To Customer Key": "int",
            "Stock Item Key": "int",
            "Invoice Date Key": "date",
            "Delivery Date Key": "date",
            "Salesperson Key": "int",
            "Invoice ID": "int",
            "Quantity": "int",
            "Unit Price": _MONEY,
            "Tax Rate": "decimal(18,3)",
            "Total Excluding Tax": _MONEY,
            "Tax Amount": _MONEY,
            "Profit": _MONEY,
            "Total Including Tax": _MONEY,
            "Total Dry Items": "int",
            "Total Chiller Items": "int",
            "Lineage Key": "int",
        },
        {**_CITY, **_CUSTOMER, **_BILL_TO, **_ITEM, **_SALESPERSON, **_dated("Invoice_Date_Key", "Delivery_Date_Key")},
        source_ids=("Invoice ID",),
    ),
    TableSpec(
        "Fact_Order",
        "Order Key",
        {
            "Order Key": "long",
            "City Key": "int",
            "Customer Key": "int",
            "Stock Item Key": "int",
            "Order Date Key": "date",
            "Picked Date Key": "date",
            "Salesperson Key": "int",
            "Picker Key": "int",
            "Order ID": "int",
            "Backorder ID": "int",
            "Quantity": "int",
            "Unit Price": _MONEY,
            "Tax Rate": "decimal(18,3)",
            "Total Excluding Tax": _MONEY,
            "Tax Amount": _MONEY,
            "Total Including Tax": _MONEY,
            "Lineage Key": "int",
        },
        {**_CITY, **_CUSTOMER, **_ITEM, **_SALESPERSON, **_PICKER, **_dated("Order_Date_Key", "Picked_Date_Key")},
        source_ids=("Order ID", "Backorder ID",),
    ),
    TableSpec(
        "Fact_Purchase",
        "Purchase Key",
        {
            "Purchase Key": "long",
            "Date Key": "date",
            "Supplier Key": "int",
            "Stock Item Key": "int",
            "Purchase Order ID": "int",
            "Ordered Outers": "int",
            "Ordered Quantity": "int",
            "Received Outers": "int",
            "Is Order Finalized": "boolean",
            "Lineage Key": "int",
        },
        {**_SUPPLIER, **_ITEM, **_dated("Date_Key")},
        source_ids=("Purchase Order ID",),
    ),
    TableSpec(
        "Fact_Movement",
        "Movement Key",
        {
            "Movement Key": "long",
            "Date Key": "date",
            "Stock Item Key": "int",
            "Customer Key": "int",
            "Supplier Key": "int",
            "Transaction Type Key": "int",
            "Stock Item Transaction ID": "int",
            "Invoice ID": "int",
            "Purchase Order ID": "int",
            "Quantity": "int",
            "Lineage Key": "int",
        },
        {**_ITEM, **_CUSTOMER, **_SUPPLIER, **_TRANSACTION_TYPE, **_dated("Date_Key")},
        source_ids=("Stock Item Transaction ID", "Invoice ID", "Purchase Order ID",),
    ),
    TableSpec(
        "Fact_Stock_Holding",
        "Stock Holding Key",
        {
            "Stock Holding Key": "long",
            "Stock Item Key": "int",
            "Quantity On Hand": "int",
            "Last Stocktake Quantity": "int",
            "Last Cost Price": _MONEY,
            "Reorder Level": "int",
            "Target Stock Level": "int",
            "Lineage Key": "int",
        },
        {**_ITEM},
    ),
    TableSpec(
        "Fact_Transaction",
        "Transaction Key",
        {
            "Transaction Key": "long",
            "Date Key": "date",
            "Customer Key": "int",
            "Bill To Customer Key": "int",
            "Supplier Key": "int",
            "Transaction Type Key": "int",
            "Payment Method Key": "int",
            "Customer Transaction ID": "int",
            "Supplier Transaction ID": "int",
            "Invoice ID": "int",
            "Purchase Order ID": "int",
            "Total Excluding Tax": _MONEY,
            "Tax Amount": _MONEY,
            "Total Including Tax": _MONEY,
            "Outstanding Balance": _MONEY,
            "Is Finalized": "boolean",
            "Lineage Key": "int",
        },
        {**_CUSTOMER, **_BILL_TO, **_SUPPLIER, **_TRANSACTION_TYPE, **_PAYMENT, **_dated("Date_Key")},
        source_ids=("Customer Transaction ID", "Supplier Transaction ID", "Invoice ID", "Purchase Order ID",),
    ),
)

TABLES: dict[str, TableSpec] = {s.name: s for s in _SPECS}
