"""Column names and types of every table, layer by layer.

Each schema is an ordered mapping ``column -> Spark SQL type name``; ``ddl`` turns one into
the string that ``DataFrameReader.schema`` takes. All columns are nullable.
"""

from __future__ import annotations

# The column names and types of the tables.

ORDERS_FILE = {
    "Customer ID": "string",
    "Discount": "double",
    "Order Date": "string",
    "Order ID": "string",
    "Price": "double",
    "Product ID": "string",
    "Profit": "double",
    "Quantity": "int",
    "Row ID": "bigint",
    "Ship Date": "string",
    "Ship Mode": "string",
}

PRODUCTS = {
    "Product_ID": "string",
    "Category": "string",
    "Sub_Category": "string",
    "Product_Name": "string",
}

CUSTOMERS = {
    "Customer_ID": "string",
    "Customer_Name": "string",
    "Email": "string",
    "Phone": "string",
    "Address": "string",
    "Segment": "string",
    "Country": "string",
    "City": "string",
    "State": "string",
    "Postal_Code": "string",
    "Region": "string",
}

SILVER_CUSTOMER = {
    "Customer_PK": "int",
    "Customer_ID": "string",
    "Customer_Name": "string",
    "Email": "string",
    "Phone": "string",
    "Address_Line1": "string",
    "Address_Line2": "string",
    "Segment": "string",
    "Country": "string",
    "City": "string",
    "State": "string",
    "Postal_Code": "string",
    "Region": "string",
}

CUSTOMER_FLAGS = {
    "Customer_Name_Bad": "string",
    "Phone_Bad": "boolean",
}

ENRICHED_CUSTOMER = SILVER_CUSTOMER | CUSTOMER_FLAGS

SILVER_PRODUCT = {"Product_PK": "int"} | PRODUCTS

GOLD_ORDERS = {
    "Row_ID": "bigint",
    "Order_ID": "string",
    "Order_Date": "date",
    "Ship_Date": "date",
    "Ship_Mode": "string",
    "Quantity": "int",
    "Price": "double",
    "Discount": "double",
    "Profit": "double",
    "Customer_Name": "string",
    "Country": "string",
    "Category": "string",
    "Sub_Category": "string",
}

GOLD_PROFIT_AGG = {
    "Year": "int",
    "Category": "string",
    "Sub_Category": "string",
    "Customer_Name": "string",
    "Profit": "double",
}


def ddl(schema: dict[str, str]) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in schema.items())
