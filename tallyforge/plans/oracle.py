"""The same queries in standard SQL over the test tables, as an independent check."""

from __future__ import annotations

# The patterns and column names in these statements restate the rules of the
# pipeline. The bronze frames, and what the stages make of them, as common table expressions. Each
# query is prefixed with all of them; unused ones cost nothing.
FRAMES = r"""
WITH bronze_customer AS (
  SELECT CAST(c_custkey AS VARCHAR) AS "Customer_ID",
    CASE WHEN c_custkey % 23 = 0 THEN c_name
         WHEN c_custkey % 29 = 0 THEN NULL
         WHEN c_custkey % 31 = 0 THEN 'O''Brien_' || translate(substr(c_name, 10), '0123456789', 'abcdefghij')
         WHEN c_custkey % 37 = 0 THEN 'Shared-Name'
         WHEN c_custkey % 41 = 0 THEN 'Ann 2'
         ELSE '  Customer ' || translate(substr(c_name, 10), '0123456789', 'abcdefghij') || '. '
    END AS "Customer_Name",
    'c' || CAST(c_custkey AS VARCHAR) || '@example.com' AS "Email",
    CASE WHEN c_custkey % 11 = 0 THEN '-' || CAST(c_custkey AS VARCHAR)
         WHEN c_custkey % 13 = 0 THEN '#ERROR!'
         WHEN c_custkey % 17 = 0 THEN NULL
         ELSE '555.' || CAST(c_custkey AS VARCHAR)
    END AS "Phone",
    CASE WHEN c_custkey % 7 = 0 THEN 'Box ' || CAST(c_custkey AS VARCHAR)
         ELSE CAST(c_custkey AS VARCHAR) || ' Main St, Apt ' || CAST(c_nationkey AS VARCHAR)
    END AS "Address",
    c_mktsegment AS "Segment", n_name AS "Country", n_name AS "City", r_name AS "State",
    CASE WHEN c_custkey < 10000 THEN lpad(CAST(c_custkey AS VARCHAR), 5, '0')
         ELSE CAST(c_custkey AS VARCHAR) END AS "Postal_Code",
    r_name AS "Region"
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
),
bronze_products AS (
  SELECT CAST(p_partkey AS VARCHAR) AS "Product_ID", p_type AS "Category",
    p_brand AS "Sub_Category", p_name AS "Product_Name"
  FROM part
),
bronze_orders AS (
  SELECT CAST(o_custkey AS VARCHAR) AS "Customer_ID", l_discount AS "Discount",
    strftime(o_orderdate, '%-d/%-m/%Y') AS "Order_Date", CAST(l_orderkey AS VARCHAR) AS "Order_ID",
    CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS "Price",
    CAST(l_partkey AS VARCHAR) AS "Product_ID",
    CAST(l_extendedprice AS DECIMAL(18,2))
      * (CAST(0.20 AS DECIMAL(4,2)) - 4 * CAST(l_discount AS DECIMAL(4,2))) AS exact_profit,
    CAST(l_quantity AS INTEGER) AS "Quantity",
    CAST(l_orderkey * 10 + l_linenumber AS BIGINT) AS "Row_ID",
    strftime(l_shipdate, '%-d/%-m/%Y') AS "Ship_Date", o_orderpriority AS "Ship_Mode"
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
cleaned AS (
  SELECT *, CAST(row_number() OVER (ORDER BY "Customer_ID" NULLS FIRST) AS INTEGER) AS "Customer_PK",
    trim(regexp_replace("Customer_Name", '[^\w\s]', '', 'g')) AS clean_name,
    trim(string_split("Address", ',')[1]) AS "Address_Line1",
    trim(string_split("Address", ',')[2]) AS "Address_Line2"
  FROM bronze_customer
),
checked AS (
  SELECT "Customer_PK", "Customer_ID", clean_name AS "Customer_Name", "Email", "Phone",
    "Address_Line1", "Address_Line2", "Segment", "Country", "City", "State", "Postal_Code", "Region",
    regexp_extract(clean_name, '[^a-zA-Z\s{2,}]', 0) AS "Customer_Name_Bad",
    regexp_matches("Phone", '^\\-') OR contains(lower("Phone"), '#error') AS "Phone_Bad"
  FROM cleaned
),
checked_strict AS (
  SELECT * REPLACE (
    CASE WHEN "Customer_Name" = '' THEN '(empty)'
         ELSE regexp_extract("Customer_Name", '[^a-zA-Z\s]', 0) END AS "Customer_Name_Bad",
    regexp_matches("Phone", '^-') OR contains(lower("Phone"), '#error') AS "Phone_Bad")
  FROM checked
),
products AS (
  SELECT CAST(row_number() OVER (ORDER BY "Product_ID" NULLS FIRST) AS INTEGER) AS "Product_PK", *
  FROM bronze_products
),
exact_lines AS (
  SELECT "Row_ID", "Order_ID",
    CAST(try_strptime("Order_Date", '%d/%m/%Y') AS DATE) AS "Order_Date",
    CAST(try_strptime("Ship_Date", '%d/%m/%Y') AS DATE) AS "Ship_Date",
    "Ship_Mode", "Quantity", "Price", "Discount",
    CAST(round(exact_profit, 2) AS DECIMAL(18,2)) AS cents,
    c."Customer_Name", c."Country", p."Category", p."Sub_Category"
  FROM bronze_orders o
  JOIN checked c ON o."Customer_ID" = c."Customer_ID"
    AND c."Customer_Name_Bad" = '' AND c."Phone_Bad" = false
  JOIN bronze_products p ON o."Product_ID" = p."Product_ID"
),
enriched AS (
  SELECT * EXCLUDE (cents), CAST(cents AS DOUBLE) AS "Profit" FROM exact_lines
),
profit_lines AS (
  SELECT CAST(year("Order_Date") AS INTEGER) AS "Year", "Category", "Sub_Category", "Customer_Name", cents
  FROM exact_lines
),
agg AS (
  SELECT "Year", "Category", "Sub_Category", "Customer_Name", sum(cents) AS total
  FROM profit_lines GROUP BY ALL
)
"""

_AGG = (
    'SELECT "Year", "Category", "Sub_Category", "Customer_Name", CAST(total AS DOUBLE) AS "Profit" FROM agg'
)
_ORDERS = """
SELECT "Customer_ID", "Discount", "Order_Date", "Order_ID", "Price", "Product_ID",
  CAST(exact_profit AS DOUBLE) AS "Profit", "Quantity", "Row_ID", "Ship_Date", "Ship_Mode"
FROM bronze_orders
"""
_VALID = 'SELECT * EXCLUDE ("Customer_Name_Bad", "Phone_Bad") FROM {} WHERE "Customer_Name_Bad" = \'\' AND "Phone_Bad" = false'
_BAD = 'SELECT * FROM {} WHERE "Customer_Name_Bad" <> \'\' OR "Phone_Bad" = true'
_REPORT = """
SELECT "Customer_ID", "Customer_Name", "Phone",
  CASE WHEN "Customer_Name_Bad" <> '' AND "Phone_Bad" THEN 'name,phone'
       WHEN "Phone_Bad" THEN 'phone' ELSE 'name' END AS reason
FROM {} WHERE "Customer_Name_Bad" <> '' OR "Phone_Bad" = true
"""
_STATUS = """
CASE WHEN "Customer_Name_Bad" = '' AND "Phone_Bad" = false THEN 'valid'
     WHEN "Customer_Name_Bad" <> '' OR "Phone_Bad" = true THEN 'bad'
     ELSE 'unclassified' END AS status
"""
_COUNTS = f"SELECT status, count(*) AS n FROM (SELECT {_STATUS} FROM {{}}) GROUP BY status"

_KEPT_PRODUCTS = 'SELECT * FROM bronze_products WHERE CAST("Product_ID" AS BIGINT) % 13 <> 0'
_UNEVEN = f"""
, some_customers AS (SELECT * FROM checked WHERE CAST("Customer_ID" AS BIGINT) % 19 <> 0),
some_products AS (
  {_KEPT_PRODUCTS} UNION ALL {_KEPT_PRODUCTS} AND CAST("Product_ID" AS BIGINT) % 17 = 0
),
people AS (
  SELECT "Customer_ID", count(*) FILTER ("Customer_Name_Bad" = '' AND "Phone_Bad" = false) AS valid
  FROM some_customers GROUP BY ALL
),
goods AS (SELECT "Product_ID", count(*) AS goods FROM some_products GROUP BY ALL),
matched AS (
  SELECT o.*, coalesce(valid * goods, 0) AS copies,
    concat_ws(',',
      CASE WHEN valid IS NULL THEN 'unknown customer' WHEN valid = 0 THEN 'invalid customer' END,
      CASE WHEN goods IS NULL THEN 'unknown product' END) AS reason
  FROM bronze_orders o LEFT JOIN people USING ("Customer_ID") LEFT JOIN goods USING ("Product_ID")
)
"""
_RECONCILED = """
SELECT lines_in, rejected, added, lines_out, lines_in - rejected + added - lines_out AS missing
FROM (
  SELECT count(*) AS lines_in, count(*) FILTER (copies = 0) AS rejected,
    CAST(sum(greatest(copies - 1, 0)) AS BIGINT) AS added
  FROM matched
), (
  SELECT count(*) AS lines_out
  FROM bronze_orders JOIN some_customers USING ("Customer_ID") JOIN some_products USING ("Product_ID")
  WHERE "Customer_Name_Bad" = '' AND "Phone_Bad" = false
)
"""
_CHANGED = """
SELECT CAST(year("Order_Date") AS INTEGER) AS "Year", "Category", "Sub_Category", "Customer_Name",
  CAST(sum(CASE WHEN "Row_ID" % 10 = 1 AND year("Order_Date") IN (1995, 1997) THEN -cents ELSE cents END) AS DOUBLE)
    AS "Profit"
FROM exact_lines
WHERE "Row_ID" % 4 <> 0 OR year("Order_Date") IN (1995, 1997)
GROUP BY ALL
"""


def _registered(id_column: str, key: str, table: str) -> str:
    """The registry after two loads of a table: ids of the first, then new ones of the second."""
    number = f'CAST("{id_column}" AS BIGINT)'
    return (
        f'SELECT CAST(row_number() OVER (ORDER BY {number} % 3 = 0, "{id_column}") AS INTEGER) AS "{key}", '
        f'"{id_column}" FROM {table} WHERE {number} % 3 <> 0 OR {number} % 5 <> 0'
    )

_SETS = """
SELECT CASE grouping("Year", "Customer_Name", "Category")
    WHEN 3 THEN 'profit_by_year' WHEN 5 THEN 'profit_by_customer'
    WHEN 1 THEN 'profit_by_year_customer' WHEN 2 THEN 'profit_by_year_category' END AS report,
  "Year", "Customer_Name", "Category", CAST(round(sum(total), 2) AS DOUBLE) AS "Profit"
FROM agg
GROUP BY GROUPING SETS (("Year"), ("Customer_Name"), ("Year", "Customer_Name"), ("Year", "Category"))
"""


def _profile(table: str, column: str, kind: str) -> str:
    name = f'"{column}"'
    if column == "Profit":
        name = "CAST(exact_profit AS DOUBLE)"
    typed, size = {
        "string": (name, f"length({name})"),
        "date": (f"try_strptime({name}, '%d/%m/%Y')", f"date_diff('day', DATE '1970-01-01', try_strptime({name}, '%d/%m/%Y'))"),
        "int": (f"TRY_CAST({name} AS INTEGER)",) * 2,
        "bigint": (f"TRY_CAST({name} AS BIGINT)",) * 2,
        "double": (f"TRY_CAST({name} AS DOUBLE)",) * 2,
    }[kind]
    failed = f"{name} IS NOT NULL AND {typed} IS NULL"
    return (
        f"SELECT '{table}' AS table_name, '{column}' AS column_name, '{kind}' AS target_type, count(*) AS n, "
        f"count(*) FILTER ({name} IS NULL) AS n_null, count(*) FILTER ({failed}) AS n_failed, "
        f"min(CAST({name} AS VARCHAR)) FILTER ({failed}) AS smallest_failed, "
        f"CAST(min({size}) AS DOUBLE) AS least, CAST(max({size}) AS DOUBLE) AS greatest FROM {table}"
    )


def _profiles() -> str:
    declared = {
        "bronze_customer": (
            "Customer_ID:int Customer_Name Email Phone:double Address Segment Country City State Postal_Code:int Region"
        ),
        "bronze_products": "Product_ID:int Category Sub_Category Product_Name:int",
        "bronze_orders": (
            "Customer_ID:int Discount:double Order_Date:date Order_ID:bigint Price:double Product_ID:int Profit:double "
            "Quantity:int Row_ID:bigint Ship_Date:date Ship_Mode"
        ),
    }
    columns = [(t, *f"{c}:string".split(":")[:2]) for t, names in declared.items() for c in names.split()]
    return " UNION ALL ".join(_profile(*column) for column in columns)


def _totals(keys: str, where: str = "", order: str = "") -> str:
    return (
        f'SELECT {keys}, CAST(round(sum(total), 2) AS DOUBLE) AS "Profit" FROM agg '
        f"{where} GROUP BY {keys} {order}"
    )


def _cast_failures(column: str) -> str:
    return (
        f"SELECT '{column}' AS column_name, 'int' AS target_type, "
        f'count(*) FILTER ("{column}" IS NOT NULL AND TRY_CAST("{column}" AS INTEGER) IS NULL) AS n_failed '
        "FROM bronze_products"
    )


def _loaded(file: str, table: str) -> str:
    return (
        f"SELECT '{file}' AS file, '{table}' AS table_name, 'loaded' AS status, "
        f"count(*) AS row_count FROM {table}"
    )


def all_oracles() -> dict[str, str]:
    bodies = {
        "profit_by_year": _totals('"Year"', order='ORDER BY "Year"'),
        "profit_by_customer": _totals('"Customer_Name"'),
        "profit_by_customer_filtered": _totals(
            '"Customer_Name"', "WHERE \"Customer_Name\" = 'SharedName'"
        ),
        "profit_by_year_customer": _totals('"Year", "Customer_Name"', order='ORDER BY "Year"'),
        "profit_by_year_category": _totals('"Year", "Category"', order='ORDER BY "Year"'),
        "profit_by_year_category_filtered": _totals(
            '"Year", "Category"', "WHERE \"Category\" = 'ECONOMY'", 'ORDER BY "Year"'
        ),
        "profit_detail": _AGG,
        "gold_profit_agg": _AGG,
        "gold_profit_agg_partitioned": _AGG,
        "batch_profit_agg": _AGG,
        "atomic_rebuild": _AGG,
        "profit_reports_cube": _SETS,
        "profit_by_customer_bloom": _totals('"Customer_Name"', "WHERE \"Customer_Name\" = 'SharedName'"),
        "gold_orders_zorder": "SELECT * FROM enriched",
        "column_profiles": _profiles(),
        "incremental_profit_agg": _CHANGED,
        "rejected_orders": (
            f'{_UNEVEN} SELECT "Row_ID", "Order_ID", "Customer_ID", "Product_ID", reason FROM matched WHERE copies = 0'
        ),
        "order_reconciliation": f"{_UNEVEN} {_RECONCILED}",
        "repeated_products": f'{_UNEVEN} SELECT "Product_ID", goods AS n FROM goods WHERE goods > 1',
        "skewed_join": (
            'SELECT "Row_ID", "Order_ID", "Product_ID", c."Customer_ID", c."Customer_Name" FROM bronze_orders o '
            "JOIN checked c ON c.\"Customer_ID\" = CASE WHEN \"Row_ID\" % 3 = 0 THEN '1' ELSE o.\"Customer_ID\" END "
            'WHERE "Customer_Name_Bad" = \'\' AND "Phone_Bad" = false'
        ),
        "stable_customer_keys": (
            f'SELECT * FROM ({_registered("Customer_ID", "Customer_PK", "bronze_customer")}) '
            'WHERE CAST("Customer_ID" AS BIGINT) % 5 <> 0'
        ),
        "stable_product_keys": _registered("Product_ID", "Product_PK", "bronze_products"),
        "gold_orders_count": "SELECT count(*) AS n FROM enriched",
        "gold_orders_clustered": "SELECT * FROM enriched",
        "enriched_customers": "SELECT * FROM checked",
        "enriched_customers_strict": "SELECT * FROM checked_strict",
        "enriched_products": "SELECT * FROM products",
        "enriched_orders": "SELECT * FROM enriched",
        "customer_surrogate_key": 'SELECT "Customer_PK", "Customer_ID" FROM checked',
        "product_surrogate_key": 'SELECT "Product_PK", "Product_ID" FROM products',
        "valid_customers": _VALID.format("checked"),
        "valid_customers_strict": _VALID.format("checked_strict"),
        "bad_customers": _BAD.format("checked"),
        "bad_customers_strict": _BAD.format("checked_strict"),
        "bad_customers_loader_rule": (
            'SELECT * FROM checked WHERE "Customer_Name_Bad" = \'1\' OR "Phone_Bad" = true'
        ),
        "bad_customer_report": _REPORT.format("checked"),
        "bad_customer_report_strict": _REPORT.format("checked_strict"),
        "customer_quarantine_counts": _COUNTS.format("checked"),
        "customer_quarantine_counts_strict": _COUNTS.format("checked_strict"),
        "customers_by_status": f"SELECT *, {_STATUS} FROM checked",
        "low_profit_orders": (
            'SELECT "Customer_Name", "Profit" / NULLIF("Price", 0) * 100 AS "Profit_Percent" '
            'FROM enriched WHERE "Profit" / NULLIF("Price", 0) * 100 < 10'
        ),
        "cast_audit": " UNION ALL ".join(
            _cast_failures(c) for c in ("Product_ID", "Category", "Sub_Category", "Product_Name")
        ),
        "sanitize_columns": _ORDERS,
        "scan_orders_json": _ORDERS,
        "scan_orders_json_array": _ORDERS,
        "ingest_many_files": _ORDERS,
        "ingest_file_ledger": _ORDERS,
        "ingest_ledger_outcomes": (
            "SELECT 1 AS run, 'loaded' AS status, count(*) FILTER (\"Row_ID\" % 3 < 2) AS n, CAST(0 AS BIGINT) AS failed_files "
            "FROM bronze_orders UNION ALL "
            "SELECT 2, 'loaded', count(*) FILTER (\"Row_ID\" % 3 = 2), 0 FROM bronze_orders UNION ALL "
            "SELECT 1, 'error', NULL, 1 UNION ALL SELECT 2, 'error', NULL, 1"
        ),
        "table_by_path": "SELECT * FROM products",
        "loaded_view": "SELECT * FROM bronze_products",
        "orders_global_view": "SELECT * FROM enriched",
        "batch_customer_status": _COUNTS.format("checked"),
        "scan_products_csv": "SELECT * FROM bronze_products",
        "scan_customer_files": "SELECT * FROM bronze_customer",
        "load_row_counts": (
            "SELECT 'bronze_customer' AS table_name, count(*) AS n FROM bronze_customer UNION ALL "
            "SELECT 'bronze_orders', count(*) FROM bronze_orders UNION ALL "
            "SELECT 'bronze_products', count(*) FROM bronze_products"
        ),
        "ingest_manifest": " UNION ALL ".join(
            [
                _loaded("Customer.csv", "bronze_customer"),
                _loaded("Orders.json", "bronze_orders"),
                _loaded("Products.csv", "bronze_products"),
                "SELECT 'Returns.csv', NULL, 'error', NULL",
            ]
        ),
        "schema_evolving_overwrite": (
            'SELECT CAST(p_partkey AS VARCHAR) AS "Product_ID", CAST(NULL AS VARCHAR) AS "Category", '
            'CAST(NULL AS VARCHAR) AS "Sub_Category", p_name AS "Product_Name", '
            'p_retailprice AS "List_Price" FROM part'
        ),
    }
    return {name: f"{FRAMES}\n{body}" for name, body in bodies.items()}
