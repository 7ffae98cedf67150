"""Shop-shaped source tables derived from the test tables.

The test tables are clean, so each view adds what the pipeline must handle:
padded strings, missing and out-of-range values, older versions of rows,
orphans and parents without children. The text runs unchanged on Spark and on
the checking engine; ``{table}`` stands for a test table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("nation", "customer", "supplier", "part", "orders", "lineitem", "events")

CUSTOMERS = """
SELECT CASE WHEN c_custkey % 701 = 700 THEN NULL ELSE c_custkey END AS customer_id,
       CASE WHEN c_custkey % 10 = 1 THEN c_custkey - 1 ELSE c_custkey END
           AS customer_unique_id,
       CASE WHEN c_custkey % 157 = 3 THEN NULL
            WHEN c_custkey % 211 = 5 THEN 100000 + CAST(c_custkey % 50 AS INT)
            ELSE CAST(floor(c_acctbal * 10) AS INT) END AS customer_zip_code_prefix,
       '  ' || n_name || ' ' AS customer_city,
       CASE WHEN c_custkey % 97 = 0 THEN '  '
            WHEN c_custkey % 89 = 0 THEN NULL
            ELSE ' ' || c_mktsegment END AS customer_state,
       CAST(DATE '1995-01-01' + CAST(c_custkey % 900 AS INT) AS DATE) AS created_at,
       CAST(DATE '1995-01-01' + CAST(c_custkey % 1000 AS INT) AS DATE) AS updated_at
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey
UNION ALL
SELECT c_custkey, c_custkey, 12345, 'former ' || c_mktsegment, 'FORMER ',
       CAST(DATE '1994-01-01' + CAST(c_custkey % 300 AS INT) AS DATE),
       CAST(DATE '1994-06-01' + CAST(c_custkey % 300 AS INT) AS DATE)
FROM {customer} WHERE c_custkey % 7 = 0
"""

ORDERS = """
SELECT CASE WHEN o_orderkey % 499 = 498 THEN NULL ELSE o_orderkey END AS order_id,
       CASE WHEN o_custkey % 13 = 0 THEN o_custkey + 1000000000 ELSE o_custkey END
           AS customer_id,
       CASE o_orderstatus WHEN 'F' THEN 'delivered ' WHEN 'P' THEN ' shipped'
            ELSE CASE WHEN o_orderkey % 3 = 0 THEN 'created '
                      WHEN o_orderkey % 3 = 1 THEN 'approved' ELSE 'processing' END
            END AS order_status,
       o_orderdate AS order_purchase_timestamp,
       CASE WHEN o_orderkey % 50 = 0 THEN NULL
            WHEN o_orderkey % 33 = 0 THEN o_orderdate - INTERVAL '1' HOUR
            ELSE o_orderdate + INTERVAL '2' HOUR END AS order_approved_at,
       CASE WHEN o_orderstatus = 'O' OR o_orderkey % 41 = 0 THEN NULL
            WHEN o_orderkey % 37 = 0 THEN o_orderdate - INTERVAL '1' DAY
            ELSE o_orderdate + INTERVAL '3' DAY END AS order_delivered_carrier_date,
       CASE WHEN o_orderstatus <> 'F' OR o_orderkey % 43 = 0 THEN NULL
            WHEN o_orderkey % 29 = 0 THEN o_orderdate + INTERVAL '2' DAY
            WHEN o_orderkey % 31 = 0 THEN o_orderdate - INTERVAL '2' DAY
            ELSE o_orderdate + INTERVAL '9' DAY END AS order_delivered_customer_date,
       o_orderdate + INTERVAL '20' DAY AS order_estimated_delivery_date,
       o_orderdate AS created_at,
       o_orderdate + INTERVAL '10' DAY AS updated_at
FROM {orders}
UNION ALL
SELECT o_orderkey, o_custkey, 'created ', o_orderdate, NULL, NULL, NULL,
       o_orderdate + INTERVAL '20' DAY, o_orderdate, o_orderdate
FROM {orders} WHERE o_orderkey % 5 = 0
"""

ORDER_ITEMS = """
SELECT CASE WHEN l_orderkey % 997 = 1 THEN NULL ELSE l_orderkey END AS order_id,
       CASE WHEN l_orderkey % 991 = 2 THEN NULL ELSE l_linenumber END AS order_item_id,
       CASE WHEN l_quantity = 7 AND l_discount = 0 THEN NULL
            WHEN l_partkey % 17 = 0 THEN l_partkey + 1000000000
            ELSE l_partkey END AS product_id,
       CASE WHEN l_quantity = 8 AND l_discount = 0 THEN NULL
            WHEN l_suppkey % 19 = 0 THEN l_suppkey + 1000000000
            ELSE l_suppkey END AS seller_id,
       CASE WHEN l_quantity = 9 AND l_discount = 0 THEN NULL
            ELSE l_shipdate + INTERVAL '5' DAY END AS shipping_limit_date,
       CAST(CASE WHEN l_quantity = 10 AND l_discount = 0 THEN NULL
                 WHEN l_quantity = 50 THEN -l_extendedprice
                 ELSE l_extendedprice END AS DECIMAL(12, 2)) AS price,
       CAST(CASE WHEN l_quantity = 11 AND l_discount = 0 THEN NULL
                 WHEN l_quantity = 12 AND l_discount = 0 THEN -l_quantity
                 ELSE l_quantity END AS DECIMAL(12, 2)) AS freight_value,
       l_shipdate AS created_at,
       l_shipdate AS updated_at
FROM {lineitem}
"""

ORDER_PAYMENTS = """
SELECT CASE WHEN l_orderkey % 1009 = 3 THEN NULL
            WHEN l_orderkey % 503 = 4 THEN l_orderkey + 1000000000
            ELSE l_orderkey END AS order_id,
       l_linenumber AS payment_sequential,
       CASE l_returnflag WHEN 'A' THEN ' credit_card' WHEN 'N' THEN ' boleto '
            ELSE 'voucher' END AS payment_type,
       CASE WHEN l_quantity = 20 THEN NULL
            ELSE CAST(floor(l_quantity) AS INT) - 3 END AS payment_installments,
       CAST(CASE WHEN l_quantity = 21 THEN -l_extendedprice ELSE l_extendedprice END
            AS DECIMAL(12, 2)) AS payment_value,
       l_shipdate AS created_at,
       l_shipdate AS updated_at
FROM {lineitem}
"""

ORDER_REVIEWS = """
SELECT CASE WHEN event_id % 10 = 9 THEN event_id - 1 ELSE event_id END AS review_id,
       event_id - event_id % 3 AS order_id,
       CASE WHEN event_id % 211 = 7 THEN NULL
            WHEN event_id % 101 = 1 THEN 6
            ELSE CAST(floor(value) AS INT) % 6 END AS review_score,
       ' ' || event_type || ' ' AS review_comment_title,
       props || '  ' AS review_comment_message,
       ts AS review_creation_date,
       CASE WHEN event_id % 37 = 0 THEN ts - INTERVAL '1' HOUR
            ELSE ts + INTERVAL '1' DAY END AS review_answer_timestamp,
       ts AS updated_at
FROM {events}
UNION ALL
SELECT event_id, event_id - event_id % 3, 1, 'draft ', ' draft', ts, ts,
       ts - INTERVAL '1' DAY
FROM {events} WHERE event_id % 11 = 0
"""

PRODUCTS = """
SELECT CASE WHEN p_partkey % 601 = 600 THEN NULL ELSE p_partkey END AS product_id,
       p_type || ' ' AS product_category_name,
       CASE WHEN p_partkey % 401 = 5 THEN -1 ELSE CAST(length(p_name) AS INT) END
           AS product_name_lenght,
       p_size * 10 AS product_description_lenght,
       CASE WHEN p_partkey % 307 = 6 THEN -1 ELSE p_size % 5 END AS product_photos_qty,
       CASE WHEN p_size = 7 THEN NULL ELSE p_size - 1 END AS product_weight_g,
       CASE WHEN p_size = 9 THEN NULL ELSE p_size - 2 END AS product_length_cm,
       CASE WHEN p_size = 11 THEN NULL WHEN p_size = 13 THEN 0 ELSE p_size END
           AS product_height_cm,
       CASE WHEN p_size = 15 THEN NULL WHEN p_size = 50 THEN 0 ELSE p_size END
           AS product_width_cm
FROM {part}
UNION ALL
SELECT p_partkey, ' ALTERNATE ' || p_type, 7, 70, 1, 1, 1, 1, 1
FROM {part} WHERE p_partkey % 9 = 0
"""

SELLERS = """
SELECT s_suppkey AS seller_id,
       CAST(floor(s_acctbal * 10) AS INT) AS seller_zip_code_prefix,
       ' ' || n_name AS seller_city,
       n_name || ' ' AS seller_state
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey
UNION ALL
SELECT s_suppkey, 7, 'second entry ', 'SE'
FROM {supplier} WHERE s_suppkey % 4 = 0
"""

GEOLOCATION = """
SELECT CAST(s_suppkey % 500 AS INT) AS geolocation_zip_code_prefix,
       CAST(floor(s_acctbal / 100) AS DOUBLE) AS geolocation_lat,
       CAST(floor(s_acctbal / 50) AS DOUBLE) AS geolocation_lng,
       ' ' || n_name AS geolocation_city,
       n_name || ' ' AS geolocation_state
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey
UNION ALL
SELECT CAST(s_suppkey % 500 AS INT),
       CAST(floor(s_acctbal / 100) AS DOUBLE),
       CAST(floor(s_acctbal / 50) AS DOUBLE),
       n_name || '  ',
       '  ' || n_name
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey
WHERE s_suppkey % 3 = 0
"""

TRANSLATION = """
SELECT p_type || ' ' AS product_category_name,
       ' ' || lower(p_type) AS product_category_name_english
FROM {part} WHERE p_size <= 25
UNION ALL
SELECT ' ' || p_type, lower(p_type) || ' (b)'
FROM {part} WHERE p_size > 25
"""

SHAPES: dict[str, str] = {
    "customers": CUSTOMERS,
    "orders": ORDERS,
    "order_items": ORDER_ITEMS,
    "order_payments": ORDER_PAYMENTS,
    "order_reviews": ORDER_REVIEWS,
    "products": PRODUCTS,
    "sellers": SELLERS,
    "geolocation": GEOLOCATION,
    "product_category_name_translation": TRANSLATION,
}


class SourceTables:
    """The nine source tables over one test-data folder, built when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir
        self.base: dict[str, DataFrame] = {}
        self.built: dict[str, DataFrame] = {}

    def test_table(self, name: str) -> DataFrame:
        if name not in self.base:
            self.base[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self.base[name]

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.built:
            text = SHAPES[name]
            used = [t for t in BASE_TABLES if f"{{{t}}}" in text]
            self.built[name] = self.spark.sql(text, **{t: self.test_table(t) for t in used})
        return self.built[name]


def as_sql(table: str) -> str:
    """The view's text over the test tables by their own names."""
    return SHAPES[table].format(**{t: t for t in BASE_TABLES})
