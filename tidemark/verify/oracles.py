"""What each query must return, as SQL over the test tables.

Written apart from the package code (own keys, own rule text) so that a slip
in a spec shows up as a difference.
"""

from __future__ import annotations

from tidemark.verify import change_sets
from tidemark.verify.queries import FIRST_LOAD_END, GRAINS, SAMPLE_ROWS, SEED, SHARE, SMALL_SHARE
from tidemark.verify.shapes import as_sql

# table: (columns in order, columns to trim, key, newest-first column)
LAYOUT: dict[str, tuple[list[str], set[str], list[str], str | None]] = {
    "customers": (
        "customer_id customer_unique_id customer_zip_code_prefix customer_city customer_state"
        " created_at updated_at".split(),
        {"customer_city", "customer_state"},
        ["customer_id"],
        "updated_at",
    ),
    "orders": (
        "order_id customer_id order_status order_purchase_timestamp order_approved_at"
        " order_delivered_carrier_date order_delivered_customer_date"
        " order_estimated_delivery_date created_at updated_at".split(),
        {"order_status"},
        ["order_id"],
        "updated_at",
    ),
    "order_items": (
        "order_id order_item_id product_id seller_id shipping_limit_date price freight_value"
        " created_at updated_at".split(),
        set(),
        ["order_id", "order_item_id"],
        "updated_at",
    ),
    "order_payments": (
        "order_id payment_sequential payment_type payment_installments payment_value"
        " created_at updated_at".split(),
        {"payment_type"},
        ["order_id", "payment_sequential"],
        "updated_at",
    ),
    "order_reviews": (
        "review_id order_id review_score review_comment_title review_comment_message"
        " review_creation_date review_answer_timestamp updated_at".split(),
        {"review_comment_title", "review_comment_message"},
        ["review_id", "order_id"],
        "updated_at",
    ),
    "geolocation": (
        "geolocation_zip_code_prefix geolocation_lat geolocation_lng geolocation_city"
        " geolocation_state".split(),
        {"geolocation_city", "geolocation_state"},
        [],
        None,
    ),
    "product_category_name_translation": (
        "product_category_name product_category_name_english".split(),
        {"product_category_name", "product_category_name_english"},
        ["product_category_name"],
        None,
    ),
    "products": (
        "product_id product_category_name product_name_lenght product_description_lenght"
        " product_photos_qty product_weight_g product_length_cm product_height_cm"
        " product_width_cm".split(),
        {"product_category_name"},
        ["product_id"],
        None,
    ),
    "sellers": (
        "seller_id seller_zip_code_prefix seller_city seller_state".split(),
        {"seller_city", "seller_state"},
        ["seller_id"],
        None,
    ),
}
INCREMENTAL = ["customers", "orders", "order_items", "order_payments", "order_reviews"]

VERDICT: dict[str, str] = {
    "customers": """CASE
        WHEN customer_id IS NULL THEN 'missing_customer_id'
        WHEN customer_zip_code_prefix < 0 OR customer_zip_code_prefix > 99999
            THEN 'invalid_zip_code'
        WHEN customer_state IS NULL OR trim(customer_state) = ''
            THEN 'missing_customer_state' END""",
    "orders": "CASE WHEN order_id IS NULL THEN 'missing_order_id' END",
    "order_items": """CASE
        WHEN order_id IS NULL THEN 'missing_order_id'
        WHEN order_item_id IS NULL THEN 'missing_order_item_id'
        WHEN product_id IS NULL THEN 'missing_product_id'
        WHEN seller_id IS NULL THEN 'missing_seller_id'
        WHEN shipping_limit_date IS NULL THEN 'missing_shipping_limit_date'
        WHEN price IS NULL THEN 'missing_price'
        WHEN freight_value IS NULL THEN 'missing_freight_value'
        WHEN price < 0 THEN 'negative_price'
        WHEN freight_value < 0 THEN 'negative_freight_value' END""",
    "order_payments": """CASE
        WHEN payment_installments <= 0 THEN 'invalid_payment_installments' END""",
    "order_reviews": """CASE
        WHEN review_score < 1 OR review_score > 5 THEN 'invalid_review_score'
        WHEN review_answer_timestamp < review_creation_date
            THEN 'answer_before_creation' END""",
    "products": """CASE
        WHEN product_id IS NULL THEN 'missing_product_id'
        WHEN product_weight_g IS NULL THEN 'missing_product_weight'
        WHEN product_length_cm IS NULL THEN 'missing_product_length'
        WHEN product_height_cm IS NULL THEN 'missing_product_height'
        WHEN product_width_cm IS NULL THEN 'missing_product_width'
        WHEN product_weight_g <= 0 THEN 'invalid_product_weight'
        WHEN product_length_cm <= 0 THEN 'invalid_product_length'
        WHEN product_height_cm <= 0 THEN 'invalid_product_height'
        WHEN product_width_cm <= 0 THEN 'invalid_product_width' END""",
}


def _short(table: str) -> str:
    return "translation" if table.endswith("translation") else table


class Script:
    """A WITH query built from named steps; each step is added once."""

    def __init__(self) -> None:
        self.steps: dict[str, str] = {}

    def step(self, name: str, body: str) -> str:
        self.steps.setdefault(name, body)
        return name

    def select(self, body: str) -> str:
        if not self.steps:
            return body
        parts = ",\n".join(f"{name} AS (\n{text}\n)" for name, text in self.steps.items())
        return f"WITH {parts}\n{body}"

    # -- layers ----------------------------------------------------------------

    def raw(self, table: str) -> str:
        return self.step(f"raw_{table}", as_sql(table))

    def one_per_key(self, name: str, rows: str, table: str) -> str:
        columns, _, keys, newest = LAYOUT[table]
        listed = ", ".join(columns)
        if not keys:
            return self.step(name, f"SELECT DISTINCT {listed} FROM {rows}")
        order = ([newest] if newest else []) + [
            c for c in columns if c not in keys and c != newest
        ]
        by = ", ".join(f"{c} DESC NULLS LAST" for c in order)
        return self.step(
            name,
            f"SELECT {listed} FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY {', '.join(keys)} ORDER BY {by}) AS nth FROM {rows}) WHERE nth = 1",
        )

    def cleaned(self, table: str, rows: str | None = None, tag: str = "") -> str:
        columns, trims, _, _ = LAYOUT[table]
        rows = rows or self.raw(table)
        trimmed = self.step(
            f"trim{tag}_{table}",
            "SELECT "
            + ", ".join(f"trim({c}) AS {c}" if c in trims else c for c in columns)
            + f" FROM {rows}",
        )
        return self.one_per_key(f"clean{tag}_{table}", trimmed, table)

    def judged(self, table: str, rows: str | None = None, tag: str = "") -> str:
        verdict = VERDICT.get(table, "CAST(NULL AS VARCHAR)")
        clean = self.cleaned(table, rows, tag)
        return self.step(
            f"judged{tag}_{table}", f"SELECT *, {verdict} AS quarantine_reason FROM {clean}"
        )

    def valid(self, table: str, rows: str | None = None, tag: str = "") -> str:
        listed = ", ".join(LAYOUT[table][0])
        judged = self.judged(table, rows, tag)
        return self.step(
            f"valid{tag}_{table}", f"SELECT {listed} FROM {judged} WHERE quarantine_reason IS NULL"
        )

    def bad(self, table: str, rows: str | None = None, tag: str = "") -> str:
        judged = self.judged(table, rows, tag)
        return self.step(
            f"bad{tag}_{table}", f"SELECT * FROM {judged} WHERE quarantine_reason IS NOT NULL"
        )

    # -- two loads ---------------------------------------------------------------

    def merge(self, name: str, old: str, new: str, keys: list[str], equal: str = "=") -> str:
        """State after an upsert whose source is unique per key."""
        on = " AND ".join(f"o.{k} {equal} n.{k}" for k in keys)
        return self.step(
            name,
            f"SELECT * FROM {new} UNION ALL BY NAME SELECT o.* FROM {old} o "
            f"WHERE NOT EXISTS (SELECT 1 FROM {new} n WHERE {on})",
        )

    def above(self, name: str, rows: str, marked: str) -> str:
        return self.step(
            name,
            f"SELECT * FROM {rows} WHERE (SELECT max(updated_at) FROM {marked}) IS NULL "
            f"OR updated_at >= (SELECT max(updated_at) FROM {marked})",
        )

    def first_load(self, table: str) -> str:
        return self.step(
            f"load1_{table}",
            f"SELECT * FROM {self.raw(table)} WHERE updated_at < {FIRST_LOAD_END[table]}",
        )

    def second_slice(self, table: str) -> str:
        first = self.valid(table, self.first_load(table), "1")
        return self.above(f"slice2_{table}", self.raw(table), first)

    def two_loads(self, table: str) -> str:
        first = self.valid(table, self.first_load(table), "1")
        second = self.valid(table, self.second_slice(table), "2")
        return self.merge(f"merged_{table}", first, second, LAYOUT[table][2])

    def bad_two_loads(self, table: str) -> str:
        first = self.bad(table, self.first_load(table), "1")
        second = self.bad(table, self.second_slice(table), "2")
        return self.merge(
            f"merged_bad_{table}", first, second, LAYOUT[table][2], "IS NOT DISTINCT FROM"
        )

    # -- a whole run of all layers, twice -------------------------------------------

    def run_bronze(self, table: str, run: int) -> str:
        """Bronze after run 1 or 2 over the source's state at that time."""
        keys = LAYOUT[table][2]
        if table not in INCREMENTAL:
            return self.one_per_key(f"now_{table}", self.raw(table), table) if keys else (
                self.raw(table)
            )
        old = self.one_per_key(f"then_{table}", self.first_load(table), table)
        if run == 1:
            return old
        now = self.one_per_key(f"now_{table}", self.raw(table), table)
        fresh = self.above(f"fresh_{table}", now, old)
        return self.merge(f"bronze2_{table}", old, fresh, keys)

    def run_silver(self, table: str) -> str:
        if table not in INCREMENTAL:
            return self.valid(table, self.run_bronze(table, 2), "_run")
        first = self.valid(table, self.run_bronze(table, 1), "_run1")
        fresh = self.above(f"silver_in_{table}", self.run_bronze(table, 2), first)
        second = self.valid(table, fresh, "_run2")
        return self.merge(f"silver_run_{table}", first, second, LAYOUT[table][2])

    def run_bad(self, table: str) -> str:
        if table not in INCREMENTAL:
            return self.bad(table, self.run_bronze(table, 2), "_run")
        self.run_silver(table)
        first = self.bad(table, self.run_bronze(table, 1), "_run1")
        second = self.bad(table, f"silver_in_{table}", "_run2")
        return self.merge(
            f"bad_run_{table}", first, second, LAYOUT[table][2], "IS NOT DISTINCT FROM"
        )

    # -- change sets -------------------------------------------------------------------

    def now(self, table: str) -> str:
        """One current row for each key."""
        return self.one_per_key(f"now_{table}", self.raw(table), table) if LAYOUT[table][2] else self.raw(table)

    def after_changes(self, table: str) -> str:
        """Silver after all change sets: none of them turns a row bad."""
        rows = self.now(table)
        for k in change_sets.STEPS if table in change_sets.HITS else ():
            rows = self.step(f"after{k}_{table}", change_sets.changed_sql(table, rows, k))
        return self.valid(table, rows, "_after")

    # -- marts -----------------------------------------------------------------------

    def per_order(self, items: str, payments: str, reviews: str) -> tuple[str, str, str]:
        return (
            self.step(
                "per_order_items",
                f"""SELECT order_id, count(*) AS item_line_count,
                CAST(sum(price) AS DECIMAL(18, 2)) AS total_product_value,
                CAST(sum(freight_value) AS DECIMAL(18, 2)) AS total_freight_value
                FROM {items} GROUP BY order_id""",
            ),
            self.step(
                "per_order_payments",
                f"""SELECT order_id, count(*) AS payment_count,
                CAST(sum(payment_value) AS DECIMAL(18, 2)) AS total_payment_value
                FROM {payments} GROUP BY order_id""",
            ),
            self.step(
                "per_order_reviews",
                f"""SELECT order_id, count(*) AS review_count,
                round(avg(review_score), 2) AS average_review_score
                FROM {reviews} GROUP BY order_id""",
            ),
        )

    def fact(self, layer=None) -> str:
        layer = layer or self.valid
        i, p, r = self.per_order(*[layer(f"order_{t}") for t in ("items", "payments", "reviews")])
        orders = layer("orders")
        return self.step(
            "fact",
            f"""SELECT o.* EXCLUDE (created_at, updated_at),
            coalesce(item_line_count, 0) AS item_line_count,
            total_product_value, total_freight_value,
            coalesce(payment_count, 0) AS payment_count, total_payment_value,
            coalesce(review_count, 0) AS review_count, average_review_score
            FROM {orders} o
            LEFT JOIN {i} i ON i.order_id = o.order_id
            LEFT JOIN {p} p ON p.order_id = o.order_id
            LEFT JOIN {r} r ON r.order_id = o.order_id""",
        )

    def per_customer(self, layer=None) -> str:
        return self.step(
            "per_customer",
            f"""SELECT customer_id, count(*) AS order_count,
            CAST(sum(total_product_value) AS DECIMAL(18, 2)) AS total_product_value,
            min(order_purchase_timestamp) AS first_order_timestamp,
            max(order_purchase_timestamp) AS last_order_timestamp
            FROM {self.fact(layer)} GROUP BY customer_id""",
        )

    def per_product(self, layer=None) -> str:
        return self.step(
            "per_product",
            f"""SELECT product_id, count(*) AS order_line_count,
            count(DISTINCT order_id) AS order_count,
            CAST(sum(price) AS DECIMAL(18, 2)) AS total_product_value,
            CAST(sum(freight_value) AS DECIMAL(18, 2)) AS total_freight_value
            FROM {(layer or self.valid)("order_items")} GROUP BY product_id""",
        )

    def customer_mart(self, layer=None) -> str:
        return self.step(
            "customer_mart",
            f"""SELECT c.* EXCLUDE (created_at, updated_at),
            coalesce(s.order_count, 0) AS order_count,
            CAST(coalesce(s.total_product_value, 0) AS DECIMAL(18, 2)) AS total_product_value,
            s.first_order_timestamp, s.last_order_timestamp
            FROM {(layer or self.valid)("customers")} c
            LEFT JOIN {self.per_customer(layer)} s ON s.customer_id = c.customer_id""",
        )

    def product_mart(self, layer=None) -> str:
        return self.step(
            "product_mart",
            f"""SELECT
            p.* EXCLUDE (product_name_lenght, product_description_lenght),
            coalesce(s.order_line_count, 0) AS order_line_count,
            coalesce(s.order_count, 0) AS order_count,
            CAST(coalesce(s.total_product_value, 0) AS DECIMAL(18, 2)) AS total_product_value,
            CAST(coalesce(s.total_freight_value, 0) AS DECIMAL(18, 2)) AS total_freight_value
            FROM {(layer or self.valid)("products")} p
            LEFT JOIN {self.per_product(layer)} s ON s.product_id = p.product_id""",
        )

    # -- seeded draws ---------------------------------------------------------------

    def shuffled(self, name: str, rows: str, keys: list[str], seed: str) -> str:
        """Rows with their position in the order of a seeded key digest."""
        order = ", ".join([_digest(seed, *keys), *keys])
        return self.step(
            name, f"SELECT *, row_number() OVER (ORDER BY {order}) AS position FROM {rows}"
        )

    def sampled(self, name: str, rows: str, keys: list[str], seed: str, wanted: str) -> str:
        """The first rows of the shuffled order; ``wanted`` is SQL over the row count n."""
        ranked = self.shuffled(f"{name}_ranked", rows, keys, seed)
        return self.step(
            name,
            f"SELECT * EXCLUDE (position) FROM {ranked} "
            f"WHERE position <= (SELECT {wanted} FROM (SELECT count(*) AS n FROM {rows}))",
        )


def _digest(seed: str, *keys: str) -> str:
    texts = " || '|' || ".join(f"coalesce(CAST({k} AS VARCHAR), '')" for k in keys)
    return f"md5('{seed}|' || {texts})"


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


# -- the queries -------------------------------------------------------------------


def _cleaning() -> dict[str, str]:
    found = {}
    for table in LAYOUT:
        s = Script()
        found[f"clean_{_short(table)}"] = s.select(f"SELECT * FROM {s.cleaned(table)}")
    for table in VERDICT:
        s = Script()
        found[f"silver_{table}"] = s.select(f"SELECT * FROM {s.valid(table)}")
        s = Script()
        found[f"quarantine_{table}"] = s.select(f"SELECT * FROM {s.bad(table)}")
    s = Script()
    found["quarantine_reason_counts"] = s.select(
        _union(
            [
                f"SELECT '{t}' AS table_name, quarantine_reason, count(*) AS row_count "
                f"FROM {s.judged(t)} GROUP BY quarantine_reason"
                for t in VERDICT
            ]
        )
    )
    return found


def _incremental() -> dict[str, str]:
    found = {}
    s = Script()
    found["watermark_max"] = s.select(
        _union(
            [
                f"SELECT '{t}' AS table_name, CAST(max(updated_at) AS TIMESTAMP) AS watermark "
                f"FROM {s.valid(t)}"
                for t in INCREMENTAL
            ]
        )
    )
    s = Script()
    found["incremental_slice"] = s.select(f"SELECT * FROM {s.second_slice('orders')}")
    s = Script()
    raw, clean = s.raw("order_payments"), s.cleaned("order_payments")
    newer = s.step(
        "newer",
        f"SELECT * REPLACE ('merged ' || payment_type AS payment_type) FROM {clean} "
        "WHERE payment_installments > 10 OR payment_installments IS NULL",
    )
    columns = LAYOUT["order_payments"][0]
    picked = ", ".join(
        f"CASE WHEN n.payment_type IS NULL THEN o.{c} ELSE n.{c} END AS {c}" for c in columns
    )
    on = "o.order_id = n.order_id AND o.payment_sequential = n.payment_sequential"
    found["upsert_many_targets"] = s.select(
        f"SELECT {picked} FROM {raw} o LEFT JOIN {newer} n ON {on} UNION ALL "
        f"SELECT * FROM {newer} n WHERE NOT EXISTS (SELECT 1 FROM {raw} o WHERE {on})"
    )
    for name, table in (("upsert_null_safe", "orders"), ("quarantine_merge", "order_items")):
        s = Script()
        found[name] = s.select(f"SELECT * FROM {s.bad_two_loads(table)}")
    for table in INCREMENTAL:
        s = Script()
        found[f"two_loads_{table}"] = s.select(f"SELECT * FROM {s.two_loads(table)}")
    return found


def _marts() -> dict[str, str]:
    found = {}
    for name, position in (
        ("order_item_summary", 0),
        ("order_payment_summary", 1),
        ("order_review_summary", 2),
    ):
        s = Script()
        steps = s.per_order(*[s.valid(f"order_{t}") for t in ("items", "payments", "reviews")])
        found[name] = s.select(f"SELECT * FROM {steps[position]}")
    s = Script()
    found["item_summary_fine_amounts"] = s.select(
        f"""SELECT order_id, count(*) AS item_line_count,
        CAST(sum(CAST(price * 0.001 AS DECIMAL(12, 4))) AS DECIMAL(18, 2)) AS total_product_value,
        CAST(sum(CAST(CAST(freight_value AS DOUBLE) * 0.125 AS DECIMAL(28, 10)))
            AS DECIMAL(18, 2)) AS total_freight_value
        FROM {s.valid("order_items")} GROUP BY order_id"""
    )
    for name, build in (
        ("customer_order_summary", Script.per_customer),
        ("product_sales_summary", Script.per_product),
        ("fact_orders", Script.fact),
        ("customer_summary", Script.customer_mart),
        ("product_summary", Script.product_mart),
    ):
        s = Script()
        found[name] = s.select(f"SELECT * FROM {build(s)}")
    return found


def _runs() -> dict[str, str]:
    found = {}
    s = Script()
    valid = s.valid("orders")
    versions = s.step(
        "two_versions",
        f"""SELECT * FROM {valid} UNION ALL SELECT * REPLACE ('older' AS order_status,
        updated_at - INTERVAL 900 DAY AS updated_at) FROM {valid}""",
    )
    newest = s.step(
        "newest",
        f"SELECT * FROM {versions} WHERE updated_at >= (SELECT max(updated_at) FROM {versions})",
    )
    found["bronze_repeated_keys"] = s.select(
        f"""SELECT n.* FROM {versions} b JOIN {newest} n ON b.order_id = n.order_id
        UNION ALL SELECT b.* FROM {versions} b
        WHERE NOT EXISTS (SELECT 1 FROM {newest} n WHERE n.order_id = b.order_id)"""
    )
    s = Script()
    parts = [("bronze", t, s.run_bronze(t, 2)) for t in LAYOUT]
    parts += [("silver", t, s.run_silver(t)) for t in LAYOUT]
    parts += [("quarantine", t, s.run_bad(t)) for t in VERDICT]
    found["run_row_counts"] = s.select(
        _union(
            [
                f"SELECT '{layer}.{t}' AS table_name, count(*) AS row_count FROM {step}"
                for layer, t, step in parts
            ]
        )
    )
    for table in ("orders", "order_items"):
        s = Script()
        found[f"run_bronze_{table}"] = s.select(f"SELECT * FROM {s.run_bronze(table, 2)}")
    for table in ("order_items", "products"):
        s = Script()
        found[f"run_quarantine_{table}"] = s.select(f"SELECT * FROM {s.run_bad(table)}")
    for table in LAYOUT:
        s = Script()
        found[f"run_silver_{_short(table)}"] = s.select(f"SELECT * FROM {s.run_silver(table)}")
    for mart, build in (
        ("fact_orders", Script.fact),
        ("customer_summary", Script.customer_mart),
        ("product_summary", Script.product_mart),
    ):
        s = Script()
        found[f"run_gold_{mart}"] = s.select(f"SELECT * FROM {build(s, s.run_silver)}")
        s = Script()
        found[f"refreshed_{mart}"] = s.select(f"SELECT * FROM {build(s, s.after_changes)}")

    s = Script()
    bad = s.bad("order_payments", s.now("order_payments"), "_now")
    fate, again = change_sets.FATE, f"{change_sets.FATE} = 4"
    found["quarantine_cleared"] = s.select(
        f"""SELECT * REPLACE (CASE WHEN {again} THEN 0 ELSE payment_installments END AS payment_installments,
        CASE WHEN {again} THEN TIMESTAMP '2031-01-03 00:00:00' ELSE updated_at END AS updated_at)
        FROM {bad} WHERE {fate} % 2 = 1 OR {again}"""
    )

    s = Script()
    now = s.now("orders")
    punctual = s.step("punctual", f"SELECT * FROM {now} WHERE NOT coalesce({change_sets.LATE}, false)")
    first = s.valid("orders", punctual, "_first")
    every = s.valid("orders", now, "_every")
    window = f"INTERVAL {change_sets.LOOKBACK_DAYS} DAY"
    found["lookback_orders"] = s.select(
        f"""SELECT * FROM {every} WHERE NOT {change_sets.LATE} OR (
        updated_at >= (SELECT max(updated_at) FROM {punctual}) - {window}
        AND updated_at >= (SELECT max(updated_at) FROM {first}) - {window})"""
    )
    return found


def _grain_of(label: str, rows: str, keys: list[str]) -> str:
    full = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    return (
        f"SELECT '{label}' AS table_name, CAST(sum(n) AS BIGINT) AS total_rows, "
        f"count(*) AS distinct_keys, count(*) FILTER (WHERE {full}) AS distinct_full_keys, "
        f"count(*) FILTER (WHERE n > 1) AS repeated_keys FROM "
        f"(SELECT {', '.join(keys)}, count(*) AS n FROM {rows} GROUP BY {', '.join(keys)})"
    )


def _flag(table: str | None, name: str, rows: str, predicate: str) -> str:
    label = f"'{table}' AS table_name, " if table else ""
    return (
        f"SELECT {label}'{name}' AS check_name, count(*) AS violations "
        f"FROM {rows} WHERE {predicate}"
    )


def _top(table: str, key: str, measures: str = "") -> str:
    s = Script()
    return s.select(
        f"SELECT {key}, count(*) AS row_count{measures} FROM {s.valid(table)} "
        f"GROUP BY {key} ORDER BY row_count DESC, {key} NULLS FIRST LIMIT 10"
    )


def _profile_of(label: str, table: str, rows: str, checks: list[tuple[str, str, str]]) -> list[str]:
    """Row count, NULLs per column and flagged rows of one table, as statements to unite."""
    parts = [f"SELECT '{label}' AS table_name, 'rows' AS measure, count(*) AS row_count FROM {rows}"]
    parts += [f"SELECT '{label}', 'nulls:{c}', count(*) - count({c}) FROM {rows}" for c in LAYOUT[table][0]]
    parts += [
        f"SELECT '{label}', 'check:{n}', count(*) FROM {rows} WHERE {p}" for t, n, p in checks if t == table
    ]
    return parts


def _profiles() -> dict[str, str]:
    found = {}
    s = Script()
    found["profile_grain"] = s.select(
        _union(
            [
                _grain_of(
                    label,
                    s.raw(label.split(".")[0]),
                    keys or LAYOUT[label.split(".")[0]][0],
                )
                for label, keys in GRAINS.items()
            ]
        )
    )
    s = Script()
    found["profile_gold_grain"] = s.select(
        _union(
            [
                _grain_of("fact_orders", s.fact(), ["order_id"]),
                _grain_of("customer_summary", s.customer_mart(), ["customer_id"]),
                _grain_of("product_summary", s.product_mart(), ["product_id"]),
            ]
        )
    )
    s = Script()
    found["profile_nulls"] = s.select(
        _union(
            [
                f"SELECT '{t}' AS table_name, '{c}' AS column_name, "
                f"count(*) - count({c}) AS null_count FROM {s.raw(t)}"
                for t in LAYOUT
                for c in LAYOUT[t][0]
            ]
        )
    )
    s = Script()
    found["profile_frequency"] = s.select(
        f"SELECT 'order_status' AS column_name, order_status AS value, count(*) AS row_count "
        f"FROM {s.cleaned('orders')} GROUP BY order_status UNION ALL "
        f"SELECT 'customer_state', customer_state, count(*) "
        f"FROM {s.valid('customers')} GROUP BY customer_state"
    )
    s = Script()
    found["profile_duplicate_keys"] = s.select(
        f"SELECT customer_id, count(*) AS row_count FROM {s.raw('customers')} "
        "GROUP BY customer_id HAVING count(*) > 1"
    )
    found["profile_top_persons"] = _top("customers", "customer_unique_id")
    found["profile_top_customers"] = _top("orders", "customer_id")
    found["profile_top_orders"] = _top(
        "order_items",
        "order_id",
        ", CAST(sum(price) AS DECIMAL(22, 2)) AS total_product_value"
        ", CAST(sum(freight_value) AS DECIMAL(22, 2)) AS total_freight_value",
    )
    found["profile_top_payments"] = _top(
        "order_payments",
        "order_id",
        ", CAST(sum(payment_value) AS DECIMAL(22, 2)) AS total_payment_value",
    )
    found["profile_top_reviews"] = _top(
        "order_reviews", "order_id", ", avg(review_score) AS average_review_score"
    )
    s = Script()
    counted = ", ".join(
        f"count(DISTINCT {c}) AS distinct_{c}"
        for c in LAYOUT["customers"][0]
        if c not in ("customer_unique_id", "created_at", "updated_at")
    )
    found["profile_attribute_drift"] = s.select(
        f"SELECT customer_unique_id, {counted} FROM {s.raw('customers')} "
        "GROUP BY customer_unique_id"
    )
    s = Script()
    sizes = ["product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"]
    size_missing = " OR ".join(f"{c} IS NULL" for c in sizes)
    size_bad = " OR ".join(f"{c} <= 0" for c in sizes)
    ranges = [
        (
            "customers",
            "zip_out_of_range",
            "customer_zip_code_prefix < 0 OR customer_zip_code_prefix > 99999",
        ),
        ("customers", "state_missing", "customer_state IS NULL OR customer_state = ''"),
        (
            "sellers",
            "zip_out_of_range",
            "seller_zip_code_prefix < 0 OR seller_zip_code_prefix > 99999",
        ),
        ("order_items", "price_negative", "price < 0"),
        ("order_items", "freight_negative", "freight_value < 0"),
        ("order_payments", "value_negative", "payment_value < 0"),
        ("order_payments", "installments_not_positive", "payment_installments <= 0"),
        ("order_reviews", "score_out_of_range", "review_score < 1 OR review_score > 5"),
        ("products", "size_missing", size_missing),
        ("products", "size_not_positive", size_bad),
        ("products", "photos_negative", "product_photos_qty < 0"),
        (
            "products",
            "text_length_negative",
            "product_name_lenght < 0 OR product_description_lenght < 0",
        ),
        ("geolocation", "latitude_out_of_range", "geolocation_lat < -90 OR geolocation_lat > 90"),
        (
            "geolocation",
            "longitude_out_of_range",
            "geolocation_lng < -180 OR geolocation_lng > 180",
        ),
    ]
    found["profile_range_checks"] = s.select(
        _union([_flag(t, n, s.raw(t), p) for t, n, p in ranges])
    )
    s = Script()
    bought, carried, delivered = (
        "order_purchase_timestamp",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
    )
    times = [
        ("orders", "approved_before_purchase", f"order_approved_at < {bought}"),
        ("orders", "carrier_before_purchase", f"{carried} < {bought}"),
        ("orders", "delivered_before_purchase", f"{delivered} < {bought}"),
        ("orders", "delivered_before_carrier", f"{delivered} < {carried}"),
        (
            "order_reviews",
            "answer_before_creation",
            "review_answer_timestamp < review_creation_date",
        ),
    ]
    found["profile_time_order"] = s.select(
        _union([_flag(t, n, s.raw(t), p) for t, n, p in times])
    )
    s = Script()
    status = [
        (
            "orders",
            f"delivered_without_{who}_date",
            f"order_status = 'delivered' AND order_delivered_{who}_date IS NULL",
        )
        for who in ("customer", "carrier")
    ]
    checks = ranges + times + status
    profiled = Script()
    parts = []
    for t in LAYOUT:
        parts += _profile_of(f"bronze.{t}", t, profiled.run_bronze(t, 2), checks)
        parts += _profile_of(f"silver.{t}", t, profiled.run_silver(t), checks)
    found["run_profiles"] = profiled.select(_union(parts))
    one_pass = [
        f"SELECT '{t}' AS table_name, 'rows' AS measure, count(*) AS row_count FROM {s.raw(t)}"
        for t in LAYOUT
    ]
    one_pass += [
        f"SELECT '{t}', 'nulls:{c}', count(*) - count({c}) FROM {s.raw(t)}"
        for t in LAYOUT
        for c in LAYOUT[t][0]
    ]
    one_pass += [
        f"SELECT '{t}', 'check:{n}', count(*) FROM {s.raw(t)} WHERE {p}"
        for t, n, p in ranges + times + status
    ]
    found["profile_one_pass"] = s.select(_union(one_pass))
    s = Script()
    orders = s.cleaned("orders")
    found["profile_status_mismatch"] = s.select(
        _union([_flag(None, n, orders, p) for _, n, p in status])
    )
    s = Script()
    shown = f"order_id, order_status, {bought}, {carried}, {delivered}"
    found["profile_bad_samples"] = s.select(
        _union(
            [
                f"SELECT * FROM (SELECT '{name}' AS check_name, {shown} FROM {s.valid('orders')} "
                f"WHERE {predicate} ORDER BY order_id LIMIT 10)"
                for _, name, predicate in times
                if name in ("carrier_before_purchase", "delivered_before_carrier")
            ]
        )
    )
    s = Script()
    products = s.cleaned("products")
    found["profile_bad_products"] = s.select(
        _union(
            [
                f"SELECT * FROM (SELECT '{name}' AS check_name, * FROM {products} "
                f"WHERE {predicate} ORDER BY product_id NULLS FIRST LIMIT 10)"
                for name, predicate in (
                    ("size_missing", size_missing),
                    ("size_not_positive", size_bad),
                )
            ]
        )
    )
    s = Script()
    found["profile_orphans"] = s.select(
        _union(
            [
                f"SELECT '{child}->{parent}' AS relation, count(*) AS orphan_keys FROM "
                f"(SELECT DISTINCT {key} FROM {s.raw(child)}) c WHERE NOT EXISTS "
                f"(SELECT 1 FROM {s.raw(parent)} p WHERE p.{key} = c.{key})"
                for child, parent, key in (
                    ("orders", "customers", "customer_id"),
                    ("order_items", "orders", "order_id"),
                    ("order_items", "products", "product_id"),
                    ("order_items", "sellers", "seller_id"),
                    ("order_payments", "orders", "order_id"),
                )
            ]
        )
    )
    s = Script()
    unknown = (
        f"FROM {s.valid('order_items')} i LEFT JOIN {s.valid('products')} p "
        "ON p.product_id = i.product_id WHERE p.product_id IS NULL"
    )
    found["orphan_products"] = s.select(f"SELECT DISTINCT i.product_id {unknown}")
    found["orphan_product_value"] = s.select(
        f"SELECT CAST(sum(i.price) AS DECIMAL(28, 2)) AS orphan_value {unknown}"
    )
    s = Script()
    found["profile_childless"] = s.select(
        f"SELECT count(*) AS childless_rows FROM {s.valid('customers')} c LEFT JOIN "
        f"{s.valid('orders')} o ON o.customer_id = c.customer_id WHERE o.customer_id IS NULL"
    )
    s = Script()
    found["profile_coverage"] = s.select(
        "SELECT 'customers.zip' AS column_name, count(DISTINCT customer_zip_code_prefix) "
        f"AS distinct_values, count(*) AS total_rows FROM {s.valid('customers')} UNION ALL "
        "SELECT 'order_items.product', count(DISTINCT product_id), count(*) "
        f"FROM {s.valid('order_items')}"
    )
    s = Script()
    joins = " ".join(
        f"LEFT JOIN {s.valid(t)} {t} ON {t}.order_id = o.order_id"
        for t in ("order_items", "order_payments", "order_reviews")
    )
    found["profile_fanout"] = s.select(
        "SELECT CAST(count(*) AS DECIMAL(38, 0)) AS rows_after_join, "
        "count(DISTINCT o.order_id) AS distinct_keys "
        f"FROM {s.valid('orders')} o {joins}"
    )
    s = Script()
    found["profile_repeated_pairs"] = s.select(
        f"SELECT product_id, order_id, count(*) AS row_count FROM {s.valid('order_items')} "
        "GROUP BY product_id, order_id HAVING count(*) > 1"
    )
    s = Script()

    def total(expression: str, rows: str) -> str:
        return f"(SELECT CAST(coalesce(sum({expression}), 0) AS DECIMAL(28, 2)) FROM {rows})"

    items, known = s.valid("order_items"), s.valid("products")
    sums = s.step(
        "sums",
        f"""SELECT
        (SELECT CAST(sum(order_count) AS BIGINT) FROM {s.customer_mart()})
            AS summarized_order_count,
        {total("total_product_value", s.customer_mart())} AS customer_summary_total,
        {total("total_product_value", s.fact())} AS fact_orders_total,
        {total("total_product_value", s.product_mart())} AS product_summary_total,
        {total("price", items)} AS order_items_total,
        {total("price", f"{items} i LEFT JOIN {known} p USING (product_id) "
                        "WHERE p.product_weight_g IS NULL")} AS orphan_product_value""",
    )
    found["reconcile_gold"] = s.select(
        "SELECT *, CAST(fact_orders_total - customer_summary_total AS DECIMAL(28, 2)) "
        "AS customer_value_diff, CAST(order_items_total - product_summary_total "
        f"- orphan_product_value AS DECIMAL(28, 2)) AS product_value_diff FROM {sums}"
    )
    s = Script()
    found["row_counts"] = s.select(
        _union(
            [
                f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {s.valid(t)}"
                for t in LAYOUT
            ]
        )
    )
    s = Script()
    found["entity_order_lines"] = s.select(
        "SELECT order_item_id, product_id, price, freight_value "
        f"FROM {s.valid('order_items')} WHERE order_id = 12"
    )
    s = Script()
    found["entity_payments"] = s.select(
        "SELECT payment_sequential, payment_type, payment_installments, payment_value "
        f"FROM {s.valid('order_payments')} WHERE order_id = 12"
    )
    s = Script()
    found["entity_person"] = s.select(
        f"SELECT * FROM {s.valid('customers')} WHERE customer_unique_id = 20"
    )
    for name, condition in (
        ("entity_activity", "WHERE c.customer_unique_id = 20"),
        ("person_activity", ""),
    ):
        s = Script()
        found[name] = s.select(
            "SELECT c.customer_unique_id, count(DISTINCT c.customer_id) AS parent_keys, "
            f"count(DISTINCT o.order_id) AS child_keys FROM {s.valid('customers')} c "
            f"LEFT JOIN {s.valid('orders')} o ON o.customer_id = c.customer_id {condition} "
            "GROUP BY c.customer_unique_id"
        )
    s = Script()
    found["preview_orders"] = s.select(
        f"SELECT * FROM {s.valid('orders')} ORDER BY order_id LIMIT 10"
    )
    return found


def _changes() -> dict[str, str]:
    found = {}
    s = Script()
    found["product_seller_pairs"] = s.select(
        f"SELECT DISTINCT product_id, seller_id FROM {s.raw('order_items')} "
        "WHERE product_id IS NOT NULL AND seller_id IS NOT NULL"
    )
    s = Script()
    found["open_orders"] = s.select(
        f"SELECT * FROM {s.valid('orders')} "
        "WHERE order_status IN ('created', 'approved', 'processing', 'shipped')"
    )
    for query, wanted in (
        ("shuffled_sample", f"CAST(ceil(n * CAST({SHARE} AS DECIMAL(9, 6))) AS BIGINT)"),
        ("shuffled_sample_rows", str(SAMPLE_ROWS)),
        ("shuffled_sample_small_share", f"CAST(ceil(n * CAST({SMALL_SHARE} AS DECIMAL(9, 6))) AS BIGINT)"),
    ):
        s = Script()
        picked = s.sampled("picked", s.valid("orders"), ["order_id"], SEED, wanted)
        found[query] = s.select(f"SELECT * FROM {picked}")
    return found


def all_oracles() -> dict[str, str]:
    return {
        **_cleaning(),
        **_incremental(),
        **_marts(),
        **_profiles(),
        **_changes(),
        **_runs(),
    }
