"""Change sets over the shop's tables, as SQL text that both engines run.

``{k}`` is the number of the change set. Hit rows take new values, some orders
and their lines are copied under new ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STEPS = (1, 2, 3)

#: Which rows a change set hits, and their new values. An order moves to another customer.
HITS = {
    "customers": ("customer_id % 40 = {k}", {"customer_city": "'moved'"}),
    "orders": ("order_id % 40 = {k}", {"customer_id": "customer_id + 1"}),
    "order_items": ("order_id % 40 = {k} AND price >= 0", {"price": "CAST(price + {k} AS DECIMAL(12, 2))"}),
    "order_payments": ("order_id % 40 = {k}", {"payment_value": "CAST(payment_value + 1 AS DECIMAL(12, 2))"}),
}
#: Which rows are copied, and the id of the copies.
COPIES = {table: ("order_id % 500 = {k}", {"order_id": "order_id + {k} * 100000000000"}) for table in ("orders", "order_items")}

# Payments that are repaired in the second load, spoiled again in the third and
# repaired again in the fourth; FATE decides, rows without an order included.
FATE = "coalesce(order_id, 0) % 8"
SPOILED = "payment_installments <= 0"

_COPY = "__copy"

LATE = "order_id % 5 = 0"
LOOKBACK_DAYS = 1000


def changed(table: str, rows: DataFrame, k: int) -> DataFrame:
    """The table after change set ``k``; what it touches is newer than anything before."""
    now = F.expr(f"DATE '2031-01-0{k}'").cast(rows.schema["updated_at"].dataType)
    hit, values = HITS[table]
    hit = F.coalesce(F.expr(hit.format(k=k)), F.lit(False))
    fresh = {c: F.when(hit, F.expr(text.format(k=k))).otherwise(F.col(c)) for c, text in values.items()}
    fresh["updated_at"] = F.when(hit, now).otherwise(F.col("updated_at"))
    if table not in COPIES:
        after = rows.withColumns(fresh)
    else:
        # A chosen row is there twice, changed and as its copy; so the table is read once.
        chosen, values = COPIES[table]
        chosen = F.coalesce(F.expr(chosen.format(k=k)), F.lit(False))
        both = F.when(chosen, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
        copied = {c: F.expr(text.format(k=k)) for c, text in values.items()} | {"updated_at": now}
        after = rows.withColumn(_COPY, F.explode(both)).withColumns(
            {
                c: F.when(F.col(_COPY), copied.get(c, F.col(c))).otherwise(fresh.get(c, F.col(c)))
                for c in fresh | copied
            }
        )
    return after.select(*[F.col(f.name).cast(f.dataType) for f in rows.schema.fields])


def changed_sql(table: str, rows: str, k: int) -> str:
    """The same as SQL, without the times of change."""
    hit, values = HITS[table]
    fresh = ", ".join(f"CASE WHEN {hit} THEN {text} ELSE {c} END AS {c}" for c, text in values.items())
    made = f"SELECT * REPLACE ({fresh}) FROM {rows}"
    if table in COPIES:
        chosen, values = COPIES[table]
        fresh = ", ".join(f"{text} AS {c}" for c, text in values.items())
        made += f" UNION ALL SELECT * REPLACE ({fresh}) FROM {rows} WHERE {chosen}"
    return made.format(k=k)


def payments_at(rows: DataFrame, load: int) -> DataFrame:
    """Payments in load 1 to 4: some rejected ones are good, bad and good again."""
    spoiled = F.expr(SPOILED)
    for number, every, value in ((2, 2, 1), (3, 4, 0), (4, 8, 1)):
        if number <= load:
            hit = F.coalesce(spoiled & F.expr(f"{FATE} % {every} = 0"), F.lit(False))
            now = F.expr(f"DATE '2031-01-0{number}'").cast(rows.schema["updated_at"].dataType)
            rows = rows.withColumn("updated_at", F.when(hit, now).otherwise(F.col("updated_at"))).withColumn(
                f"__value{number}", F.when(hit, value)
            )
    latest = [F.col(f"__value{n}") for n in range(load, 1, -1)]
    kept = F.coalesce(*latest, F.col("payment_installments")).cast(rows.schema["payment_installments"].dataType)
    return rows.withColumn("payment_installments", kept).drop(*[f"__value{n}" for n in range(2, load + 1)])
