"""A small hand-made store that holds the edge cases of the definitions."""

from __future__ import annotations

from ledgerlark.sources.schemas import SPEC
from ledgerlark.sources.tables import Tables

# ann has two customer ids; eve has an order without items; the newest order (o9) is not delivered.
CUSTOMERS = [
    ("c1", "ann", "01151", "city a", "SP"),
    ("c2", "ann", "01151", "city a", "SP"),
    ("c3", "bob", "22000", "city b", "RJ"),
    ("c4", "cid", "22001", "city b", "RJ"),
    ("c5", "eve", "30000", "city c", "MG"),
]

# order, customer, status, purchased, delivered, estimated
ORDERS = [
    ("o1", "c1", "delivered", "2017-12-05 10:00:00", "2017-12-10 23:59:00", "2017-12-10 00:00:00"),  # last day, late hour
    ("o2", "c2", "delivered", "2018-02-03 10:00:00", "2018-02-05 08:00:00", "2018-02-10 00:00:00"),  # five days early
    ("o3", "c3", "delivered", "2017-12-20 10:00:00", "2018-01-09 08:00:00", "2018-01-06 00:00:00"),  # three days late
    ("o4", "c4", "delivered", "2018-07-01 10:00:00", None, "2018-07-20 00:00:00"),  # no delivery day
    ("o5", "c5", "delivered", "2018-02-10 10:00:00", "2018-02-12 10:00:00", "2018-02-12 00:00:00"),  # no items
    ("o6", "c3", "delivered", "2018-07-15 10:00:00", "2018-07-16 10:00:00", "2018-07-20 00:00:00"),  # seven months later
    ("o9", "c4", "shipped", "2018-08-01 00:00:00", None, "2018-08-20 00:00:00"),
]

# order, line, product, seller, price, freight
ITEMS = [
    ("o1", 1, "p1", "s1", "10.00", "1.00"),
    ("o1", 2, "p2", "s2", "20.00", "2.00"),
    ("o2", 1, "p1", "s1", "60.00", "7.00"),
    ("o3", 1, "p3", "s1", "90.00", "10.00"),
    ("o4", 1, "p3", "s2", "0.00", "0.00"),
    ("o6", 1, "p4", "s2", "5.00", "0.05"),
    ("o9", 1, "p1", "s1", "999.00", "1.00"),
]

PRODUCTS = [("p1", "toys"), ("p2", "unmapped"), ("p3", None), ("p4", "toys")]
TRANSLATION = [("toys", "toys_en")]
SELLERS = [("s1", "01000", "city a", "SP"), ("s2", "22000", "city b", "RJ")]
PAYMENTS = [
    ("o1", 1, "credit_card", 3, "30.00"),
    ("o1", 2, "voucher", 1, "3.00"),
    ("o2", 1, "credit_card", 2, "67.00"),
    ("o9", 1, "credit_card", 1, "1000.00"),
]
REVIEWS = [("r1", "o1", 5), ("r1", "o2", 4), ("r2", "o3", 1)]


def inline(spark, columns: str, rows: list[tuple]):
    """Text rows as a literal relation."""
    values = ", ".join("(" + ", ".join("NULL" if v is None else f"'{v}'" for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(columns.split())})")


def make_shop(spark, **changes) -> Tables:
    """The store as Tables; keyword arguments replace the rows of a table."""

    def frame(name: str, columns: str, rows: list[tuple]):
        rows = changes.get(name, rows)
        raw = inline(spark, columns, rows)
        spec = SPEC[name]
        return raw.selectExpr(
            *[
                f"CAST({f.name} AS {f.type.simpleString()}) AS {f.name}"
                if f.name in raw.columns
                else f"CAST(NULL AS {f.type.simpleString()}) AS {f.name}"
                for f in spec.fields
            ]
        )

    def text(rows):
        return [tuple(None if v is None else str(v) for v in row) for row in rows]

    stamp = "2018-01-01 00:00:00"
    stamps = {"order_items": 1, "order_reviews": 2}

    def pad(name: str, rows: list[tuple]) -> list[tuple]:
        return text([(*row, *[stamp] * stamps.get(name, 0)) for row in rows])

    changes = {name: pad(name, rows) for name, rows in changes.items()}
    return Tables(
        customers=frame(
            "customers",
            "customer_id customer_unique_id customer_zip_code_prefix customer_city customer_state",
            text(CUSTOMERS),
        ),
        product_category_translation=frame(
            "product_category_translation", "product_category_name product_category_name_english", text(TRANSLATION)
        ),
        products=frame("products", "product_id product_category_name", text(PRODUCTS)),
        sellers=frame("sellers", "seller_id seller_zip_code_prefix seller_city seller_state", text(SELLERS)),
        orders=frame(
            "orders",
            "order_id customer_id order_status order_purchase_timestamp order_delivered_customer_date "
            "order_estimated_delivery_date",
            text(ORDERS),
        ),
        order_items=frame(
            "order_items",
            "order_id order_item_id product_id seller_id price freight_value shipping_limit_date",
            pad("order_items", ITEMS),
        ),
        order_payments=frame(
            "order_payments", "order_id payment_sequential payment_type payment_installments payment_value", text(PAYMENTS)
        ),
        order_reviews=frame(
            "order_reviews",
            "review_id order_id review_score review_creation_date review_answer_timestamp",
            pad("order_reviews", REVIEWS),
        ),
    )


def rows(df, *columns: str) -> list[tuple]:
    return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
