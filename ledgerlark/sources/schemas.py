"""Declared schemas and constraints of the eight input tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# The closed vocabularies of the two coded columns.
ORDER_STATUSES = (
    "delivered", "shipped", "canceled", "unavailable", "invoiced", "processing", "created", "approved",
)
PAYMENT_TYPES = ("credit_card", "boleto", "voucher", "debit_card", "not_defined")

STRING, SHORT, INT, MONEY, TS = (
    T.StringType(), T.ShortType(), T.IntegerType(), T.DecimalType(10, 2), T.TimestampType(),
)


@dataclass(frozen=True)
class Field:
    """One column with the constraints that the validation job turns into checks."""

    name: str
    type: T.DataType
    required: bool = False
    max_length: int | None = None
    domain: tuple[str, ...] | None = None
    low: int | None = None
    high: int | None = None
    pad: int | None = None
    header: str | None = None  # spelling in the CSV header where it differs


@dataclass(frozen=True)
class TableSpec:
    name: str
    fields: tuple[Field, ...]
    key: tuple[str, ...]
    references: dict[str, tuple[str, str]] = field(default_factory=dict)
    multiline: bool = False  # free text may hold line breaks

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.type, not f.required) for f in self.fields])


def _id(name: str) -> Field:
    return Field(name, STRING, required=True, max_length=32)


def _place(prefix: str) -> tuple[Field, ...]:
    return (
        Field(f"{prefix}_zip_code_prefix", STRING, required=True, max_length=5, pad=5),
        Field(f"{prefix}_city", STRING, required=True, max_length=50),
        Field(f"{prefix}_state", STRING, required=True, max_length=2),
    )


# Parents stand before children, so the tuple order is also the load order.
SPECS: tuple[TableSpec, ...] = (
    TableSpec("customers", (_id("customer_id"), _id("customer_unique_id"), *_place("customer")), ("customer_id",)),
    TableSpec(
        "product_category_translation",
        (
            Field("product_category_name", STRING, required=True, max_length=50),
            Field("product_category_name_english", STRING, required=True, max_length=50),
        ),
        ("product_category_name",),
    ),
    TableSpec(
        "products",
        (
            _id("product_id"),
            Field("product_category_name", STRING, max_length=50),
            Field("product_name_length", SHORT, header="product_name_lenght"),
            Field("product_description_length", INT, header="product_description_lenght"),
            Field("product_photos_qty", SHORT),
            Field("product_weight_g", INT, low=0),
            Field("product_length_cm", SHORT, low=0),
            Field("product_height_cm", SHORT, low=0),
            Field("product_width_cm", SHORT, low=0),
        ),
        ("product_id",),
    ),
    TableSpec("sellers", (_id("seller_id"), *_place("seller")), ("seller_id",)),
    TableSpec(
        "orders",
        (
            _id("order_id"),
            _id("customer_id"),
            Field("order_status", STRING, required=True, max_length=20, domain=ORDER_STATUSES),
            Field("order_purchase_timestamp", TS, required=True),
            Field("order_approved_at", TS),
            Field("order_delivered_carrier_date", TS),
            Field("order_delivered_customer_date", TS),
            Field("order_estimated_delivery_date", TS, required=True),
        ),
        ("order_id",),
        {"customer_id": ("customers", "customer_id")},
    ),
    TableSpec(
        "order_items",
        (
            _id("order_id"),
            Field("order_item_id", SHORT, required=True),
            _id("product_id"),
            _id("seller_id"),
            Field("shipping_limit_date", TS, required=True),
            Field("price", MONEY, required=True, low=0),
            Field("freight_value", MONEY, required=True, low=0),
        ),
        ("order_id", "order_item_id"),
        {
            "order_id": ("orders", "order_id"),
            "product_id": ("products", "product_id"),
            "seller_id": ("sellers", "seller_id"),
        },
    ),
    TableSpec(
        "order_payments",
        (
            _id("order_id"),
            Field("payment_sequential", SHORT, required=True),
            Field("payment_type", STRING, required=True, max_length=20, domain=PAYMENT_TYPES),
            Field("payment_installments", SHORT, required=True, low=0),
            Field("payment_value", MONEY, required=True, low=0),
        ),
        ("order_id", "payment_sequential"),
        {"order_id": ("orders", "order_id")},
    ),
    TableSpec(
        "order_reviews",
        (
            _id("review_id"),
            _id("order_id"),
            Field("review_score", SHORT, required=True, low=1, high=5),
            Field("review_comment_title", STRING, max_length=100),
            Field("review_comment_message", STRING),
            Field("review_creation_date", TS, required=True),
            Field("review_answer_timestamp", TS, required=True),
        ),
        ("review_id", "order_id"),
        {"order_id": ("orders", "order_id")},
        multiline=True,
    ),
)

SPEC = {spec.name: spec for spec in SPECS}
