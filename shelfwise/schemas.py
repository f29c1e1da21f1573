"""Declared schemas of the target tables, their keys and update lists.

Quantities declared NUMERIC(12,2)/(12,4) in the operational store are carried
as DOUBLE rounded to the declared scale; ids are INT except the fact ids
(BIGINT). ``pu_product_id`` is a string everywhere (three types upstream).
Timestamps carry no zone (``timestamp_ntz``), like the source dates.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

from .fixed_values import PO_STATUS_DEFAULT, STATUS_ACTIVE, UNSPECIFIED_PRODUCT  # noqa: F401

I, L, S, D, B, TS = (
    T.IntegerType(),
    T.LongType(),
    T.StringType(),
    T.DoubleType(),
    T.BooleanType(),
    T.TimestampNTZType(),
)


def _struct(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


@dataclass(frozen=True)
class TableSpec:
    """A target table: schema, business key, and the columns an upsert rewrites."""

    name: str
    schema: T.StructType
    keys: tuple[str, ...]
    updates: tuple[str, ...]
    defaults: dict = field(default_factory=dict)
    month_col: str | None = None  # facts are partitioned by the month of this column

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.schema.fields]


STOCK_METRICS = (
    "current_qty",
    "truesell_qty_7_day",
    "target_qty_7_day_original",
    "target_qty_7_day",
    "current_qty_by_type",
    "target_qty_by_type_7_day",
    "min_qty",
    "max_qty",
    "po_qty",
    "trans_in_qty",
    "trans_out_qty",
    "truesell_qty_30_day",
    "target_qty_30_day_original",
    "target_qty_30_day",
    "target_qty_by_type_30_day",
)

BRANCHES = TableSpec(
    "branches",
    _struct(("id", I), ("code", S), ("name", S), ("is_active", B), ("created_at", TS), ("updated_at", TS)),
    ("id",),
    ("code", "name", "is_active", "updated_at"),
    {"is_active": True},
)


def _named_master(name: str, label: str) -> TableSpec:
    return TableSpec(
        name,
        _struct(("id", I), (label, S), ("status", S), ("created_at", TS)),
        ("id",),
        (label, "status"),
        {"status": STATUS_ACTIVE},
    )


BRANDS = _named_master("product_brands", "name")
CATEGORIES = _named_master("product_categories", "name")
GROUPS = _named_master("product_groups", "description")
TYPES = _named_master("product_types", "name")

PRODUCTS = TableSpec(
    "products",
    _struct(
        ("id", I), ("pu_product_id", S), ("brand_id", I), ("category_id", I), ("group_id", I),
        ("type_id", I), ("description", S), ("status", S), ("created_at", TS), ("updated_at", TS),
    ),
    ("id",),
    ("pu_product_id", "brand_id", "category_id", "group_id", "type_id", "description", "status", "updated_at"),
    {"status": STATUS_ACTIVE},
)

SUPPLIERS = TableSpec(
    "suppliers",
    _struct(
        ("id", I), ("code", S), ("name", S), ("tax_id", S), ("address", S), ("tel", S), ("fax", S),
        ("contact_name", S), ("email", S), ("status", S), ("created_at", TS), ("updated_at", TS),
    ),
    ("id",),
    ("code", "name", "tax_id", "address", "tel", "fax", "contact_name", "email", "status", "updated_at"),
    {"status": STATUS_ACTIVE},
)

CUSTOMERS = TableSpec(
    "customers",
    _struct(
        ("id", I), ("code", S), ("name", S), ("tax_id", S), ("nation_id", S), ("address", S), ("tel", S),
        ("email", S), ("status", S), ("created_at", TS), ("updated_at", TS),
    ),
    ("id",),
    ("code", "name", "tax_id", "nation_id", "address", "tel", "email", "status", "updated_at"),
    {"status": STATUS_ACTIVE},
)

SELL = TableSpec(
    "sell",
    _struct(("id", L), ("shop_id", I), ("sell_date", TS), ("created_at", TS)),
    ("id", "sell_date"),
    ("shop_id",),
    month_col="sell_date",
)

SELL_DETAIL = TableSpec(
    "sell_detail",
    _struct(
        ("id", L), ("sell_id", L), ("company_id", I), ("product_id", I), ("shop_id", I), ("qty", I),
        ("sell_date", TS), ("created_at", TS),
    ),
    ("id", "sell_date"),
    ("sell_id", "company_id", "product_id", "shop_id", "qty"),
    {"qty": 0},
    month_col="sell_date",
)

STOCK_BALANCE = TableSpec(
    "stock_balance",
    _struct(
        ("shop_id", I), ("product_id", I), ("pu_product_id", S), ("qty", I),
        *[(m, D) for m in STOCK_METRICS],
        ("po_status", S), ("created_at", TS), ("updated_at", TS),
    ),
    ("shop_id", "product_id"),
    ("pu_product_id", "qty", *STOCK_METRICS, "po_status", "updated_at"),
    {"qty": 0, **{m: 0.0 for m in STOCK_METRICS}, "po_status": PO_STATUS_DEFAULT},
)

STOCK_TARGETS = TableSpec(
    "stock_targets",
    _struct(
        ("shop_id", I), ("product_group_id", I), ("category_id", I), ("type_id", I), ("brand_id", I),
        ("pu_product_id", S), ("min_qty", D), ("max_qty", D), ("sell_multiply", D), ("show_qty", D),
        ("created_by", I), ("updated_by", I), ("created_at", TS), ("updated_at", TS),
    ),
    ("shop_id", "product_group_id"),
    (
        "category_id", "type_id", "brand_id", "pu_product_id", "min_qty", "max_qty", "sell_multiply",
        "show_qty", "created_by", "updated_by", "updated_at",
    ),
    {"min_qty": 0.0, "max_qty": 0.0, "sell_multiply": 0.0, "show_qty": 0.0},
)

PRODUCT_EMBEDDINGS = TableSpec(
    "product_embeddings",
    _struct(
        ("id", L), ("product_id", I), ("content", S), ("embedding", T.ArrayType(T.FloatType(), False)),
        ("created_at", TS),
    ),
    ("id",),
    (),
)

TARGETS = {
    t.name: t
    for t in (
        BRANCHES, BRANDS, CATEGORIES, GROUPS, TYPES, PRODUCTS, SUPPLIERS, CUSTOMERS, SELL, SELL_DETAIL,
        STOCK_BALANCE, STOCK_TARGETS, PRODUCT_EMBEDDINGS,
    )
}

# Load order of the batch job (masters first: their key sets validate the facts).
LOAD_ORDER = (
    "branches", "suppliers", "customers", "product_brands", "product_categories", "product_groups",
    "product_types", "products", "stock_balance", "stock_targets", "sell", "sell_detail",
)


@dataclass(frozen=True)
class Constraints:
    """What the store declares of a table besides its key: NOT NULL columns, text bounds, foreign keys (column -> table)."""

    not_null: tuple[str, ...] = ()
    lengths: dict[str, int] = field(default_factory=dict)
    references: dict[str, str] = field(default_factory=dict)
    unique: tuple[str, ...] = ()  # the table's key, unless given


# Fixed values of the store's declarations.
_NAMED = {"name": 255, "status": 50}
CONSTRAINTS = {
    "branches": Constraints(("id", "name"), {"code": 50, "name": 255}),
    "product_brands": Constraints(("id", "name"), _NAMED),
    "product_categories": Constraints(("id", "name"), _NAMED),
    "product_groups": Constraints(("id",), {"description": 255, "status": 50}),
    "product_types": Constraints(("id", "name"), _NAMED),
    "products": Constraints(
        ("id", "description"),
        {"pu_product_id": 50, "status": 50},
        {"brand_id": "product_brands", "category_id": "product_categories", "group_id": "product_groups", "type_id": "product_types"},
    ),
    "suppliers": Constraints(
        ("id", "name"),
        {"code": 100, "name": 255, "tax_id": 50, "address": 255, "tel": 100, "fax": 100, "contact_name": 100, "email": 100, "status": 50},
    ),
    "customers": Constraints(
        ("id", "name"),
        {"code": 100, "name": 255, "tax_id": 50, "nation_id": 20, "address": 255, "tel": 100, "email": 100, "status": 50},
    ),
    "sell": Constraints(("id", "sell_date"), {}, {"shop_id": "branches"}),
    "sell_detail": Constraints(
        ("id", "sell_id", "qty", "sell_date"), {}, {"company_id": "suppliers", "product_id": "products", "shop_id": "branches"}
    ),
    "stock_balance": Constraints(("qty",), {"po_status": 50}, {"shop_id": "branches", "product_id": "products"}),
    "stock_targets": Constraints(
        (),
        {"pu_product_id": 50},
        {"shop_id": "branches", "product_group_id": "product_groups", "category_id": "product_categories", "type_id": "product_types",
         "brand_id": "product_brands"},
    ),
    "product_embeddings": Constraints(("id", "content"), {}, {"product_id": "products"}),
}
