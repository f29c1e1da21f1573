"""Registered queries that write targets or the lake and read them back.

They write under ``spark.checkpoint.dir`` (the shared folder the cluster
names); a session without it (local tests, the driver's check) gets a fresh
folder set once, as tests do.
"""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.dates import closed_range, load_window
from ..operators.aggregates import content_rows
from ..operators.similar import append_embedding, save_embeddings
from ..operators.upsert import read_months, read_snapshot, upsert_months
from ..session import ensure_checkpoint_dir, scratch_path
from ..sources.lake import drop_expired, lake_read, lake_write, lake_write_snapshots, schema_align
from . import loads as L
from . import params as P
from .catalog import register
from .q_load import (
    BASE_CTES, CUSTOMERS_SQL, FACT_CTES, STOCK_COLS, STOCK_CTES, T_TARGET_COLS, _named_sql, dom, full, ranged, rng,
)
from .q_series import SERIES_CTES


def scratch(spark: SparkSession, name: str) -> str:
    ensure_checkpoint_dir(spark)
    return scratch_path(spark, "queries", name)


@register(
    "partition_monthly",
    "select cast(date_trunc('month', sell_date) as timestamp) as month, strftime(sell_date, 'y%Ym%m') as suffix, "
    "count(*) as n_rows from t_sell group by all",
    FACT_CTES,
)
def q_partition_monthly(spark, sf):
    root = scratch(spark, "sell")
    upsert_months(spark, root, full(spark, sf).sell, S.SELL, P.NOW, sort_by=["shop_id", "sell_date"])
    back = spark.read.parquet(root)
    return back.groupBy(F.col("sell_month").cast("timestamp_ntz").alias("month")).agg(
        F.count(F.lit(1)).alias("n_rows")
    ).withColumn("suffix", F.date_format("month", "'y'yyyy'm'MM"))


LAKE_SQL = """select cast(year(sell_date) as integer) as yyyy, cast(month(sell_date) as integer) as mm,
                     count(*) as n_rows, cast(sum(qty) as bigint) as qty
              from t_fact {where} group by all"""


def _lake(spark, sf) -> str:
    root = scratch(spark, "lake")
    t = full(spark, sf)
    lake_write(t.sell_detail, f"{root}/sales", sort_by=["shop_id", "product_id", "sell_date"])
    lake_write(t.sell, f"{root}/bills", sort_by=["shop_id", "sell_date"])
    lake_write_snapshots({"inventory": t.stock_balance, "products": t.products, "shops": t.branches}, root, P.AS_OF)
    return root


def _lake_summary(df: DataFrame) -> DataFrame:
    return df.groupBy("yyyy", "mm").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("qty").alias("qty"))


def _snapshot_sql(name: str, qty: str, source: str) -> str:
    return f"union all select '{name}', {int(P.AS_OF[:4])}, {int(P.AS_OF[5:7])}, count(*), {qty} from {source}"


@register(
    "lake_write",
    "select 'sales' as dataset, * from (" + LAKE_SQL.format(where="") + """)
     union all select 'bills', cast(year(sell_date) as integer), cast(month(sell_date) as integer), count(*), cast(null as bigint) from t_sell group by all """
    + _snapshot_sql("inventory", "cast(sum(qty) as bigint)", "t_stock") + " " + _snapshot_sql("products", "cast(null as bigint)", "t_products")
    + " " + _snapshot_sql("shops", "cast(null as bigint)", "t_branches"),
    {**SERIES_CTES, **STOCK_CTES, **FACT_CTES},
)
def q_lake_write(spark, sf):
    """The lake's five data sets, read back: lines and bills by month, the snapshots of a day."""
    root = _lake(spark, sf)
    none = F.lit(None).cast("bigint")
    parts = [
        _lake_summary(lake_read(spark, f"{root}/sales")).withColumn("dataset", F.lit("sales")),
        _lake_summary(lake_read(spark, f"{root}/bills").withColumn("qty", none)).withColumn("dataset", F.lit("bills")),
    ]
    for name in ("inventory", "products", "shops"):
        day = spark.read.parquet(f"{root}/{name}").where(F.col("snapshot_date") == F.lit(P.AS_OF).cast("date"))
        qty = F.sum("qty").cast("bigint") if name == "inventory" else none
        at = [F.year("snapshot_date").alias("yyyy"), F.month("snapshot_date").alias("mm")]
        parts.append(day.groupBy(*at).agg(F.count(F.lit(1)).alias("n_rows"), qty.alias("qty")).withColumn("dataset", F.lit(name)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


RETAIN_FROM = "2000-01-01"


@register("retention", LAKE_SQL.format(where=f"where sell_date >= timestamp '{RETAIN_FROM} 00:00:00'"), SERIES_CTES)
def q_retention(spark, sf):
    path = f"{_lake(spark, sf)}/sales"
    drop_expired(spark, path, RETAIN_FROM)
    return _lake_summary(lake_read(spark, path))


OLD_PRODUCT_COLS = ["id", "pu_product_id", "brand_id", "category_id", "group_id", "description", "created_at"]


@register(
    "schema_align",
    """select id, pu_product_id, brand_id, category_id, group_id, cast(null as integer) as type_id, description,
              'ACTIVE' as status, created_at, cast(null as timestamp) as updated_at
       from t_products""",
    BASE_CTES,
)
def q_schema_align(spark, sf):
    # A products target written by an older release (no type_id, status, updated_at).
    root = scratch(spark, "products_v0")
    full(spark, sf).products.select(*OLD_PRODUCT_COLS).write.parquet(root)
    existing = spark.read.parquet(root)
    aligned = schema_align(existing, spark.createDataFrame([], S.PRODUCTS.schema), {"status": S.STATUS_ACTIVE},
                           {f.name: f.dataType for f in S.PRODUCTS.schema.fields})
    return aligned.select(*S.PRODUCTS.columns)


MASTERS = (S.BRANCHES, S.SUPPLIERS, S.CUSTOMERS, S.BRANDS, S.CATEGORIES, S.GROUPS, S.TYPES, S.PRODUCTS, S.STOCK_BALANCE, S.STOCK_TARGETS)


def _written(spark, root: str) -> dict[str, DataFrame]:
    """Every target that a load writes, as it stands."""
    masters = {spec.name: read_snapshot(spark, f"{root}/{spec.name}", spec) for spec in MASTERS}
    return masters | {spec.name: read_months(spark, f"{root}/{spec.name}", spec) for spec in (S.SELL, S.SELL_DETAIL)}


def _content_sql(table: str, spec: S.TableSpec, source: str) -> str:
    def text(f):
        kind = f.dataType.simpleString()
        c = f"cast(round({f.name} * 10000) as bigint)" if kind == "double" else f"strftime({f.name}, '%Y%m%d%H%M%S')" if kind == "timestamp_ntz" else f.name
        return f"coalesce(cast({c} as varchar), '~')"

    row = ", ".join(text(f) for f in spec.schema.fields)
    return f"""select '{table}' as table_name, count(*) as n_rows,
        coalesce(cast(sum(('0x' || substr(md5(concat_ws('|', {row})), 1, 8))::bigint) as bigint), 0) as content from ({source})"""


def _targets_sql(start: str | None, end: str | None) -> dict[str, str]:
    """The rows of every target after a load of the window."""
    window = rng("sell_date", start, end)
    return {
        "branches": "select * from t_branches",
        "suppliers": "select * from t_suppliers",
        "customers": CUSTOMERS_SQL,
        "product_brands": _named_sql("brand_id", "brand_name", "name"),
        "product_categories": _named_sql("category_id", "category_name", "name"),
        "product_groups": _named_sql("group_id", "'SIZE ' || cast(group_id as varchar)", "description"),
        "product_types": _named_sql("type_id", "type_name", "name"),
        "products": "select * from t_products",
        "stock_balance": f"select {STOCK_COLS} from t_stock",
        "stock_targets": f"select {T_TARGET_COLS} from t_setting_latest",
        "sell": f"select * from t_sell where {window}",
        "sell_detail": f"select * from t_detail where {window}",
    }


def _loaded_sql(start: str | None, end: str | None) -> str:
    return " union all ".join(_content_sql(t, S.TARGETS[t], sql) for t, sql in _targets_sql(start, end).items())


LOAD_CTES = {**STOCK_CTES, **FACT_CTES}


@register("run_load", _loaded_sql(P.RANGE_START, P.RANGE_END), LOAD_CTES)
def q_run_load(spark, sf):
    """Every target that a load of a window has written, by row count and content."""
    return content_rows(_written(spark, ranged(spark, sf)))


@register("run_full", _loaded_sql(P.FULL_START, P.FULL_END), LOAD_CTES)
def q_run_full(spark, sf):
    root = scratch(spark, "targets")
    # A stale first run over a narrow window, then the full reload replaces everything.
    L.run_load(spark, dom(spark, sf), root, "repair", P.AS_OF, P.RANGE_START, P.RANGE_END, now=P.NOW)
    L.run_full(spark, dom(spark, sf), root, P.AS_OF, now=P.NOW)
    return content_rows(_written(spark, root))


@register(
    "full_reset",
    "select 'after reset' as step, table_name, cast(0 as bigint) as n_rows, cast(0 as bigint) as content from ("
    + _loaded_sql(P.RANGE_START, P.RANGE_END)
    + ") union all select 'after reset', 'product_embeddings', 0, 0 union all select 'loaded again', * from ("
    + _loaded_sql(P.RANGE_START, P.RANGE_END)
    + ") union all select 'loaded again', 'product_embeddings', 0, 0",
    LOAD_CTES,
)
def q_full_reset(spark, sf):
    """All 13 targets of a load are emptied, then loaded again."""
    root = scratch(spark, "targets")
    d = dom(spark, sf)
    L.run_load(spark, d, root, "repair", P.AS_OF, P.RANGE_START, P.RANGE_END, now=P.NOW)
    save_embeddings(append_embedding(d.embeddings, P.NOW), f"{root}/product_embeddings")
    L.reset_targets(spark, root)

    def state(step: str) -> DataFrame:
        empty = read_months(spark, f"{root}/product_embeddings", S.PRODUCT_EMBEDDINGS).drop("embedding")
        found = content_rows(_written(spark, root) | {"product_embeddings": empty})
        return found.select(F.lit(step).alias("step"), "table_name", "n_rows", "content")

    emptied = spark.createDataFrame(state("after reset").collect(), "step string, table_name string, n_rows long, content long")  # 13 rows
    L.run_load(spark, d, root, "repair", P.AS_OF, P.RANGE_START, P.RANGE_END, now=P.NOW)
    return emptied.unionByName(state("loaded again"))


@register("idempotent_resync", f"select table_name, n_rows, true as same from ({_loaded_sql(P.RANGE_START, P.RANGE_END)})", LOAD_CTES)
def q_idempotent_resync(spark, sf):
    """A load run twice into the same targets leaves every table's rows and content as they were."""
    root = scratch(spark, "targets")
    seen = []
    for _ in range(2):
        L.run_load(spark, dom(spark, sf), root, "repair", P.AS_OF, P.RANGE_START, P.RANGE_END, now=P.NOW)
        seen.append({r["table_name"]: (r["n_rows"], r["content"]) for r in content_rows(_written(spark, root)).collect()})  # 12 rows
    once, twice = seen
    return spark.createDataFrame([(t, n, twice[t] == (n, c)) for t, (n, c) in once.items()], "table_name string, n_rows long, same boolean")


WINDOW_CASES = (
    ("daily", "daily", None, None, 7),
    ("daily_zero_lookback", "daily", None, None, 0),
    ("repair_given", "repair", P.RANGE_START, P.RANGE_END, None),
    ("repair_default", "repair", None, None, None),
    ("full_given", "full", P.GIVEN_START, P.GIVEN_END, None),
    ("unknown_mode", "weekly", None, None, 7),
)
# Expected windows for as_of 2001-08-01 (fixed values of the window rules).
WINDOW_SQL = " union all ".join(
    f"select '{label}' as case_name, '{m}' as mode, '{s}' as start_day, '{e}' as end_day, count(*) as n_sells "
    f"from v_sell where {rng('sell_date', s, e)}"
    for label, m, s, e in (
        ("daily", "daily", "2001-07-25", "2001-08-01"),
        ("daily_zero_lookback", "daily", "2001-07-25", "2001-08-01"),
        ("repair_given", "repair", P.RANGE_START, P.RANGE_END),
        ("repair_default", "repair", "2001-07-25", "2001-08-01"),
        ("full_given", "full", P.GIVEN_START, P.GIVEN_END),
        ("unknown_mode", "daily", "2001-07-25", "2001-08-01"),
    )
)


@register("load_window", WINDOW_SQL)
def q_load_window(spark, sf):
    """Every mode's window and the sales it selects: one scan, one conditional count per case."""
    sells = dom(spark, sf).v_sell
    cases = [(label, *load_window(mode, P.AS_OF, s, e, lb)) for label, mode, s, e, lb in WINDOW_CASES]
    counts = sells.agg(*[
        F.count_if(closed_range("sell_date", start, end)).alias(f"n{i}") for i, (_, _, start, end) in enumerate(cases)
    ])
    rows = F.array(*[
        F.struct(F.lit(label).alias("case_name"), F.lit(m).alias("mode"), F.lit(start).alias("start_day"),
                 F.lit(end).alias("end_day"), F.col(f"n{i}").alias("n_sells"))
        for i, (label, m, start, end) in enumerate(cases)
    ])
    return counts.select(F.explode(rows).alias("r")).select("r.*")
