"""Load jobs: source frames -> cleansed, key-checked batches -> upserted targets.

Each ``load_*`` is a DataFrame transform (no action but the header bounds of a
range load, see ``join_detail_header``, and key-set counts) from source views
and the *current target* key sets (ids left from earlier runs stay valid).
``run_load`` chains them in dependency order and writes targets through the
upsert writers; ``build_targets`` does the same in memory for a fresh load
(used by the registered queries and tests).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..fixed_values import CUSTOMER_TYPE, SUPPLIER_TYPE
from ..functions.dates import closed_range, load_window
from ..functions.expr import default_if_empty, empty_if_null, flag_to_bool, positive
from ..operators.aggregates import observed
from ..operators.keys import fk_flags, fk_nullify, fk_semi_filter, remember_rows
from ..operators.quality import dlq
from ..operators.upsert import conform, dedupe_latest, merge, publish_snapshot, stored_snapshot, upsert_months, write_months
from ..sources.views import Domain

# Fixed load timestamp used by the registered queries (never the wall clock in tests).


# -- masters ------------------------------------------------------------------
def load_branches(shop: DataFrame) -> DataFrame:
    """All shops; ``is_active = (active == 'Y')``, NULL -> false."""
    return shop.select(
        F.col("id").cast("int").alias("id"),
        empty_if_null("code").alias("code"),
        empty_if_null("name").alias("name"),
        flag_to_bool("active").alias("is_active"),
    )


def load_named_master(src: DataFrame, label: str = "name") -> DataFrame:
    """Brands / categories / groups / types: id, label, status ('' -> 'ACTIVE')."""
    return src.select(
        F.col("id").cast("int").alias("id"),
        empty_if_null(label).alias(label),
        default_if_empty("status", S.STATUS_ACTIVE).alias("status"),
    )


def brands_source(product: DataFrame) -> DataFrame:
    return product.select(F.col("brand_id").alias("id"), F.col("brand_name").alias("name"),
                          F.lit(None).cast("string").alias("status")).distinct()


def categories_source(product: DataFrame) -> DataFrame:
    return product.select(F.col("category_id").alias("id"), F.col("category_name").alias("name"),
                          F.lit(None).cast("string").alias("status")).distinct()


def groups_source(product: DataFrame) -> DataFrame:
    return product.select(
        F.col("group_id").alias("id"),
        F.concat(F.lit("SIZE "), F.col("group_id").cast("string")).alias("description"),
        F.lit(None).cast("string").alias("status"),
    ).distinct()


def types_source(product: DataFrame) -> DataFrame:
    return product.select(F.col("type_id").alias("id"), F.col("type_name").alias("name"),
                          F.lit(None).cast("string").alias("status")).distinct()


def load_suppliers(company: DataFrame) -> DataFrame:
    """Companies of type 'S'; contact1/email1 renamed; status is the literal 'ACTIVE'."""
    c = company.where(F.col("type") == SUPPLIER_TYPE)
    return c.select(
        F.col("id").cast("int").alias("id"),
        *[empty_if_null(x).alias(x) for x in ("code", "name", "tax_id", "address", "tel", "fax")],
        empty_if_null("contact1").alias("contact_name"),
        empty_if_null("email1").alias("email"),
        F.lit(S.STATUS_ACTIVE).alias("status"),
    )


def load_customers(company: DataFrame) -> DataFrame:
    """Companies of type 'C' (the customers target has no loader upstream; our feed)."""
    c = company.where(F.col("type") == CUSTOMER_TYPE)
    return c.select(
        F.col("id").cast("int").alias("id"),
        *[empty_if_null(x).alias(x) for x in ("code", "name", "tax_id")],
        empty_if_null("nationid").alias("nation_id"),
        *[empty_if_null(x).alias(x) for x in ("address", "tel")],
        empty_if_null("email1").alias("email"),
        F.lit(S.STATUS_ACTIVE).alias("status"),
    )


def load_products(
    product: DataFrame,
    brands: DataFrame,
    categories: DataFrame,
    groups: DataFrame,
    types: DataFrame,
) -> DataFrame:
    """Defaults for status/description; unknown brand/category/group/type -> NULL, row kept."""
    p = product.select(
        F.col("id").cast("int").alias("id"),
        empty_if_null("pu_product_id").alias("pu_product_id"),
        F.col("brand_id").cast("int").alias("brand_id"),
        F.col("category_id").cast("int").alias("category_id"),
        F.col("group_id").cast("int").alias("group_id"),
        F.col("type_id").cast("int").alias("type_id"),
        default_if_empty("description", S.UNSPECIFIED_PRODUCT).alias("description"),
        default_if_empty("status", S.STATUS_ACTIVE).alias("status"),
    )
    return fk_nullify(
        p, {"brand_id": brands, "category_id": categories, "group_id": groups, "type_id": types}
    )


# -- stock ----------------------------------------------------------------------
def load_stock_balance(stock_shop: DataFrame, branches: DataFrame, products: DataFrame) -> DataFrame:
    """SUM(qty) per (shop, product) over rows with positive, known keys.

    Semi-joins run before the aggregate; the aggregate is partial + final so a
    hot (shop, product) is combined map-side.
    """
    kept = fk_semi_filter(stock_shop, {"shop_id": branches, "product_id": products})
    return kept.groupBy("shop_id", "product_id").agg(F.sum(F.coalesce(F.col("qty"), F.lit(0))).alias("qty"))


TARGET_PAYLOAD = (
    "min_qty", "max_qty", "sell_multiply", "show_qty", "category_id", "type_id", "brand_id",
    "created_by", "updated_by", "created_at", "updated_at",
)


def _setting_refs(setting: DataFrame, branches: DataFrame, dims: dict | None) -> DataFrame:
    """Settings with positive keys and a known shop, flagged on their optional dimension ids."""
    kept = setting.where(positive("shop_id", "product_group_id"))
    kept = fk_semi_filter(kept, {"shop_id": branches}, require_positive=False)
    if not dims:
        return kept.withColumn("fk_reason", F.lit(None).cast("string"))
    return fk_flags(kept, dims, require_positive=False, nullable=True)


def stock_target_rejects(setting: DataFrame, branches: DataFrame, dims: dict) -> DataFrame:
    """Settings whose category/type/brand id is unknown (NULL allowed), for the dead-letter table.

    Upstream such a row aborts the whole load through the foreign key; here it is set aside.
    """
    return _setting_refs(setting, branches, dims).where(F.col("fk_reason").isNotNull())


def load_stock_targets(setting: DataFrame, branches: DataFrame, dims: dict | None = None) -> DataFrame:
    """Latest setting (greatest id) per (shop, product group), positive keys, known shop.

    ``dims`` ({"category_id": categories, "type_id": types, "brand_id": brands})
    validates the optional dimension ids; rows with an unknown one are left to
    ``stock_target_rejects`` instead of aborting the load.
    """
    kept = _setting_refs(setting, branches, dims).where(F.col("fk_reason").isNull()).drop("fk_reason")
    latest = kept.groupBy("shop_id", "product_group_id").agg(
        F.max_by(F.struct(*TARGET_PAYLOAD), F.struct("id", *TARGET_PAYLOAD)).alias("_s"),
        F.max("id").alias("setting_id"),
    )
    # The loader never sets pu_product_id: the upsert writes it blank (kept as upstream does).
    return latest.select(
        "shop_id", "product_group_id", "setting_id", F.lit("").alias("pu_product_id"),
        *[F.col(f"_s.{c}").alias(c) for c in TARGET_PAYLOAD],
    )


# -- sales facts ------------------------------------------------------------------
def load_sell(sell: DataFrame, start: str | None, end: str | None, branches: DataFrame) -> DataFrame:
    """Headers in the closed day range; unknown shop -> NULL (row kept)."""
    h = sell.where(closed_range("sell_date", start, end)).select("id", "shop_id", "sell_date")
    return fk_nullify(h, {"shop_id": branches})


# A window of at most this many days keeps a small share of the details, so headers are worth broadcasting,
# if they take at most this many bytes (an id and a date in a hashed relation: HEADER_BYTES a row).
SHORT_WINDOW_DAYS = 62
HEADER_BROADCAST_BYTES = 256 << 20
HEADER_BYTES = 48


def join_detail_header(detail: DataFrame, sell: DataFrame, start: str | None, end: str | None,
                       header_broadcast_bytes: int = HEADER_BROADCAST_BYTES) -> DataFrame:
    """Details of headers in range, carrying the header's date (detail keeps its own shop).

    The raw detail has no date, so the range lives on the header. For a bounded
    range one aggregate over the headers gives the range of their ids, which is
    pushed into the detail scan, and the bytes they take (this is the one job that
    planning a load runs). A short window's headers are broadcast if these are few, so
    the detail is never shuffled; a long window keeps much of the detail, whose work
    would stay with the scan's tasks, so both sides meet in a shuffle join, as without bounds.
    """
    h = sell.where(closed_range("sell_date", start, end)).select(
        F.col("id").alias("_hid"), F.col("sell_date")
    )
    if start or end:
        lo, hi, n = h.agg(F.min("_hid"), F.max("_hid"), F.count("_hid")).first()
        detail = detail.where(F.col("sell_id").between(lo, hi)) if n else detail.limit(0)
        days = (dt.date.fromisoformat(end) - dt.date.fromisoformat(start)).days + 1 if start and end else None
        if days is not None and days <= SHORT_WINDOW_DAYS and n * HEADER_BYTES <= header_broadcast_bytes:
            h = F.broadcast(h)
    return detail.join(h, detail["sell_id"] == h["_hid"], "inner").drop("_hid")


def load_sell_detail(
    detail: DataFrame,
    sell: DataFrame,
    start: str | None,
    end: str | None,
    branches: DataFrame,
    products: DataFrame,
    suppliers: DataFrame,
) -> DataFrame:
    """Detail ⨝ header(range), unknown shop/product/supplier -> NULL, gross qty kept."""
    j = join_detail_header(detail, sell, start, end).select(
        "id", "sell_id", "company_id", "product_id", "shop_id",
        F.coalesce(F.col("qty"), F.lit(0)).alias("qty"), "sell_date",
    )
    return fk_nullify(j, {"shop_id": branches, "product_id": products, "company_id": suppliers})


# -- whole load -------------------------------------------------------------------
def materialize_target(df: DataFrame) -> DataFrame:
    """Write a target to the shared checkpoint folder and read it back.

    Cuts the lineage (a lost executor re-reads files instead of recomputing the
    load) and records the written row count, observed during the same job, as
    the proven size bound of every key set taken from it.
    """
    from pyspark.sql import Observation

    from ..operators.keys import remember_rows
    from ..session import scratch_path

    obs = Observation("rows")
    path = scratch_path(df.sparkSession, "targets")
    df.observe(obs, F.count(F.lit(1)).alias("n")).write.parquet(path)
    back = df.sparkSession.read.parquet(path)
    return remember_rows(back, obs.get["n"])

@dataclass
class Targets:
    branches: DataFrame
    suppliers: DataFrame
    customers: DataFrame
    brands: DataFrame
    categories: DataFrame
    groups: DataFrame
    types: DataFrame
    products: DataFrame
    stock_balance: DataFrame
    stock_targets: DataFrame
    sell: DataFrame
    sell_detail: DataFrame


def build_targets(dom: Domain, start: str | None, end: str | None, now: str,
                  valid_shops: DataFrame | None = None, valid_products: DataFrame | None = None,
                  materialize: bool = False) -> Targets:
    """A fresh load; targets conform to their schemas.

    With ``materialize`` every master target is written once (parquet under
    ``spark.checkpoint.dir``, row count observed during the write) before the facts are
    validated against it — as the batch job reads key sets back from the
    loaded targets. Facts stay lazy. ``valid_shops``/``valid_products``
    override the key sets (e.g. only active branches) to exercise the
    nullify/semi/reject paths.
    """

    def m(frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
        """Write independent targets as concurrent Spark jobs (one driver thread each)."""
        if not materialize:
            return frames
        from concurrent.futures import ThreadPoolExecutor

        with ThreadPoolExecutor(max_workers=len(frames)) as ex:
            futs = {k: ex.submit(materialize_target, df) for k, df in frames.items()}
            return {k: f.result() for k, f in futs.items()}

    wave1 = m({
        "branches": conform(load_branches(dom.v_shop), S.BRANCHES, now),
        "suppliers": conform(load_suppliers(dom.v_company), S.SUPPLIERS, now),
        "customers": conform(load_customers(dom.v_company), S.CUSTOMERS, now),
        "brands": conform(load_named_master(brands_source(dom.v_product)), S.BRANDS, now),
        "categories": conform(load_named_master(categories_source(dom.v_product)), S.CATEGORIES, now),
        "groups": conform(load_named_master(groups_source(dom.v_product), "description"), S.GROUPS, now),
        "types": conform(load_named_master(types_source(dom.v_product)), S.TYPES, now),
    })
    branches, suppliers, customers = wave1["branches"], wave1["suppliers"], wave1["customers"]
    brands, categories, groups, types = wave1["brands"], wave1["categories"], wave1["groups"], wave1["types"]
    products = m({"products": conform(load_products(dom.v_product, brands, categories, groups, types),
                                      S.PRODUCTS, now)})["products"]
    shops = valid_shops if valid_shops is not None else branches
    prods = valid_products if valid_products is not None else products
    wave3 = m({
        "stock": conform(load_stock_balance(dom.v_stock_shop, shops, prods), S.STOCK_BALANCE, now),
        "targets": conform(load_stock_targets(dom.v_setting, shops, {
            "category_id": categories, "type_id": types, "brand_id": brands}), S.STOCK_TARGETS, now),
    })
    stock, targets = wave3["stock"], wave3["targets"]
    sell = conform(load_sell(dom.v_sell, start, end, shops), S.SELL, now)
    detail = conform(
        load_sell_detail(dom.v_sell_detail, dom.v_sell, start, end, shops, prods, suppliers),
        S.SELL_DETAIL, now,
    )
    return Targets(branches, suppliers, customers, brands, categories, groups, types, products,
                   stock, targets, sell, detail)


def run_load(
    spark: SparkSession,
    dom: Domain,
    root: str,
    mode: str,
    as_of: str,
    start: str | None = None,
    end: str | None = None,
    lookback_days: int | None = 7,
    reset: bool = False,
    dry_run: bool = False,
    whole: bool = False,
    *,
    now: str,
) -> dict:
    """Ordered batch load into ``root/<table>`` (masters as snapshots, facts by month).

    ``mode='full'`` forces a reset: every target is rebuilt into a fresh
    snapshot directory instead of merged; ``whole`` does so without date bounds. ``dry_run`` counts batches and
    writes nothing. Re-running the same window is idempotent (keyed upserts).
    Settings whose dimension ids are unknown are published as ``root/dlq``, with reasons.
    Independent targets are written concurrently, in dependency waves; the
    returned ``counts`` are the rows each step loaded, observed during its write.
    """
    mode, start, end = ("full", None, None) if whole else load_window(mode, as_of, start, end, lookback_days)
    reset = reset or mode == "full"
    counts: dict[str, int] = {}

    def current(spec: S.TableSpec) -> DataFrame | None:
        return None if reset else stored_snapshot(spark, f"{root}/{spec.name}", spec)

    def put(spec: S.TableSpec, batch: DataFrame) -> DataFrame:
        b = conform(batch, spec, now)
        if dry_run:
            counts[spec.name] = b.count()
            return merge(current(spec), b, spec.keys, spec.updates)
        # Rows loaded by this step, and the table's new size (the proven bound of its key
        # sets), are observed while the snapshot is written: no second scan, no count job.
        b, obs = observed(b, spec.name)
        merged, total = observed(merge(current(spec), b, spec.keys, spec.updates), f"{spec.name}_total")
        path = publish_snapshot(spark, f"{root}/{spec.name}", merged, sort_by=list(spec.keys))
        counts[spec.name] = obs.get["rows"]
        return remember_rows(spark.read.parquet(path), total.get["rows"])

    def put_fact(spec: S.TableSpec, batch: DataFrame) -> None:
        if dry_run:
            counts[spec.name] = batch.count()
            return
        b, obs = observed(conform(batch, spec, now), spec.name)
        if reset:
            b = dedupe_latest(b, spec.keys)  # a merge would keep one row a key as well
            write_months(spark, f"{root}/{spec.name}", b, spec, sort_by=["shop_id", "sell_date"], replace_all=True)
        else:
            upsert_months(spark, f"{root}/{spec.name}", b, spec, now, sort_by=["shop_id", "sell_date"])
        counts[spec.name] = obs.get["rows"]

    def wave(jobs: dict) -> dict:
        """Independent targets are written as concurrent Spark jobs (one driver thread each)."""
        from concurrent.futures import ThreadPoolExecutor

        with ThreadPoolExecutor(max_workers=len(jobs)) as ex:
            futs = {k: ex.submit(fn, *args) for k, (fn, *args) in jobs.items()}
            return {k: f.result() for k, f in futs.items()}

    w1 = wave({
        "branches": (put, S.BRANCHES, load_branches(dom.v_shop)),
        "suppliers": (put, S.SUPPLIERS, load_suppliers(dom.v_company)),
        "customers": (put, S.CUSTOMERS, load_customers(dom.v_company)),
        "brands": (put, S.BRANDS, load_named_master(brands_source(dom.v_product))),
        "categories": (put, S.CATEGORIES, load_named_master(categories_source(dom.v_product))),
        "groups": (put, S.GROUPS, load_named_master(groups_source(dom.v_product), "description")),
        "types": (put, S.TYPES, load_named_master(types_source(dom.v_product))),
    })
    branches, suppliers = w1["branches"], w1["suppliers"]
    products = put(S.PRODUCTS, load_products(dom.v_product, w1["brands"], w1["categories"], w1["groups"], w1["types"]))
    dims = {"category_id": w1["categories"], "type_id": w1["types"], "brand_id": w1["brands"]}
    wave({
        "stock": (put, S.STOCK_BALANCE, load_stock_balance(dom.v_stock_shop, branches, products)),
        "targets": (put, S.STOCK_TARGETS, load_stock_targets(dom.v_setting, branches, dims)),
        "sell": (put_fact, S.SELL, load_sell(dom.v_sell, start, end, branches)),
        "detail": (put_fact, S.SELL_DETAIL,
                   load_sell_detail(dom.v_sell_detail, dom.v_sell, start, end, branches, products, suppliers)),
    })
    rejects = dlq(stock_target_rejects(dom.v_setting, branches, dims), "stock_targets", ["shop_id", "product_group_id"])
    if dry_run:
        counts["dlq"] = rejects.count()
    else:
        rejects, obs = observed(rejects, "dlq")
        publish_snapshot(spark, f"{root}/dlq", rejects)
        counts["dlq"] = obs.get["rows"]
    return {"mode": mode, "start": start, "end": end, "reset": reset, "counts": counts}


def run_full(spark: SparkSession, dom: Domain, root: str, as_of: str, start: str | None = None, end: str | None = None,
             *, now: str) -> dict:
    """Full reload: reset forced. Without bounds every bill is loaded, whatever its date."""
    return run_load(spark, dom, root, "full", as_of, start, end, reset=True, whole=start is None and end is None, now=now)


def reset_targets(spark: SparkSession, root: str) -> None:
    """Empties all targets under ``root``: an empty snapshot for each master, an empty table for the others.

    Earlier snapshots of a master stay for their readers; facts and embeddings are overwritten.
    """
    for spec in S.TARGETS.values():
        path = f"{root}/{spec.name}"
        if spec.month_col:
            none = _empty(spark, spec).withColumn("sell_month", F.lit(None).cast("date"))
            none.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
        elif spec is S.PRODUCT_EMBEDDINGS:
            _empty(spark, spec).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
        else:
            publish_snapshot(spark, path, _empty(spark, spec))


def _empty(spark: SparkSession, spec: S.TableSpec) -> DataFrame:
    return spark.createDataFrame([], spec.schema)
