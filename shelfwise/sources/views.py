"""Domain views over the driver tables.

The driver's TPC-H-like tables stand in for the retail source:

==============  =====================================================================
view            derived from
==============  =====================================================================
v_shop          nation (region 4 = inactive branch)
v_company       supplier (type 'S') + customer (type 'C')
v_product       part: brand from p_brand, group = p_size, type = p_type,
                category = noun of p_name; ids of text attributes come from a key dictionary
v_sell          orders joined to the customer's nation (header shop)
v_sell_detail   lineitem joined to the supplier's nation (detail shop); id = hash of the row
v_stock_shop    open lineitems (l_linestatus = 'O') as stock rows per supplier nation
v_setting       events: shop = user_id % 25, group = 1 + event_id % 50, quantities from value/props
==============  =====================================================================

The same definitions are written in SQL for the DuckDB oracle
(``shelfwise.plans.oracle``). Every view is lazy; Catalyst prunes columns
and pushes filters through them into the parquet scans.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expr import hash_long
from ..operators.keys import bounded_broadcast
from ..operators.surrogate import extend
from ..session import ensure_checkpoint_dir, scratch_path
from .tables import read_table

INACTIVE_REGION = 4
SETTING_SHOPS = 25
SETTING_GROUPS = 50


class Domain:
    """Lazily built domain views for one data directory.

    ``keys_root`` is where the key dictionaries of text attributes are kept from
    run to run; without it they live as long as this object.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, keys_root: str | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        self.keys_root = keys_root
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """The driver table (one file listing per table; plans share the relation)."""
        if name not in self._tables:
            self._tables[name] = read_table(self.spark, self.sf_dir, name)
        return self._tables[name]

    def _keyed(self, df: DataFrame, column: str, name: str) -> DataFrame:
        """``df`` with ``<name>_id``, the dictionary id of a text column."""
        if self.keys_root is None:
            ensure_checkpoint_dir(self.spark)
            self.keys_root = scratch_path(self.spark, "keys")
        keys = extend(self.spark, f"{self.keys_root}/{name}", df.select(column))
        keys = keys.select(F.col("key").alias(f"_{name}"), F.col("id").cast("int").alias(f"{name}_id"))
        return df.join(bounded_broadcast(keys), F.col(column) == F.col(f"_{name}"), "left").drop(f"_{name}")

    # -- dimensions ---------------------------------------------------------
    @cached_property
    def v_shop(self) -> DataFrame:
        n = self.table("nation")
        return n.select(
            F.col("n_nationkey").cast("int").alias("id"),
            F.concat(F.lit("BR"), F.lpad(F.col("n_nationkey").cast("string"), 3, "0")).alias("code"),
            F.col("n_name").alias("name"),
            F.when(F.col("n_regionkey") == INACTIVE_REGION, "N").otherwise("Y").alias("active"),
        )

    @cached_property
    def v_company(self) -> DataFrame:
        s = self.table("supplier").select(
            F.col("s_suppkey").cast("int").alias("id"),
            F.lit("S").alias("type"),
            F.concat(F.lit("S"), F.lpad(F.col("s_suppkey").cast("string"), 6, "0")).alias("code"),
            F.col("s_name").alias("name"),
            F.lit(None).cast("string").alias("tax_id"),
            F.col("s_nationkey").cast("string").alias("nationid"),
            F.lit(None).cast("string").alias("address"),
            F.lit(None).cast("string").alias("tel"),
            F.lit(None).cast("string").alias("fax"),
            F.lit(None).cast("string").alias("contact1"),
            F.lit(None).cast("string").alias("email1"),
        )
        c = self.table("customer").select(
            F.col("c_custkey").cast("int").alias("id"),
            F.lit("C").alias("type"),
            F.concat(F.lit("C"), F.lpad(F.col("c_custkey").cast("string"), 6, "0")).alias("code"),
            F.col("c_name").alias("name"),
            F.lit(None).cast("string").alias("tax_id"),
            F.col("c_nationkey").cast("string").alias("nationid"),
            F.lit(None).cast("string").alias("address"),
            F.lit(None).cast("string").alias("tel"),
            F.lit(None).cast("string").alias("fax"),
            F.col("c_mktsegment").alias("contact1"),
            F.lit(None).cast("string").alias("email1"),
        )
        return s.unionByName(c)

    @cached_property
    def v_product(self) -> DataFrame:
        p = self.table("part").withColumn("_noun", F.split_part(F.col("p_name"), F.lit(" "), F.lit(2)))
        p = self._keyed(self._keyed(p, "_noun", "category"), "p_type", "type")
        return p.select(
            F.col("p_partkey").cast("int").alias("id"),
            F.col("p_partkey").cast("string").alias("pu_product_id"),
            F.substring(F.col("p_brand"), 7, 10).cast("int").alias("brand_id"),
            F.col("p_brand").alias("brand_name"),
            "category_id",
            F.col("_noun").alias("category_name"),
            F.col("p_size").cast("int").alias("group_id"),
            "type_id",
            F.col("p_type").alias("type_name"),
            F.col("p_name").alias("description"),
            F.lit(None).cast("string").alias("status"),
        )

    # -- facts --------------------------------------------------------------
    @cached_property
    def v_sell(self) -> DataFrame:
        o = self.table("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        c = self.table("customer").select("c_custkey", "c_nationkey")
        return o.join(c, o.o_custkey == c.c_custkey, "inner").select(
            F.col("o_orderkey").alias("id"),
            F.col("c_nationkey").cast("int").alias("shop_id"),
            F.col("o_orderdate").alias("sell_date"),
        )

    @cached_property
    def v_sell_detail(self) -> DataFrame:
        li = self.table("lineitem")
        s = self.table("supplier").select("s_suppkey", "s_nationkey")
        row_key = F.concat_ws(
            "|",
            F.col("l_orderkey"),
            F.col("l_linenumber"),
            F.col("l_partkey"),
            F.col("l_suppkey"),
            F.col("l_quantity").cast("int"),
            F.round(F.col("l_extendedprice") * 100).cast("bigint"),
            F.date_format(F.col("l_shipdate"), "yyyyMMdd"),
        )
        return li.join(s, li.l_suppkey == s.s_suppkey, "inner").select(
            hash_long(row_key).alias("id"),
            F.col("l_orderkey").alias("sell_id"),
            F.col("l_suppkey").cast("int").alias("company_id"),
            F.col("l_partkey").cast("int").alias("product_id"),
            F.col("s_nationkey").cast("int").alias("shop_id"),
            F.col("l_quantity").cast("int").alias("qty"),
        )

    @cached_property
    def v_stock_shop(self) -> DataFrame:
        li = self.table("lineitem").where(F.col("l_linestatus") == "O")
        s = self.table("supplier").select("s_suppkey", "s_nationkey")
        return li.join(s, li.l_suppkey == s.s_suppkey, "inner").select(
            F.col("s_nationkey").cast("int").alias("shop_id"),
            F.col("l_partkey").cast("int").alias("product_id"),
            F.col("l_quantity").cast("int").alias("qty"),
        )

    @cached_property
    def v_setting(self) -> DataFrame:
        return settings_from_events(self.table("events"))

    @cached_property
    def embeddings(self) -> DataFrame:
        return self.table("embeddings")

    @cached_property
    def events(self) -> DataFrame:
        return self.table("events")


def settings_from_events(e: DataFrame) -> DataFrame:
    """Stock-target settings (one version per event); works on batch and streaming frames."""
    k = F.get_json_object(F.col("props"), "$.k").cast("int")
    return e.select(
        F.col("event_id").alias("id"),
        (F.col("user_id") % SETTING_SHOPS).cast("int").alias("shop_id"),
        (F.lit(1) + F.col("event_id") % SETTING_GROUPS).cast("int").alias("product_group_id"),
        (F.col("value") / 2).alias("min_qty"),
        F.col("value").alias("max_qty"),
        (F.lit(1.0) + k / 100).alias("sell_multiply"),
        k.cast("double").alias("show_qty"),
        F.lit(None).cast("int").alias("category_id"),
        F.lit(None).cast("int").alias("type_id"),
        F.lit(None).cast("int").alias("brand_id"),
        F.lit(None).cast("int").alias("created_by"),
        F.lit(None).cast("int").alias("updated_by"),
        F.col("ts").alias("created_at"),
        F.col("ts").alias("updated_at"),
    )
