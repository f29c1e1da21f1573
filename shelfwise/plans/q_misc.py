"""Registered queries: embeddings and similarity search, declared date/text expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import expr as X
from ..operators import similar as SIM
from . import params as P
from .catalog import register
from .q_load import dom

EMB_NORM = "round(sqrt(list_dot_product(cast(embedding as double[]), cast(embedding as double[]))), 6)"
QUERY_VECTORS = """
    select e.vec_id as query_id, e.embedding
    from embeddings e join (select label, min(vec_id) as vec_id from embeddings group by label) f
      on e.vec_id = f.vec_id"""


def _embeddings(spark, sf):
    e = dom(spark, sf).embeddings
    return e.select(F.col("label").cast("int").alias("product_id"), F.col("vec_id").alias("id"), "embedding")


@register(
    "first_embedding",
    f"""select e.label as product_id, e.vec_id as id, {EMB_NORM.replace('embedding', 'e.embedding')} as vec_norm
       from embeddings e join (select label, min(vec_id) as vec_id from embeddings group by label) f
         on e.vec_id = f.vec_id""",
)
def q_first_embedding(spark, sf):
    f = SIM.first_embedding(_embeddings(spark, sf))
    return f.select("product_id", "id", F.round(SIM.l2_norm("embedding"), 6).alias("vec_norm"))


@register(
    "similar_products",
    f"""select query_id, cast(rank as integer) as rank, id, round(score, 6) as score
       from (select *, row_number() over (partition by query_id order by round(score, 9) desc, id) as rank
             from (select q.query_id, e.vec_id as id,
                          list_dot_product(cast(q.embedding as double[]), cast(e.embedding as double[]))
                          / (sqrt(list_dot_product(cast(q.embedding as double[]), cast(q.embedding as double[])))
                             * sqrt(list_dot_product(cast(e.embedding as double[]), cast(e.embedding as double[]))))
                          as score
                   from t_queries q cross join embeddings e
                   where e.vec_id <> q.query_id))
       where rank <= {P.TOP_K}""",
    {"t_queries": QUERY_VECTORS},
)
def q_similar_products(spark, sf):
    # Queries: the first vector of every product (label); catalogue: all vectors.
    emb = _embeddings(spark, sf)
    queries = SIM.first_embedding(emb).select(F.col("id").alias("query_id"), "embedding")
    return SIM.similar_products(emb.select("id", "embedding"), queries, P.TOP_K)


# ---------------------------------------------------------------------------
# Declared expressions (functional indexes, text keys, NVL, suffix access path)
# ---------------------------------------------------------------------------
@register(
    "null_to_zero",
    "select id, coalesce(shop_id, 0) as shop_id_or_zero from "
    "(select s.id, case when s.shop_id in (select id from v_shop where active = 'Y') then s.shop_id end as shop_id "
    "from v_sell s)",
)
def q_null_to_zero(spark, sf):
    from ..operators.keys import fk_nullify

    d = dom(spark, sf)
    s = fk_nullify(d.v_sell, {"shop_id": d.v_shop.where(F.col("active") == "Y")})
    return s.select("id", X.zero_if_null("shop_id").alias("shop_id_or_zero"))


@register(
    "day_trunc",
    "select cast(cast(sell_date as date) as timestamp) as day, count(*) as n_sells from v_sell group by all",
)
def q_day_trunc(spark, sf):
    return dom(spark, sf).v_sell.groupBy(X.day_trunc("sell_date").alias("day")).agg(
        F.count(F.lit(1)).alias("n_sells")
    )


@register(
    "month_trunc",
    "select cast(date_trunc('month', sell_date) as timestamp) as month, count(*) as n_sells "
    "from v_sell group by all",
)
def q_month_trunc(spark, sf):
    return dom(spark, sf).v_sell.groupBy(X.month_trunc("sell_date").alias("month")).agg(
        F.count(F.lit(1)).alias("n_sells")
    )


@register(
    "date_text_key",
    "select id, strftime(sell_date, '%Y%m%d') as day_key, strftime(sell_date, '%m%Y') as month_key, "
    "strftime(sell_date, 'y%Ym%m') as partition_suffix from v_sell",
)
def q_date_text_key(spark, sf):
    s = dom(spark, sf).v_sell
    return s.select(
        "id",
        X.date_text_key("sell_date", "yyyyMMdd").alias("day_key"),
        X.date_text_key("sell_date", "MMyyyy").alias("month_key"),
        X.partition_suffix("sell_date").alias("partition_suffix"),
    )


@register(
    "suffix_search",
    "select id, description from v_product where lower(description) like '%ring'",
)
def q_suffix_search(spark, sf):
    p = dom(spark, sf).v_product
    return p.where(X.suffix_match("description", "RING")).select("id", "description")
