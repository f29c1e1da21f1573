"""Domain views in plain SQL for the DuckDB oracle, and a CTE builder.

The oracle SQL of every registered query is written against these views
(mirrors of ``shelfwise.sources.views`` over the same driver tables).
"""

from __future__ import annotations

import re

VIEWS: dict[str, str] = {
    "v_shop": """
        select cast(n_nationkey as integer) as id,
               'BR' || lpad(cast(n_nationkey as varchar), 3, '0') as code,
               n_name as name,
               case when n_regionkey = 4 then 'N' else 'Y' end as active
        from nation""",
    "v_company": """
        select cast(s_suppkey as integer) as id, 'S' as type,
               'S' || lpad(cast(s_suppkey as varchar), 6, '0') as code, s_name as name,
               cast(null as varchar) as tax_id, cast(s_nationkey as varchar) as nationid,
               cast(null as varchar) as address, cast(null as varchar) as tel,
               cast(null as varchar) as fax, cast(null as varchar) as contact1,
               cast(null as varchar) as email1
        from supplier
        union all
        select cast(c_custkey as integer), 'C',
               'C' || lpad(cast(c_custkey as varchar), 6, '0'), c_name,
               cast(null as varchar), cast(c_nationkey as varchar),
               cast(null as varchar), cast(null as varchar), cast(null as varchar),
               c_mktsegment, cast(null as varchar)
        from customer""",
    "v_product": """
        select cast(p_partkey as integer) as id,
               cast(p_partkey as varchar) as pu_product_id,
               cast(substr(p_brand, 7, 10) as integer) as brand_id,
               p_brand as brand_name,
               cast(dense_rank() over (order by split_part(p_name, ' ', 2)) as integer) as category_id,
               split_part(p_name, ' ', 2) as category_name,
               cast(p_size as integer) as group_id,
               cast(dense_rank() over (order by p_type) as integer) as type_id,
               p_type as type_name,
               p_name as description,
               cast(null as varchar) as status
        from part""",
    "v_sell": """
        select o_orderkey as id, cast(c_nationkey as integer) as shop_id, o_orderdate as sell_date
        from orders join customer on o_custkey = c_custkey""",
    "v_sell_detail": """
        select ('0x' || substr(md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey,
                    cast(l_quantity as integer), cast(round(l_extendedprice * 100) as bigint),
                    strftime(l_shipdate, '%Y%m%d'))), 1, 15))::bigint as id,
               l_orderkey as sell_id,
               cast(l_suppkey as integer) as company_id,
               cast(l_partkey as integer) as product_id,
               cast(s_nationkey as integer) as shop_id,
               cast(l_quantity as integer) as qty
        from lineitem join supplier on l_suppkey = s_suppkey""",
    "v_stock_shop": """
        select cast(s_nationkey as integer) as shop_id, cast(l_partkey as integer) as product_id,
               cast(l_quantity as integer) as qty
        from lineitem join supplier on l_suppkey = s_suppkey
        where l_linestatus = 'O'""",
    "v_setting": """
        select event_id as id,
               cast(user_id % 25 as integer) as shop_id,
               cast(1 + event_id % 50 as integer) as product_group_id,
               value / 2 as min_qty,
               value as max_qty,
               1.0 + cast(json_extract_string(props, '$.k') as integer) / 100 as sell_multiply,
               cast(cast(json_extract_string(props, '$.k') as integer) as double) as show_qty,
               cast(null as integer) as category_id, cast(null as integer) as type_id,
               cast(null as integer) as brand_id, cast(null as integer) as created_by,
               cast(null as integer) as updated_by, ts as created_at, ts as updated_at
        from events""",
}


def with_views(body: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``body`` with the CTEs it (transitively) mentions, in dependency order.

    ``extra`` adds query-local CTEs (written after the views, in the given
    order, and allowed to use them).
    """
    defs = dict(VIEWS)
    local = dict(extra or {})
    defs.update(local)
    order = list(VIEWS) + list(local)

    def mentions(text: str, name: str) -> bool:
        return re.search(rf"\b{re.escape(name)}\b", text) is not None

    needed: set[str] = set()
    frontier = [body]
    while frontier:
        text = frontier.pop()
        for name in order:
            if name not in needed and mentions(text, name):
                needed.add(name)
                frontier.append(defs[name])
    ctes = [f"{n} as ({defs[n]})" for n in order if n in needed]
    return ("with " + ",\n".join(ctes) + "\n" + body) if ctes else body
