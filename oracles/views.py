"""The model tables as DuckDB SQL, written independently of the Spark model."""

from __future__ import annotations

import re

VIEWS = {
    "dim_seller": """
select s_suppkey as seller_id, s_name as shop, n_name as province
from supplier join nation on n_nationkey = s_nationkey""",
    "dim_customer": """
select c_custkey as customer_id, c_name as full_name, n_name as province, c_mktsegment as segment
from customer join nation on n_nationkey = c_nationkey""",
    "dim_product": """
select p_partkey as product_id, p_name as product_name, p_type as category, s_name as shop,
       s_suppkey as seller_id, cast(p_retailprice as decimal(18,2)) as base_price, p_partkey % 25 >= 2 as is_approved
from part join supplier on s_suppkey = p_partkey % (select count(*) from supplier)""",
    "variant": """
select p_partkey * 2 + k as variant_id, p_partkey as product_id,
       concat('SKU-', lpad(cast(p_partkey as varchar), 6, '0'), '-', cast(k as varchar)) as sku,
       cast(k * 10 as decimal(18,2)) as price_adjust
from part cross join (select 0 as k union all select 1 as k) ks""",
    "inventory": """
select variant_id, cast((variant_id * 37) % 900 as bigint) as quantity_on_hand,
       cast(case variant_id % 3 when 0 then 10 when 1 then 20 else 50 end as bigint) as safety_stock
from variant""",
    "promotion": """
select n_nationkey as promotion_id, concat('SALE', lpad(cast(n_nationkey as varchar), 2, '0')) as promo_code,
       cast(case n_nationkey % 6 when 0 then 5 when 1 then 10 when 2 then 15 when 3 then 20 when 4 then 30
            else 50 end as decimal(5,2)) as discount_pct,
       cast(case n_nationkey % 4 when 0 then 5000 when 1 then 10000 when 2 then 20000 else 50000 end
            as decimal(18,2)) as max_discount,
       make_date(1995 + n_nationkey % 6, 1 + n_nationkey % 12, 1) as start_date,
       make_date(1995 + n_nationkey % 6, 1 + n_nationkey % 12, 28) as end_date
from nation""",
    "fact_order": """
select o_orderkey as order_id, o_custkey as customer_id, o_orderdate as order_date,
       case when o_orderstatus = 'F' then 'Delivered'
            when o_orderstatus = 'O' and o_orderkey % 10 < 2 then 'Pending'
            when o_orderstatus = 'O' and o_orderkey % 10 < 5 then 'Confirmed'
            when o_orderstatus = 'O' then 'Shipping'
            when o_orderstatus = 'P' and o_orderkey % 10 < 7 then 'Cancelled' when o_orderstatus = 'P' then 'Returned' end as status,
       n_name as ship_province,
       case when o_orderstatus = 'P' and o_orderkey % 10 < 7 then o_orderpriority end as cancel_reason,
       case when o_orderkey % 25 < 7 then (o_orderkey // 25) % 25 end as promotion_id
from orders join customer on c_custkey = o_custkey join nation on n_nationkey = c_nationkey""",
    "fact_order_line": """
select o.order_id, o.customer_id, o.order_date, o.status, o.ship_province, o.promotion_id,
       l_partkey as product_id, l_partkey * 2 + l_linenumber % 2 as variant_id,
       cast(l_quantity as bigint) as quantity, cast(l_extendedprice as decimal(18,2)) as line_revenue
from lineitem join fact_order o on o.order_id = l_orderkey""",
    "order_discount": """
select o.order_id, o.status, o.order_date, o.promotion_id, t.total, t.units,
       case when p.promotion_id is null then cast(0 as decimal(18,2))
         else least(cast(((cast(t.total * 100 as bigint) * cast(p.discount_pct as int) + 50) // 100)
                         as decimal(18,2)) * cast(0.01 as decimal(3,2)), p.max_discount) end as discount
from fact_order o
join (select order_id, sum(line_revenue) as total, sum(quantity) as units from fact_order_line group by order_id) t
  on t.order_id = o.order_id
left join promotion p on p.promotion_id = o.promotion_id""",
    "payment": """
select o_orderkey as order_id, o_orderpriority as method,
       case f.status when 'Pending' then 'Pending' when 'Cancelled' then 'Failed' when 'Returned' then 'Refunded'
            else 'Paid' end as status,
       cast(o_totalprice as decimal(18,2)) as amount
from orders join fact_order f on f.order_id = o_orderkey""",
    "fact_shipment": """
select o.order_id, concat('TRK', lpad(cast(o.order_id as varchar), 8, '0')) as tracking_no,
       concat('CARRIER_', cast(o.order_id % 5 as varchar)) as carrier,
       case o.status when 'Delivered' then 'Delivered' when 'Shipping' then 'InTransit' else 'Failed' end as status,
       min(l_shipdate) as shipped_at, case when o.status <> 'Shipping' then max(l_shipdate) end as delivered_at
from lineitem join fact_order o on o.order_id = l_orderkey
where o.status in ('Shipping', 'Delivered', 'Returned') group by o.order_id, o.status""",
    "shipment_scan": """
select concat('TRK', lpad(cast(l_orderkey as varchar), 8, '0')) as tracking_no, l_orderkey as order_id,
       concat('ST_', cast(l_suppkey % 7 as varchar)) as station, l_shipdate as scanned_at
from lineitem""",
    "review": """
select l_orderkey as order_id, l_partkey as product_id, max(o_custkey) as customer_id,
       1 + max(cast(l_quantity as bigint)) % 5 as rating
from lineitem join orders on o_orderkey = l_orderkey group by l_orderkey, l_partkey""",
    "clickstream": """
select event_id, ts, strftime(ts, '%Y-%m') as event_month, user_id,
       concat(coalesce(cast(user_id as varchar), 'guest'), '-', strftime(ts, '%Y%m%d')) as session_id,
       case event_type when 'view' then 'product_view' when 'click' then 'add_to_cart' when 'signup' then 'checkout_start'
                       when 'error' then 'remove_from_cart' when 'purchase' then 'purchase' end as event_type,
       case when event_type in ('view', 'click', 'error') then cast(json_extract_string(props, '$.k') as bigint) end
            as product_id,
       case user_id % 4 when 0 then 'android' when 1 then 'ios' when 2 then 'mobile_web' else 'desktop_web' end as platform,
       case when event_type = 'purchase' then cast(value as decimal(18,2)) end as revenue,
       case when event_id % 10 = 0 then 'live_ui' else 'mock' end as source
from events""",
    # ---- shared steps of several queries
    "product_sales": """
select product_id, count(distinct order_id) as orders, sum(quantity) as units, sum(line_revenue) as revenue
from fact_order_line where status = 'Delivered' group by product_id""",
    "product_views": """
select product_id,
       count(distinct case when event_type = 'product_view' then session_id end) as product_view,
       count(distinct case when event_type = 'add_to_cart' then session_id end) as add_to_cart,
       count(distinct case when event_type = 'remove_from_cart' then session_id end) as remove_from_cart
from clickstream where product_id is not null group by product_id""",
    "merged": """
select p.product_id, p.product_name, p.category, p.shop, coalesce(s.orders, 0) as orders,
       coalesce(s.units, 0) as units, coalesce(s.revenue, 0) as revenue,
       coalesce(v.product_view, 0) as views, coalesce(v.add_to_cart, 0) as carts
from dim_product p left join product_sales s on s.product_id = p.product_id
left join product_views v on v.product_id = p.product_id""",
    "merged_all": """
select p.product_id, p.product_name, p.category, p.shop, coalesce(s.orders, 0) as orders,
       coalesce(s.units, 0) as units_sold, coalesce(s.revenue, 0) as revenue,
       coalesce(v.product_view, 0) as product_view, coalesce(v.add_to_cart, 0) as add_to_cart,
       coalesce(v.remove_from_cart, 0) as remove_from_cart
from dim_product p
left join (select product_id, count(distinct case when status = 'Delivered' then order_id end) as orders,
                  sum(quantity) as units, sum(line_revenue) as revenue
           from fact_order_line group by product_id) s on s.product_id = p.product_id
left join product_views v on v.product_id = p.product_id""",
    "viewed": "select * from merged_all where product_view > 0 and revenue > 0",
    "scan_count": """
select tracking_no, count(*) as scans, count(distinct station) as stations from shipment_scan group by tracking_no""",
    "timed": """
select s.*, date_diff('second', shipped_at, delivered_at) as seconds from fact_shipment s""",
    "monthly": """
select cast(date_trunc('month', order_date) as date) as month, category, sum(line_revenue) as revenue
from fact_order_line l join dim_product p on p.product_id = l.product_id
where status = 'Delivered' group by 1, 2""",
    "steps": """
select k.step, k.step_no, count(distinct c.session_id) as sessions, count(c.event_id) as events
from (values ('product_view', 1), ('add_to_cart', 2), ('checkout_start', 3), ('purchase', 4)) k(step, step_no)
left join clickstream c on c.event_type = k.step group by k.step, k.step_no""",
    "hours": """
select h.hour, p.platform, count(c.event_id) as events
from (select unnest(range(24)) as hour) h cross join (select distinct platform from clickstream) p
left join clickstream c on c.platform = p.platform and hour(c.ts) = h.hour group by 1, 2""",
    "eligible": """
select r.* from review r where exists (
    select 1 from fact_order_line l where l.order_id = r.order_id and l.customer_id = r.customer_id
       and l.product_id = r.product_id and l.status = 'Delivered')""",
    "rejected": """
select r.* from review r where not exists (
    select 1 from fact_order_line l where l.order_id = r.order_id and l.customer_id = r.customer_id
       and l.product_id = r.product_id and l.status = 'Delivered')""",
    "status_change": """
select order_id, case when order_id % 7 = 0 then 'Cancelled' when order_id % 3 = 0 then 'Shipping' else 'Pending' end
       as old_status, status as new_status from fact_order""",
    "order_variant": """
select order_id, variant_id, sum(quantity) as quantity from fact_order_line group by order_id, variant_id""",
    "carrier_means": """
select t.carrier, sum(seconds) as seconds, coalesce(sum(scans), 0) as scans, count(*) as n
from timed t left join scan_count c on c.tracking_no = t.tracking_no
where shipped_at is not null and delivered_at is not null group by t.carrier""",
}


def with_views(sql: str) -> str:
    """Prefix a query with the views it needs, in dependency order."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name, body in VIEWS.items():
            if name not in ordered and re.search(rf"\b(from|join)\s+{name}\b", text):
                visit(body)
                if name not in ordered:
                    ordered.append(name)

    visit(sql)
    views = ",\n".join(f"{name} as ({VIEWS[name].strip()})" for name in ordered)
    body = sql.strip()
    if not views:
        return body
    if body.lower().startswith("with recursive"):
        return f"with recursive {views},\n{body[len('with recursive'):].strip()}"
    if body.lower().startswith("with "):
        return f"with {views},\n{body[5:].strip()}"
    return f"with {views}\n{body}"
