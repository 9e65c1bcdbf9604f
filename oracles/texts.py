"""One DuckDB query for each Spark query that SQL can express over whole tables."""

from __future__ import annotations

from oracles.views import with_views

DAY = 86400


def ratio(num: str, den: str, digits: int = 2) -> str:
    """num/den rounded half up, from whole numbers."""
    scale = 10 ** digits
    return (f"cast((2 * cast({num} as hugeint) * {scale} + cast({den} as hugeint)) "
            f"// nullif(2 * cast({den} as hugeint), 0) as double) / {scale}.0")


def signed_ratio(num: str, den: str, digits: int = 2) -> str:
    """The same for numbers below zero, half away from zero."""
    return f"sign({num}) * {ratio(f'abs({num})', den, digits)}"


def pct(num: str, den: str, digits: int = 2) -> str:
    return ratio(f"100 * ({num})", den, digits)


def money_avg(total: str, n: str) -> str:
    return ratio(f"{total} * 100", f"({n}) * 100", 2)


def ts(col: str) -> str:
    return f"strftime({col}, '%Y-%m-%d %H:%M:%S.%f')"


def day(col: str) -> str:
    return f"strftime({col}, '%Y-%m-%d')"


EVENT = (f"event_id, {ts('ts')} as ts, user_id, session_id, event_type, product_id, platform, source")

_TEXTS = {
    # ------------------------------------------------------------- extracts
    "dim_product": """
select product_id, product_name, category, shop, seller_id, cast(base_price as double) as base_price, is_approved
from dim_product""",
    "dim_customer": "select * from dim_customer",
    "fact_order_line": f"""
select order_id, customer_id, {ts('order_date')} as order_date, status, ship_province, promotion_id, product_id,
       variant_id, quantity, cast(line_revenue as double) as line_revenue from fact_order_line""",
    "fact_shipment": f"""
select order_id, tracking_no, carrier, status, {ts('shipped_at')} as shipped_at, {ts('delivered_at')} as delivered_at
from fact_shipment""",
    "order_line_wide": f"""
select order_id, customer_id, {ts('order_date')} as order_date, status, ship_province, promotion_id, variant_id,
       quantity, cast(line_revenue as double) as line_revenue, l.product_id, seller_id, category, product_name, shop
from fact_order_line l join dim_product p on p.product_id = l.product_id""",
    "table_counts": """
select 'seller' as table_name, count(*) as row_count from dim_seller
union all select 'customer', count(*) from dim_customer union all select 'product', count(*) from dim_product
union all select 'variant', count(*) from variant union all select 'inventory', count(*) from inventory
union all select 'promotion', count(*) from promotion union all select 'orders', count(*) from fact_order
union all select 'order_line', count(*) from fact_order_line union all select 'payment', count(*) from payment
union all select 'shipment', count(*) from fact_shipment union all select 'review', count(*) from review
union all select 'scan', count(*) from shipment_scan union all select 'event', count(*) from clickstream""",
    "dataset_inventory": """
select 'nation' as table_name, cast(1 as bigint) as files, count(*) as row_count from nation
union all select 'customer', 1, count(*) from customer union all select 'supplier', 1, count(*) from supplier
union all select 'part', 1, count(*) from part union all select 'orders', 1, count(*) from orders
union all select 'lineitem', 1, count(*) from lineitem union all select 'events', 1, count(*) from events""",
    # ----------------------------------------------------------------- lake
    "events_by_month": """
select event_month, count(*) as events, count(distinct session_id) as sessions from clickstream group by 1""",
    "write_events_lake": """
select event_month, event_type, count(*) as events, cast(sum(revenue) as double) as revenue
from clickstream group by 1, 2""",
    "events_month_pruned": """
select event_month, platform, count(*) as events from clickstream where event_month = '2024-01' group by 1, 2""",
    "events_flat": f"""
select cast(event_id as varchar) as event_id, session_id, user_id, event_type, {ts('ts')} as timestamp,
       case when source = 'mock' then platform end as platform, case when source = 'mock' then 'Hue' end as province,
       case when source = 'mock' then 'ads' end as channel, product_id, cast(revenue as double) as revenue,
       cast(null as bigint) as quantity, 'mock' as source, event_month from clickstream""",
    "scans_clean": f"select tracking_no, order_id, station, {ts('scanned_at')} as scanned_at from shipment_scan",
    "export_csv": f"""
select product_id, product_name, category, shop, orders, cast(units_sold as bigint) as units_sold,
       cast(revenue as double) as revenue, product_view, add_to_cart, remove_from_cart,
       {pct('units_sold', 'product_view')} as view_to_sale_pct from merged_all""",
    "curated_read": f"""
select product_id, product_name, category, shop, orders, cast(units_sold as bigint) as units_sold,
       cast(revenue as double) as revenue, product_view, add_to_cart, remove_from_cart,
       {pct('units_sold', 'product_view')} as view_to_sale_pct
from merged_all order by merged_all.revenue desc, product_id limit 200""",
    "coerce_numeric": """
select o_orderkey, o_totalprice as price_text, o_orderpriority as priority_text,
       case when o_orderkey % 2 = 0 then cast(o_custkey as double) end as sparse_text from orders""",
    # --------------------------------------------------- business questions
    "revenue_month_category": f"""
select {day("date_trunc('month', order_date)")} as month, category, count(distinct order_id) as orders,
       cast(sum(quantity) as bigint) as units, cast(sum(line_revenue) as double) as revenue
from fact_order_line l join dim_product p on p.product_id = l.product_id where status = 'Delivered' group by 1, 2""",
    "top_sellers_in_range": """
select p.product_id, product_name, category, shop, cast(sum(quantity) as bigint) as units,
       cast(sum(line_revenue) as double) as revenue
from fact_order_line l join dim_product p on p.product_id = l.product_id
where status = 'Delivered' and order_date >= date '1996-01-01' and order_date < date '1997-12-31' + interval 1 day
group by p.product_id, product_name, category, shop order by units desc, p.product_id limit 10""",
    "rfm": """
with base as (
    select l.customer_id, full_name, province,
           date_diff('day', cast(max(order_date) as date), date '2001-12-31') as recency,
           count(distinct order_id) as frequency, sum(line_revenue) as monetary
    from fact_order_line l join dim_customer c on c.customer_id = l.customer_id
    where status = 'Delivered' group by l.customer_id, full_name, province),
scored as (
    select *, ntile(5) over (order by recency desc, customer_id) as r,
           ntile(5) over (order by frequency, customer_id) as f,
           ntile(5) over (order by monetary, customer_id) as m from base)
select customer_id, full_name, province, recency, frequency, cast(monetary as double) as monetary, r, f, m,
       case when r >= 4 and f >= 4 and m >= 4 then 'VIP-Champions' when r >= 3 and f >= 3 then 'Loyal'
            when r >= 4 and f <= 2 then 'Promising' when r <= 2 and f >= 3 then 'At-risk' else 'Regular' end as segment
from scored""",
    "cancel_rate": f"""
select ship_province as province, count(*) as orders, count(*) filter (where status = 'Cancelled') as cancelled,
       {pct("count(*) filter (where status = 'Cancelled')", 'count(*)')} as cancel_pct,
       mode(cancel_reason order by cancel_reason) as top_reason
from fact_order group by ship_province""",
    "low_stock": """
select sku, product_name, category, shop, quantity_on_hand as on_hand, safety_stock as safety,
       safety_stock - quantity_on_hand as shortfall,
       case when quantity_on_hand = 0 then 'OUT' when quantity_on_hand < safety_stock * 0.5 then 'CRITICAL'
            else 'WARN' end as level
from inventory i join variant v on v.variant_id = i.variant_id join dim_product p on p.product_id = v.product_id
where quantity_on_hand < safety_stock""",
    "seller_scorecard": f"""
with sales as (
    select seller_id, count(distinct order_id) as orders, sum(line_revenue) as revenue
    from fact_order_line l join dim_product p on p.product_id = l.product_id
    where status = 'Delivered' group by seller_id),
listed as (select seller_id, count(*) as products from dim_product group by seller_id),
marks as (select seller_id, count(*) as reviews, sum(rating) as stars
          from review r join dim_product p on p.product_id = r.product_id group by seller_id)
select s.seller_id, s.shop, s.province, coalesce(orders, 0) as delivered_orders,
       cast(coalesce(revenue, 0) as double) as revenue, coalesce(products, 0) as products,
       {ratio('stars', 'reviews')} as avg_rating, coalesce(reviews, 0) as reviews,
       rank() over (order by coalesce(sales.revenue, 0) desc) as revenue_rank
from dim_seller s left join sales on sales.seller_id = s.seller_id left join listed on listed.seller_id = s.seller_id
left join marks on marks.seller_id = s.seller_id""",
    "aov_month_channel": f"""
select {day("date_trunc('month', order_date)")} as month, method, count(*) as orders,
       {money_avg('sum(total - discount)', 'count(*)')} as aov, cast(sum(total - discount) as double) as revenue
from order_discount d join payment p on p.order_id = d.order_id
where d.status = 'Delivered' and p.status = 'Paid' group by 1, 2""",
    "promotion_effect": f"""
with used as (
    select promotion_id, count(*) as orders, sum(total) as gross, sum(discount) as discount,
           {money_avg('sum(total)', 'count(*)')} as aov
    from order_discount where status = 'Delivered' and promotion_id is not null group by promotion_id)
select promo_code, cast(discount_pct as double) as discount_pct, {day('start_date')} as start_date,
       {day('end_date')} as end_date, coalesce(orders, 0) as orders, cast(coalesce(gross, 0) as double) as gross,
       cast(coalesce(discount, 0) as double) as discount, aov as aov_with,
       (select {money_avg('sum(total)', 'count(*)')} from order_discount
        where status = 'Delivered' and promotion_id is null) as aov_without
from promotion p left join used u on u.promotion_id = p.promotion_id""",
    "delivery_time": f"""
with ranked as (
    select carrier, seconds, row_number() over (partition by carrier order by seconds) - 1 as i,
           95 * (count(*) over (partition by carrier) - 1) as pos from timed
    where shipped_at is not null and seconds is not null),
p95 as (
    select carrier, max(case when i = pos // 100 then seconds end) as lo,
           max(case when i = pos // 100 + 1 then seconds end) as hi, max(pos) % 100 as part from ranked group by carrier)
select t.carrier, count(*) as shipments, count(*) filter (where status = 'Delivered') as delivered,
       count(*) filter (where status = 'Failed') as failed,
       {ratio('sum(seconds)', f'count(seconds) * {DAY}')} as avg_days,
       {ratio('max(lo * 100 + (coalesce(hi, lo) - lo) * part)', str(100 * DAY))} as p95_days
from timed t left join p95 on p95.carrier = t.carrier where shipped_at is not null group by t.carrier""",
    "low_rating_rate": f"""
select category, count(*) as reviews, count(*) filter (where rating <= 2) as low,
       {pct('count(*) filter (where rating <= 2)', 'count(*)')} as low_pct,
       {ratio('sum(rating)', 'count(*)')} as avg_rating
from review r join dim_product p on p.product_id = r.product_id group by category having low_pct >= 0""",
    "low_rating_rate_by_seller": f"""
select seller_id, count(*) as reviews, count(*) filter (where rating <= 2) as low,
       {pct('count(*) filter (where rating <= 2)', 'count(*)')} as low_pct,
       {ratio('sum(rating)', 'count(*)')} as avg_rating
from review r join dim_product p on p.product_id = r.product_id group by seller_id having low_pct >= 40""",
    # --------------------------------------------------------------- merges
    "product_merge": f"""
select product_id, product_name, category, shop, orders, cast(units as bigint) as units,
       cast(revenue as double) as revenue, views, carts, {pct('units', 'views')} as view_to_order_pct from merged""",
    "high_view_low_sale": """
select product_id, product_name, category, views, cast(revenue as double) as revenue from merged
where views > 10 and revenue < 500000""",
    "top_products_per_category": """
select category, rank, product_id, product_name, shop, cast(units as bigint) as units, cast(revenue as double) as revenue
from (select *, row_number() over (partition by category order by revenue desc, product_id) as rank from merged)
where rank <= 3""",
    "product_revenue_all_status": """
select product_id, product_name, category, shop, orders, cast(units_sold as bigint) as units_sold,
       cast(revenue as double) as revenue from merged_all""",
    "product_merge_all_status": f"""
select product_id, product_name, category, shop, orders, cast(units_sold as bigint) as units_sold,
       cast(revenue as double) as revenue, product_view, add_to_cart, remove_from_cart,
       {pct('units_sold', 'product_view')} as view_to_sale_pct from merged_all""",
    "funnel": f"""
select step, cast(step_no as bigint) as step_no, sessions, events,
       {pct('sessions', "(select greatest(sessions, 1) from steps where step_no = 1)")} as pct from steps""",
    "funnel_max_base": f"""
select step, cast(step_no as bigint) as step_no, sessions, events,
       {pct('sessions', '(select greatest(max(sessions), 1) from steps)')} as pct from steps where events > 0""",
    "lake_monthly_revenue": """
select strftime(order_date, '%Y-%m') as month, category, cast(round(sum(line_revenue), 0) as double) as revenue,
       cast(sum(quantity) as bigint) as units
from fact_order_line l join dim_product p on p.product_id = l.product_id where status = 'Delivered' group by 1, 2""",
    "carrier_merge": f"""
select t.carrier, count(*) as shipments, {ratio('sum(seconds)', f'count(*) * {DAY}')} as avg_days,
       {ratio('quantile_disc(seconds, 0.95)', str(DAY))} as p95_days,
       {ratio('sum(scans)', 'count(scans)', 1)} as avg_scans, {ratio('sum(stations)', 'count(scans)', 1)} as avg_stations
from timed t left join scan_count c on c.tracking_no = t.tracking_no
where shipped_at is not null and delivered_at is not null group by t.carrier""",
    "scan_counts": "select tracking_no, scans, stations from scan_count",
    "shipment_merge": f"""
select order_id, t.tracking_no, carrier, status, seconds / {DAY}.0::double as delivery_days,
       coalesce(scans, 0) as scans, stations
from timed t left join scan_count c on c.tracking_no = t.tracking_no where shipped_at is not null""",
    "merge_match_counts": """
select 'product' as merge, count(*) as row_count, count(*) filter (where product_view > 0) as matched from merged_all
union all
select 'shipment', count(*), count(c.tracking_no) from fact_shipment s left join scan_count c
on c.tracking_no = s.tracking_no where shipped_at is not null""",
    "hourly_platform": """
select hour(ts) as hour, platform, count(*) as events from clickstream group by 1, 2""",
    "engagement": """
select product_id, event_type, count(*) as events, count(distinct session_id) as sessions from clickstream
where product_id is not null group by 1, 2""",
    "event_stats": """
select 'total' as metric, count(*) as events from clickstream
union all select 'live', count(*) from clickstream where source = 'live_ui'
union all select concat('type:', event_type), count(*) from clickstream group by event_type""",
    # ------------------------------------------------------------- insights
    "insight_funnel": f"""
with r as (select max(sessions) filter (where step_no = 1) as a, max(sessions) filter (where step_no = 2) as b,
                  max(sessions) filter (where step_no = 3) as c, max(sessions) filter (where step_no = 4) as d from steps)
select {signed_ratio('100 * (greatest(a, 1) - d)', 'greatest(a, 1)', 1)} as drop_pct, {pct('b', 'greatest(a, 1)', 1)} as cart_pct,
       {pct('c', 'greatest(a, 1)', 1)} as checkout_pct from r""",
    "monthly_trend": f"""
select 'total' as series, {day('month')} as month, cast(sum(revenue) as double) as revenue from monthly group by month
union all
select category, {day('month')}, cast(revenue as double) from monthly
where category in (select category from monthly group by category order by sum(revenue) desc, category limit 4)""",
    "insight_months": f"""
with t as (select month, sum(revenue) as revenue from monthly group by month)
select (select {day('month')} from t order by revenue desc, month limit 1) as best_month,
       (select cast(max(revenue) as double) from t) as best_revenue,
       (select {day('month')} from t order by revenue, month limit 1) as worst_month,
       (select cast(min(revenue) as double) from t) as worst_revenue""",
    "insight_view_revenue": """
with r as (
    select *, (rank() over (order by product_view) + (count(*) over (partition by product_view) - 1) / 2.0)
              / count(*) over () as v,
           (rank() over (order by revenue) + (count(*) over (partition by revenue) - 1) / 2.0)
              / count(*) over () as w from viewed)
select round(corr(product_view, cast(revenue as double)), 6) as corr, count(*) as products,
       count(*) filter (where v > 0.75 and w < 0.35) as leak_count from r""",
    "leak_products": """
with r as (
    select *, (rank() over (order by product_view) + (count(*) over (partition by product_view) - 1) / 2.0::double)
              / count(*) over () as v,
           (rank() over (order by revenue) + (count(*) over (partition by revenue) - 1) / 2.0::double)
              / count(*) over () as w from viewed)
select product_id, product_name, category, product_view as views, cast(revenue as double) as revenue,
       cast(v as double) as views_pct, cast(w as double) as revenue_pct from r where v > 0.75 and w < 0.35""",
    "view_revenue_points": """
select product_id, category, product_view as views, cast(revenue as double) as revenue from viewed
where category in (select category from viewed group by category order by count(*) desc, category limit 6)""",
    "hour_matrix": "select platform, "
                   + ", ".join(f"cast(sum(case when hour = {h} then events else 0 end) as bigint) as h{h:02d}"
                               for h in range(24)) + " from hours group by platform",
    "insight_hours": """
with h as (select hour, sum(events) as n from hours group by hour),
     p as (select platform, sum(events) as n from hours group by platform)
select (select hour from h order by n desc, hour limit 1) as peak_hour,
       (select hour from h order by n, hour limit 1) as quiet_hour,
       (select platform from p order by n desc, platform limit 1) as top_platform""",
    "carrier_perf": f"""
select carrier, {ratio('seconds', f'n * {DAY}', 4)} as days, {ratio('scans', 'n', 4)} as scans, n from carrier_means""",
    "insight_carriers": f"""
with a as (select carrier, seconds / (n * {DAY}.0::double) as days, scans / n::double as scans from carrier_means),
s as (select (select carrier from a order by days, carrier limit 1) as fastest,
             (select carrier from a order by days desc, carrier desc limit 1) as slowest,
             round(max(days) - min(days), 6) as gap,
             case when count(*) > 2 then round(corr(days, scans), 6) end as corr from a)
select fastest, slowest, gap, corr, case when corr >= 0.6 then 'together' when corr <= -0.6 then 'opposite'
       else 'weak' end as relation from s""",
    "category_mix": f"""
select category, cast(sum(revenue) as double) as revenue, cast(sum(product_view) as bigint) as views,
       {ratio('sum(product_view) * 100000000000', 'sum(revenue) * 100')} as view_per_billion
from merged_all group by category order by sum(merged_all.revenue) desc, category limit 10""",
    "insight_categories": """
with c as (select category, sum(revenue) as revenue, sum(product_view) as views from merged_all group by category
           order by sum(merged_all.revenue) desc, category limit 10)
select (select category from c order by revenue desc, category limit 1) as leader,
       (select category from c where revenue > 0 order by views / cast(revenue as double) desc, revenue desc, category
        limit 1) as hot""",
    # ----------------------------------------------------- shop and history
    "category_counts": """
select category, count(*) as products from dim_product where is_approved group by category""",
    "product_search": f"""
select p.product_id, product_name, cast(base_price as double) as base_price, category, shop, i.variant_id, sku,
       cast(base_price + price_adjust as double) as sell_price, quantity_on_hand, coalesce(avg_rating, 0.0) as avg_rating
from dim_product p join variant v on v.product_id = p.product_id join inventory i on i.variant_id = v.variant_id
left join (select product_id, {ratio('sum(rating)', 'count(*)', 1)} as avg_rating from review group by product_id) r
  on r.product_id = p.product_id
where is_approved and product_name ilike '%WIDGET%' order by quantity_on_hand desc, p.product_id, i.variant_id limit 24""",
    "customer_list": """
select customer_id, full_name, province from dim_customer order by customer_id limit 30""",
    "inventory_lookup": """
select variant_id, quantity_on_hand, safety_stock from inventory
where variant_id in (select variant_id from fact_order_line where status in ('Pending', 'Confirmed'))""",
    "product_popularity": """
select p.product_id, cast(coalesce(sum(quantity), 0) as bigint) as units
from dim_product p left join fact_order_line l on l.product_id = p.product_id where is_approved group by p.product_id""",
    "user_history": f"""
select {EVENT}, row_number() over (partition by user_id order by clickstream.ts desc, event_id desc) as seq
from clickstream""",
    "events_by_type_range": f"""
select {EVENT} from clickstream where event_type = 'product_view'
and clickstream.ts >= timestamp '2024-01-08' and clickstream.ts < timestamp '2024-01-22'""",
    "session_replay": f"""
select {EVENT}, row_number() over (partition by session_id order by clickstream.ts, event_id) as seq from clickstream""",
    "shipment_journey": f"""
select tracking_no, order_id, station, {ts('scanned_at')} as scanned_at,
       row_number() over (partition by tracking_no order by shipment_scan.scanned_at, station) as seq from shipment_scan""",
    "session_chunks": """
with s as (select *, row_number() over (partition by session_id order by clickstream.ts, event_id) as seq from clickstream)
select session_id, (seq - 1) // 3 as chunk, min(seq) as first_seq, count(*) as n,
       string_agg(concat_ws(':', seq, event_id, event_type, product_id), ',' order by seq) as steps from s group by 1, 2""",
    "shipment_chunks": """
with s as (select *, row_number() over (partition by tracking_no order by shipment_scan.scanned_at, station) as seq
           from shipment_scan)
select tracking_no, (seq - 1) // 2 as chunk, min(seq) as first_seq, count(*) as n,
       string_agg(concat_ws(':', seq, order_id, station), ',' order by seq) as steps from s group by 1, 2""",
    "curated_refresh": """
select event_month, event_type, platform, count(*) as events, count(distinct session_id) as sessions
from clickstream group by 1, 2, 3""",
    "recent_events": f"""
select {EVENT} from clickstream order by clickstream.ts desc, event_id desc limit 25""",
    "scan_reconcile": """
with a as (select order_id, count(*) as n from fact_shipment group by order_id),
     b as (select order_id, count(*) as n from shipment_scan group by order_id)
select coalesce(a.order_id, b.order_id) as order_id, coalesce(a.n, 0) as shipments, coalesce(b.n, 0) as scans,
       case when b.n is null then 'no scan' when a.n is null then 'no shipment' else 'matched' end as state
from a full join b on a.order_id = b.order_id""",
    # ------------------------------------------------------------ integrity
    "dq_checks": """
select 'customer.email' as rule, cast(null as bigint) as violations
union all select 'seller.rating', null
union all select 'orders.discount', count(*) filter (where discount < 0) from order_discount
union all select 'payment.paid_at', null
union all select 'product.price' as rule, count(*) filter (where not base_price > 0) as violations from dim_product
union all select 'inventory.quantity', count(*) filter (where quantity_on_hand < 0) from inventory
union all select 'inventory.safety', count(*) filter (where safety_stock < 0) from inventory
union all select 'promotion.pct', count(*) filter (where discount_pct <= 0 or discount_pct > 100) from promotion
union all select 'promotion.range', count(*) filter (where end_date < start_date) from promotion
union all select 'orders.status', count(*) filter (where status not in
    ('Pending', 'Confirmed', 'Shipping', 'Delivered', 'Cancelled', 'Returned')) from fact_order
union all select 'orders.cancel', count(*) filter (where status = 'Cancelled' and cancel_reason is null) from fact_order
union all select 'order_line.quantity', count(*) filter (where quantity <= 0) from fact_order_line
union all select 'order_line.price', count(*) filter (where line_revenue <= 0) from fact_order_line
union all select 'payment.status', count(*) filter (where status not in ('Pending', 'Paid', 'Failed', 'Refunded')) from payment
union all select 'payment.method', count(*) filter (where method not in
    ('COD', 'CreditCard', 'EWallet', 'BankTransfer')) from payment
union all select 'payment.amount', count(*) filter (where amount < 0) from payment
union all select 'shipment.status', count(*) filter (where status not in
    ('Preparing', 'Picked', 'InTransit', 'Delivered', 'Failed')) from fact_shipment
union all select 'shipment.dates', count(*) filter (where delivered_at < shipped_at) from fact_shipment
union all select 'review.rating', count(*) filter (where rating not between 1 and 5) from review""",
    "dq_unique": "\nunion all\n".join(
        f"select '{rule}' as rule, count(*) as repeated_keys, cast(coalesce(sum(n - 1), 0) as bigint) as extra_rows "
        f"from (select {keys}, count(*) as n from {table} group by {keys} having count(*) > 1)"
        for rule, table, keys in (
            ("customer.pk", "dim_customer", "customer_id"), ("seller.shop", "dim_seller", "shop"),
            ("product.pk", "dim_product", "product_id"), ("variant.sku", "variant", "sku"),
            ("promotion.code", "promotion", "promo_code"), ("orders.pk", "fact_order", "order_id"),
            ("order_line.number", "lineitem", "l_orderkey, l_linenumber"),
            ("order_line.pk", "fact_order_line", "order_id, variant_id"),
            ("variant.pk", "variant", "variant_id"), ("inventory.pk", "inventory", "variant_id"),
            ("promotion.pk", "promotion", "promotion_id"), ("payment.order", "payment", "order_id"),
            ("shipment.order", "fact_shipment", "order_id"), ("shipment.tracking", "fact_shipment", "tracking_no"),
            ("review.once", "review", "order_id, product_id, customer_id"))),
    "dq_orphans": """
select 'orders.customer' as rule, count(*) as orphans from orders where o_custkey not in (select c_custkey from customer)
union all select 'orders.promotion', count(*) from fact_order
    where promotion_id is not null and promotion_id not in (select promotion_id from promotion)
union all select 'order_line.order', count(*) from lineitem where l_orderkey not in (select o_orderkey from orders)
union all select 'order_line.variant', count(*) from fact_order_line
    where variant_id not in (select variant_id from variant)
union all select 'product.seller', count(*) from dim_product where seller_id not in (select s_suppkey from supplier)
union all select 'variant.product', count(*) from variant where product_id not in (select product_id from dim_product)
union all select 'inventory.variant', count(*) from inventory where variant_id not in (select variant_id from variant)
union all select 'payment.order', count(*) from payment where order_id not in (select o_orderkey from orders)
union all select 'shipment.order', count(*) from fact_shipment where order_id not in (select o_orderkey from orders)
union all select 'review.product', count(*) from review where product_id not in (select product_id from dim_product)
union all select 'review.customer', count(*) from review where customer_id not in (select c_custkey from customer)
union all select 'review.order', count(*) from review where order_id not in (select o_orderkey from orders)
union all select 'event.product', count(*) from clickstream
    where product_id is not null and product_id not in (select p_partkey from part)
union all select 'event.user', count(*) from clickstream where user_id not in (select c_custkey from customer)""",
    "cascade_delete": """
with gone as (select product_id from dim_product where not is_approved),
     lost as (select variant_id from variant where product_id in (select product_id from gone))
select 'product-variant' as relation, 'cascade' as action, count(*) as touched from lost
union all select 'variant-inventory', 'cascade', count(*) from inventory where variant_id in (select variant_id from lost)
union all select 'product-review', 'cascade', count(*) from review where product_id in (select product_id from gone)
union all select 'variant-order_line', 'restrict', count(*) from lost
    where variant_id in (select variant_id from fact_order_line)
union all select 'order-order_line', 'cascade', count(*) from fact_order_line where status = 'Cancelled'
union all select 'order-payment', 'cascade', count(*) from payment where status = 'Failed'
union all select 'order-shipment', 'cascade', count(*) from fact_shipment
    where order_id in (select order_id from fact_order where status = 'Cancelled')
union all select 'order-review', 'cascade', count(*) from review
    where order_id in (select order_id from fact_order where status = 'Cancelled')
union all select 'customer-orders', 'restrict', count(*) from customer
    where c_custkey % 10 = 0 and c_custkey in (select o_custkey from orders)
union all select 'seller-product', 'cascade', count(*) from dim_product where seller_id % 10 = 0
union all select 'promotion-orders', 'set null', count(*) from fact_order where promotion_id % 2 = 0
union all select 'product-review', 'kept', count(*) from review where product_id not in (select product_id from gone)
union all select 'promotion-orders', 'without', count(*) from fact_order where promotion_id is null or promotion_id % 2 = 0""",
    "orders_with_lines": """
select order_id, customer_id, status from fact_order where order_id in (select l_orderkey from lineitem)""",
    "review_eligible": "select order_id, product_id, customer_id, rating from eligible",
    "review_rejected": "select order_id, product_id, customer_id, rating from rejected",
    "affected_sellers": """
select distinct seller_id from dim_product where product_id in
    (select product_id from eligible union select product_id from rejected)""",
    "seller_rating": f"""
select s.seller_id, coalesce({ratio('sum(rating)', 'count(rating)')}, 0.0) as rating_avg
from dim_seller s left join dim_product p on p.seller_id = s.seller_id
left join eligible e on e.product_id = p.product_id group by s.seller_id""",
    "care_queue": """
select r.order_id, r.customer_id, r.product_id, rating, product_name, shop, status
from review r join fact_order o on o.order_id = r.order_id join dim_product p on p.product_id = r.product_id
where rating <= 2""",
    "order_discount": """
select order_id, cast(total as double) as total, cast(discount as double) as discount from order_discount""",
    "order_totals": """
select order_id, cast(units as bigint) as units, cast(total as double) as total, cast(discount as double) as discount,
       cast(total - discount as double) as amount_due from order_discount""",
    "price_drift": """
with l as (select f.variant_id, line_revenue - quantity * (base_price + price_adjust) as gap
           from fact_order_line f join variant v on v.variant_id = f.variant_id
           join dim_product p on p.product_id = v.product_id)
select variant_id, count(*) as lines, count(*) filter (where gap <> 0) as drifted, cast(sum(gap) as double) as drift_amount
from l group by variant_id""",
    "status_derivation": """
select f.order_id, f.status, p.status as payment_status,
       case f.status when 'Delivered' then 'Delivered' when 'Shipping' then 'InTransit' when 'Returned' then 'Failed' end
       as shipment_status from fact_order f join payment p on p.order_id = f.order_id""",
    "promo_out_of_window": f"""
select order_id, promo_code, {day('order_date')} as order_day, {day('start_date')} as start_date,
       {day('end_date')} as end_date
from fact_order o join promotion p on p.promotion_id = o.promotion_id
where cast(order_date as date) < p.start_date or cast(order_date as date) > p.end_date""",
    "failed_payment_cancels": """
select c.order_id, c.old_status, 'Cancelled' as new_status from status_change c join payment p on p.order_id = c.order_id
where p.status = 'Failed' and c.old_status not in ('Cancelled', 'Returned', 'Delivered')""",
    "orders_to_purchase_events": f"""
select concat('order-', cast(d.order_id as varchar)) as event_id, o.customer_id as user_id, 'purchase' as event_type,
       {ts('o.order_date')} as ts, strftime(o.order_date, '%Y-%m') as event_month, 'desktop_web' as platform, d.order_id,
       cast(total as double) as revenue, 'COD' as payment_method, 'live_ui' as source
from order_discount d join fact_order o on o.order_id = d.order_id""",
    # ---------------------------------------------------------------- stock
    "stock_set_check": """
select n.variant_id, coalesce(quantity_on_hand, 0) as has, cast(needs as bigint) as needs
from (select variant_id, sum(quantity) as needs from fact_order_line group by variant_id) n
left join inventory i on i.variant_id = n.variant_id where quantity_on_hand is null or quantity_on_hand < needs""",
    "stock_set_allocate": """
with need as (select variant_id, sum(quantity) as needs from fact_order_line group by variant_id),
     short as (select count(*) > 0 as refused from need n left join inventory i on i.variant_id = n.variant_id
               where coalesce(quantity_on_hand, 0) < needs)
select i.variant_id, cast(quantity_on_hand - case when refused then 0 else coalesce(needs, 0) end as bigint) as on_hand
from inventory i left join need n on n.variant_id = i.variant_id cross join short""",
    "restock": """
select i.variant_id, quantity_on_hand as on_hand, cast(coalesce(back, 0) as bigint) as returned,
       cast(quantity_on_hand + coalesce(back, 0) as bigint) as on_hand_after
from inventory i left join (
    select variant_id, sum(quantity) as back from fact_order_line l join status_change c on c.order_id = l.order_id
    where new_status in ('Cancelled', 'Returned') and old_status not in ('Cancelled', 'Returned')
    group by variant_id) b on b.variant_id = i.variant_id""",
    "stock_line_greedy": """
with recursive queue as materialized (
    select order_id, variant_id, cast(quantity as bigint) as quantity,
           row_number() over (partition by variant_id order by order_id) as i from order_variant),
walk(i, order_id, variant_id, quantity, accepted, rest) as (
    select q.i, q.order_id, q.variant_id, q.quantity, q.quantity <= coalesce(s.quantity_on_hand, 0),
           coalesce(s.quantity_on_hand, 0)
             - case when q.quantity <= coalesce(s.quantity_on_hand, 0) then q.quantity else 0 end
    from queue q left join inventory s on s.variant_id = q.variant_id where q.i = 1
    union all
    select q.i, q.order_id, q.variant_id, q.quantity, q.quantity <= w.rest,
           w.rest - case when q.quantity <= w.rest then q.quantity else 0 end
    from walk w join queue q on q.variant_id = w.variant_id and q.i = w.i + 1)
select order_id, variant_id, quantity, accepted from walk""",
    "stock_order_atomic": """
with recursive need as materialized (select variant_id, sum(quantity) as needs from fact_order_line group by variant_id),
scarce as materialized (
    select n.variant_id, coalesce(s.quantity_on_hand, 0) as has, row_number() over (order by n.variant_id) as k
    from need n left join inventory s on s.variant_id = n.variant_id where coalesce(s.quantity_on_hand, 0) < needs),
wants as materialized (
    select o.order_id, row_number() over (order by o.order_id) as i, list(k order by k) as ks,
           list(cast(quantity as bigint) order by k) as qs
    from order_variant o join scarce c on c.variant_id = o.variant_id group by o.order_id),
walk(i, order_id, accepted, rest) as (
    select cast(0 as bigint), cast(null as bigint), true, (select list(has order by k) from scarce)
    union all
    select w.i, w.order_id, t.ok,
           case when t.ok then list_transform(p.rest, lambda r, j: r - coalesce(w.qs[list_position(w.ks, j)], 0)) else p.rest end
    from walk p join wants w on w.i = p.i + 1,
         lateral (select list_bool_and(list_transform(w.ks, lambda k, j: w.qs[j] <= p.rest[k])) as ok) t)
select o.order_id, coalesce(w.accepted, true) as accepted
from (select distinct order_id from order_variant) o left join walk w on w.order_id = o.order_id""",
    # ------------------------------------------------------------ streaming
    "stream_ingest": f"""
select cast(event_id as varchar) as event_id, session_id, user_id, event_type, {ts('ts')} as timestamp,
       case when source = 'mock' then platform else 'desktop_web' end as platform,
       case when source = 'mock' then 'Hue' else 'Ha Noi' end as province,
       case when source = 'mock' then 'ads' else 'direct' end as channel, product_id,
       cast(revenue as double) as revenue, source, event_month from clickstream""",
    "stream_event_stats": "select event_type, count(*) as events from clickstream group by event_type",
    "stream_hourly": f"""
select {ts("date_trunc('hour', ts)")} as hour_start, platform, count(*) as events from clickstream group by 1, 2""",
}

_TEXTS["recent_lake_events"] = _TEXTS["recent_events"]
_TEXTS["purchase_products"] = """
select distinct concat('order-', cast(order_id as varchar)) as event_id,
       concat(cast(customer_id as varchar), '-', strftime(order_date, '%Y%m%d')) as session_id, customer_id as user_id, product_id
from fact_order_line"""
_TEXTS["stream_orders"] = _TEXTS["stock_order_atomic"]
_TEXTS["stream_restock"] = _TEXTS["restock"]
_ATOMIC = _TEXTS["stock_order_atomic"].replace("with recursive need", "with recursive decided as (with recursive need", 1)
_TEXTS["stream_purchase_events"] = f"""
{_ATOMIC}),
bought as (select order_id, string_agg(cast(product_id as varchar), ',' order by product_id) as products
           from (select distinct order_id, product_id from fact_order_line) p group by order_id)
select concat('order-', cast(d.order_id as varchar)) as event_id,
       concat(cast(o.customer_id as varchar), '-', strftime(o.order_date, '%Y%m%d')) as session_id, o.customer_id as user_id,
       'purchase' as event_type, {ts('o.order_date')} as timestamp, strftime(o.order_date, '%Y-%m') as event_month, d.order_id,
       cast(t.total as double) as revenue, b.products, 'COD' as payment_method, 'live_ui' as source
from decided d join fact_order o on o.order_id = d.order_id join order_discount t on t.order_id = d.order_id
join bought b on b.order_id = d.order_id where d.accepted"""
_TEXTS["stream_seller_rating"] = f"""
with kept as (select product_id, case when order_id % 7 = 1 then 1 + rating % 5 else rating end as rating
              from review where order_id % 5 <> 0)
select s.seller_id, coalesce({ratio('sum(rating)', 'count(rating)')}, 0.0) as rating_avg
from dim_seller s left join dim_product p on p.seller_id = s.seller_id
left join kept k on k.product_id = p.product_id group by s.seller_id"""
_TEXTS["delete_chain"] = """
with recursive ref as materialized (
    select 'product.seller_id' as relation, 'cascade' as action, 'seller' as parent, cast(seller_id as varchar) as pk,
           'product' as child, cast(product_id as varchar) as ck from dim_product
    union all select 'variant.product_id', 'cascade', 'product', cast(product_id as varchar), 'variant', cast(variant_id as varchar) from variant
    union all select 'inventory.variant_id', 'cascade', 'variant', cast(variant_id as varchar), 'inventory', cast(variant_id as varchar) from inventory
    union all select 'orders.customer_id', 'restrict', 'customer', cast(customer_id as varchar), 'orders', cast(order_id as varchar) from fact_order
    union all select 'orders.promotion_id', 'set null', 'promotion', cast(promotion_id as varchar), 'orders', cast(order_id as varchar)
        from fact_order where promotion_id is not null
    union all select 'order_line.order_id', 'cascade', 'orders', cast(order_id as varchar), 'order_line', concat(order_id, '-', variant_id)
        from order_variant
    union all select 'order_line.variant_id', 'restrict', 'variant', cast(variant_id as varchar), 'order_line', concat(order_id, '-', variant_id)
        from order_variant
    union all select 'payment.order_id', 'cascade', 'orders', cast(order_id as varchar), 'payment', cast(order_id as varchar) from payment
    union all select 'shipment.order_id', 'cascade', 'orders', cast(order_id as varchar), 'shipment', cast(order_id as varchar) from fact_shipment
    union all select 'review.product_id', 'cascade', 'product', cast(product_id as varchar), 'review', concat(order_id, '-', product_id) from review
    union all select 'review.customer_id', 'cascade', 'customer', cast(customer_id as varchar), 'review', concat(order_id, '-', product_id) from review
    union all select 'review.order_id', 'cascade', 'orders', cast(order_id as varchar), 'review', concat(order_id, '-', product_id) from review),
reach(root, tab, k) as (
    select concat('product:', product_id), 'product', cast(product_id as varchar) from dim_product where not is_approved
    union select concat('seller:', s_suppkey), 'seller', cast(s_suppkey as varchar) from supplier where s_suppkey % 10 = 0
    union select concat('customer:', c_custkey), 'customer', cast(c_custkey as varchar) from customer where c_custkey % 10 = 0
    union select concat('orders:', order_id), 'orders', cast(order_id as varchar) from fact_order where status = 'Cancelled'
    union select concat('promotion:', promotion_id), 'promotion', cast(promotion_id as varchar) from promotion where promotion_id % 2 = 0
    union select r.root, f.child, f.ck from reach r join ref f on f.parent = r.tab and f.pk = r.k where f.action = 'cascade'),
blocked as (select distinct r.root from reach r join ref f on f.parent = r.tab and f.pk = r.k where f.action = 'restrict'),
edges as (select distinct relation, action from ref)
select e.relation, e.action, count(distinct f.ck) filter (where r.root is not null and (e.action = 'restrict' or b.root is null)) as touched
from edges e left join ref f on f.relation = e.relation left join reach r on f.parent = r.tab and f.pk = r.k
left join blocked b on b.root = r.root group by e.relation, e.action
union all
select split_part(r.root, ':', 1), case when b.root is null then 'deleted' else 'blocked' end, count(distinct r.root)
from reach r left join blocked b on b.root = r.root group by all"""
_TEXTS["stream_stock"] = (
    _TEXTS["stock_line_greedy"].replace("select order_id, variant_id, quantity, accepted from walk", "")
    + """select variant_id, count(*) as lines, count(*) filter (where accepted) as accepted,
       cast(coalesce(sum(quantity) filter (where accepted), 0) as bigint) as units from walk group by variant_id""")
_TEXTS["rfm_segments"] = (
    _TEXTS["rfm"].replace("select customer_id, full_name, province, recency, frequency, cast(monetary as double) as monetary,",
                          ", tagged as (select monetary,").replace(" r, f, m,\n       case", "\n       case")
    + ")\nselect segment, count(*) as customers, cast(sum(monetary) as double) as monetary from tagged group by segment")
_TEXTS["insight_report"] = f"""
with f as ({_TEXTS["insight_funnel"].strip()}), mo as ({_TEXTS["insight_months"].strip()}),
vr as ({_TEXTS["insight_view_revenue"].strip()}), ho as ({_TEXTS["insight_hours"].strip()}),
ca as ({_TEXTS["insight_carriers"].strip()}), ct as ({_TEXTS["insight_categories"].strip()})
""" + "\nunion all\n".join(
    f"select '{i}' as id, '{title}' as title, '{m}' as metric, "
    + (f"cast({m} as double) as value, cast(null as varchar) as label" if kind == "n"
       else f"cast(null as double) as value, cast({m} as varchar) as label") + f" from {src}"
    for i, title, src, kind, metrics in (
        ("01_funnel", "Conversion funnel", "f", "n", ("drop_pct", "cart_pct", "checkout_pct")),
        ("02_monthly_revenue", "Revenue by month", "mo", "n", ("best_revenue", "worst_revenue")),
        ("02_monthly_revenue", "Revenue by month", "mo", "l", ("best_month", "worst_month")),
        ("03_view_vs_revenue", "Views against revenue", "vr", "n", ("corr", "leak_count")),
        ("04_hourly_heatmap", "Events by hour", "ho", "n", ("peak_hour", "quiet_hour")),
        ("04_hourly_heatmap", "Events by hour", "ho", "l", ("top_platform",)),
        ("05_carrier_performance", "Carriers", "ca", "n", ("gap", "corr")),
        ("05_carrier_performance", "Carriers", "ca", "l", ("fastest", "slowest", "relation")),
        ("06_category_mix", "Categories", "ct", "l", ("leader", "hot")))
    for m in metrics)

ORACLES = {name: with_views(text) for name, text in _TEXTS.items()}
