"""Named SQL relations the check queries are built from.

``src_*`` derive the nine source tables from the star schema, ``stg_*``/``dim_*``/``fact_*``/``rpt_*`` state each
model. ``with_relations`` puts the ones a query needs, directly or indirectly, in front of it.
"""

from __future__ import annotations

import re

RELATIONS: dict[str, str] = {}

RELATIONS["src_orders"] = """
select 'O' || o_orderkey as order_id,
       'C' || o_orderkey as customer_id,
       case when o_orderstatus in ('F', 'O') then 'delivered'
            when o_orderkey % 4 = 0 then 'shipped'
            when o_orderkey % 4 = 1 then 'processing'
            when o_orderkey % 4 = 2 then 'invoiced'
            else 'canceled' end as order_status,
       placed as order_purchase_timestamp,
       case when o_orderkey % 50 <> 0
            then placed + interval '1' minute * ((o_orderkey * 53) % 6000) end as order_approved_at,
       o_orderdate + interval '2' day as order_delivered_carrier_date,
       case when o_orderstatus in ('F', 'O') and o_orderkey % 97 <> 0
            then placed + interval '1' minute * ((o_orderkey * 7919) % 44640) end as order_delivered_customer_date,
       o_orderdate + interval '21' day as order_estimated_delivery_date
from (select *, cast(o_orderdate as timestamp) + interval '1' minute * ((o_orderkey * 37) % 1440) as placed
      from orders) o
"""

RELATIONS["src_customers"] = """
select 'C' || o_orderkey as customer_id,
       'U' || o_custkey as customer_unique_id,
       cast(1000 + o_custkey % 650 as int) as customer_zip_code_prefix,
       case when o_orderkey % 10 = 0 then 'MOVED_' || n_name else n_name end as customer_city,
       r_name as customer_state
from orders
join customer on c_custkey = o_custkey
join nation on n_nationkey = c_nationkey
join region on r_regionkey = n_regionkey
"""

RELATIONS["src_sellers"] = """
select 'S' || s_suppkey as seller_id,
       cast(1000 + (s_suppkey * 7) % 600 as int) as seller_zip_code_prefix,
       unnest(if(s_suppkey % 3 = 0, [n_name, 'ALT_' || n_name], [n_name])) as seller_city,
       r_name as seller_state
from supplier
join nation on n_nationkey = s_nationkey
join region on r_regionkey = n_regionkey
"""

RELATIONS["src_order_items"] = """
select 'O' || l_orderkey as order_id,
       l_linenumber as order_item_id,
       'P' || l_partkey as product_id,
       'S' || l_suppkey as seller_id,
       l_quantity / 2 + cast(3 as double) / 4 as price,
       cast(l_suppkey % 4 + 2 as double) / 4 as freight_value
from lineitem
"""

RELATIONS["src_products"] = """
select 'P' || p_partkey as product_id,
       case when p_partkey % 61 <> 0 then lower(p_type) || '_' || lower(p_brand) end as product_category_name,
       cast(p_size * 100 as int) as product_weight_g,
       cast(p_size as double) as product_length_cm,
       cast(p_size % 10 + 1 as double) as product_height_cm,
       cast(p_size % 7 + 2 as double) as product_width_cm
from part
"""

RELATIONS["src_translation"] = """
select distinct lower(p_type) || '_' || lower(p_brand) as product_category_name,
       p_type || ' ' || p_brand as product_category_name_english
from part where p_brand <> 'Brand#7'
"""

RELATIONS["src_geolocation"] = """
select cast(1000 + p_partkey % 600 as int) as geolocation_zip_code_prefix,
       cast((p_partkey * 17) % 3800 as double) / 128 - 33 as geolocation_lat,
       cast((p_partkey * 29) % 3800 as double) / 128 - 73 as geolocation_lng
from part
"""

RELATIONS["src_payments"] = """
select 'O' || o_orderkey as order_id,
       1 as payment_sequential,
       case left(o_orderpriority, 1) when '1' then 'credit_card' when '2' then 'boleto' when '3' then 'VOUCHER'
            when '4' then 'debit_card' else 'not_defined' end as payment_type,
       cast(1 + o_orderkey % 12 as int) as payment_installments,
       o_totalprice as payment_value
from orders
"""

RELATIONS["src_reviews"] = """
select case when twin = 0 then 'R' else 'R2_' end
           || case when o_orderkey % 33 = 0 and o_orderkey > 0 then o_orderkey - 1 else o_orderkey end as review_id,
       'O' || o_orderkey as order_id,
       cast(1 + (o_orderkey * 31 + twin) % 5 as int) as review_score,
       cast(null as varchar) as review_comment_title,
       cast(null as varchar) as review_comment_message,
       o_orderdate + interval '30' day as review_creation_date,
       o_orderdate + interval '30' day + interval '1' minute * ((o_orderkey * 101) % 10000) as review_answer_timestamp
from (select *, unnest(if(o_orderkey % 8 = 1, [0, 1], [0])) as twin from orders where o_orderkey % 5 <> 0) copies
"""

# --- staging -------------------------------------------------------------------------------------------------------

RELATIONS["stg_orders"] = "select * from src_orders"
RELATIONS["stg_order_items"] = "select * from src_order_items"
RELATIONS["stg_customers"] = "select * from src_customers"
RELATIONS["stg_geolocation"] = "select * from src_geolocation"

RELATIONS["stg_sellers"] = """
select pick.*
from (select distinct seller_id from src_sellers) ids,
     lateral (select * from src_sellers s where s.seller_id = ids.seller_id
              order by seller_zip_code_prefix, seller_city, seller_state limit 1) pick
"""

RELATIONS["stg_payments"] = """
select order_id, payment_sequential,
       coalesce(label, upper(payment_type[1]) || lower(payment_type[2:])) as payment_type,
       payment_installments, payment_value
from src_payments
left join (values ('credit_card', 'Credit Card'), ('boleto', 'Boleto'), ('voucher', 'Voucher'),
                  ('debit_card', 'Debit Card')) as labels(code, label) on code = lower(payment_type)
"""

RELATIONS["stg_products"] = """
select product_id,
       ifnull((select min(product_category_name_english) from src_translation t
               where t.product_category_name = p.product_category_name), 'Unknown') as product_category_name,
       product_weight_g, product_length_cm, product_height_cm, product_width_cm
from (select distinct on (product_id) * from src_products
      order by product_id, product_category_name nulls last, product_weight_g, product_length_cm, product_height_cm,
               product_width_cm) p
"""

RELATIONS["stg_reviews"] = """
select review_id, order_id, review_score, review_comment_title, review_comment_message, review_creation_date,
       review_answer_timestamp
from (select *, row_number() over (partition by review_id order by order_id, review_score, review_creation_date,
                                   review_answer_timestamp) as copy_no from src_reviews) numbered
where copy_no = 1
"""

# --- dimensions ----------------------------------------------------------------------------------------------------

RELATIONS["dim_customers"] = """
select row_number() over (order by customer_unique_id) as customer_sk, customer_unique_id,
       place.city as customer_city, place.state as customer_state
from (select customer_unique_id, min({'city': customer_city, 'state': customer_state}) as place
      from stg_customers group by customer_unique_id) persons
"""

RELATIONS["dim_sellers"] = """
select row_number() over (order by seller_id) as seller_sk, seller_id, seller_city, seller_state from stg_sellers
"""

RELATIONS["dim_products"] = """
select row_number() over (order by product_id) as product_sk, product_id, product_category_name,
       product_length_cm * product_width_cm * product_height_cm as volume_cm3, product_weight_g
from stg_products
"""

RELATIONS["zip_centre"] = """
select geolocation_zip_code_prefix as zip, sum(geolocation_lat) / count(*) as lat, sum(geolocation_lng) / count(*) as lng
from stg_geolocation group by zip
"""

RELATIONS["dim_geolocation"] = """
select zip as zip_code_prefix, round(lat, 6) as latitude, round(lng, 6) as longitude from zip_centre
"""

# --- facts ---------------------------------------------------------------------------------------------------------

# Fixed values of the business rules: labels, limits and status lists below equal those of the models.
RELATIONS["fact_orders"] = """
select order_id, customer_id, order_purchase_timestamp::date as date_key, order_status,
       order_delivered_customer_date > order_estimated_delivery_date as is_late
from stg_orders
"""

RELATIONS["fact_order_items"] = """
select order_id, order_item_id, product_id, seller_id, price as item_price, freight_value,
       price + freight_value as total_line_value
from stg_order_items
"""

RELATIONS["fact_payments"] = """
select order_id, payment_sequential, payment_type, payment_installments as installments, payment_value
from stg_payments
"""

RELATIONS["fact_reviews"] = """
select *, datediff('hour', review_creation_date, review_answer_timestamp) as response_time_hours from stg_reviews
"""

RELATIONS["fact_order_lifecycle"] = """
select order_id, lag_hours as approval_lag_hours, order_delivered_customer_date::date - placed_on as total_delivery_days,
       case when lag_hours > 48 then 'Slow Approval' else 'Fast Approval' end as approval_efficiency
from (select *, order_purchase_timestamp::date as placed_on,
             datediff('hour', order_purchase_timestamp, order_approved_at) as lag_hours from stg_orders) timed
where order_status = 'delivered'
"""

RELATIONS["fact_shipping_network"] = """
select order_id, cust_lat, cust_lng, sell_lat, sell_lng,
       6371 * acos(greatest(-1.0, least(1.0,
           cos(radians(sell_lat)) * cos(radians(cust_lat)) * cos(radians(cust_lng) - radians(sell_lng))
           + sin(radians(sell_lat)) * sin(radians(cust_lat))))) as distance_km
from stg_order_items
join (select order_id, lat as cust_lat, lng as cust_lng from stg_orders
      join stg_customers using (customer_id) join zip_centre on zip = customer_zip_code_prefix) buyers using (order_id)
join (select seller_id, lat as sell_lat, lng as sell_lng from stg_sellers
      join zip_centre on zip = seller_zip_code_prefix) vendors using (seller_id)
"""

RELATIONS["open_lines"] = """
select seller_id, order_purchase_timestamp::date as opened, order_delivered_customer_date::date as closed,
       count(*) as lines, sum(price + freight_value) as worth
from stg_order_items join stg_orders using (order_id)
where order_status in ('shipped', 'delivered', 'invoiced', 'processing')
group by all
"""

RELATIONS["snapshot_daily_seller_backlog"] = """
select seller_id, day::date as snapshot_date, cast(sum(lines) as bigint) as open_orders_count,
       round(sum(worth), 2) as revenue_in_transit
from open_lines
join (select unnest(generate_series(min(opened), max(opened), interval 1 day))::date as day from open_lines) spine
  on day between opened and coalesce(closed, day)
group by seller_id, day
"""

# --- data products -------------------------------------------------------------------------------------------------

RELATIONS["obt_sales_analytics"] = """
select order_id, order_item_id, product_id, seller_id, item_price, freight_value, total_line_value, customer_id,
       order_status, date_key as order_date, is_late, customer_unique_id, customer_city, customer_state,
       product_category_name, volume_cm3, product_weight_g, seller_city, seller_state
from fact_order_items
natural join fact_orders
natural join (select customer_id, customer_unique_id, customer_city, customer_state from stg_customers) buyers
natural join (select * exclude (product_sk) from dim_products) goods
natural join (select * exclude (seller_sk) from dim_sellers) vendors
"""

RELATIONS["delivered_lines"] = """
select customer_unique_id as person, order_id, customer_id, date_key, product_id, total_line_value
from fact_orders join fact_order_items using (order_id) join stg_customers using (customer_id)
where order_status = 'delivered'
"""

RELATIONS["rpt_customer_rfm"] = """
select person as customer_id, customer_city, customer_state, recency_days, frequency, round(money, 2) as monetary,
       r as r_score, f as f_score, m as m_score, round((r + f + m) / 3.0::double, 2) as rfm_avg,
       case when r >= 4 and f >= 4 and m >= 4 then 'Champions'
            when r >= 3 and f >= 3 then 'Loyal Customers'
            when r >= 4 and f <= 2 then 'New Customers'
            when r <= 2 and f >= 3 then 'At Risk'
            when r <= 2 and f <= 2 then 'Lost'
            else 'Other' end as rfm_segment
from (select *, max(last_day) over () - last_day as recency_days,
             ntile(5) over (order by last_day, person) as r,
             ntile(5) over (order by frequency, person) as f,
             ntile(5) over (order by money, person) as m
      from (select person, count(distinct order_id) as frequency, max(date_key) as last_day,
                   sum(total_line_value) as money
            from delivered_lines group by person) per_person) scored
join dim_customers on customer_unique_id = person
"""

RELATIONS["rpt_seller_performance"] = """
select s.seller_id, s.seller_city, s.seller_state, v.total_orders, v.total_items_sold, v.total_revenue,
       v.avg_item_price, d.avg_delivery_days, d.slow_approvals, r.avg_review_score, r.total_reviews
from dim_sellers s
join (select seller_id, count(distinct order_id) as total_orders, count(*) as total_items_sold,
             round(sum(total_line_value), 2) as total_revenue, round(avg(item_price), 2) as avg_item_price
      from fact_order_items group by 1) v on v.seller_id = s.seller_id
left join (select seller_id, round(avg(total_delivery_days), 1) as avg_delivery_days,
                  count(*) filter (approval_efficiency = 'Slow Approval') as slow_approvals
           from fact_order_lifecycle join fact_order_items using (order_id) group by 1) d on d.seller_id = s.seller_id
left join (select seller_id, round(avg(review_score), 2) as avg_review_score, count(review_id) as total_reviews
           from fact_reviews join fact_order_items using (order_id) group by 1) r on r.seller_id = s.seller_id
"""

RELATIONS["rpt_product_category_analysis"] = """
select product_category_name, count(distinct order_id) as total_orders, count(*) as total_items_sold,
       round(sum(total_line_value), 2) as total_revenue, round(avg(item_price), 2) as avg_price,
       round(avg(review_score), 2) as avg_review_score,
       count(*) filter (review_score <= 2) as low_reviews, count(review_id) as total_reviews,
       round(100::double * count(*) filter (review_score <= 2) / nullif(count(review_id), 0), 2) as low_review_pct
from fact_order_items join dim_products using (product_id)
left join (select order_id, review_id, review_score from fact_reviews) scores using (order_id)
group by product_category_name
"""

RELATIONS["rpt_shipping_efficiency"] = """
select order_id, order_status, date_key as order_date, is_late, total_delivery_days, approval_lag_hours,
       approval_efficiency, distance_km, round(distance_km / nullif(total_delivery_days, 0), 2) as km_per_day,
       case when total_delivery_days <= 7 then '0-7 days'
            when total_delivery_days <= 14 then '8-14 days'
            when total_delivery_days <= 21 then '15-21 days'
            else '22+ days' end as delivery_bucket,
       case when distance_km <= 100 then 'Local (<100km)'
            when distance_km <= 500 then 'Regional (100-500km)'
            when distance_km <= 1000 then 'Long Distance (500-1000km)'
            else 'Very Long Distance (>1000km)' end as distance_bucket
from fact_shipping_network join fact_order_lifecycle using (order_id) join fact_orders using (order_id)
"""

RELATIONS["person_months"] = """
select distinct customer_unique_id as person, date_trunc('month', date_key)::date as active_month
from fact_orders join stg_customers using (customer_id) where order_status = 'delivered'
"""

RELATIONS["rpt_cohort_retention"] = """
select cohort_month, months_since_first, cohort_customers, active_customers,
       round(active_customers * 100::double / cohort_customers, 2) as retention_pct
from (select joined_month as cohort_month, datediff('month', joined_month, active_month) as months_since_first,
             count(*) as active_customers
      from person_months join (select person, min(active_month) as joined_month from person_months group by 1) starts
           using (person) group by 1, 2) activity
join (select joined_month as cohort_month, count(*) as cohort_customers
      from (select min(active_month) as joined_month from person_months group by person) starts group by 1) sizes
  using (cohort_month)
"""

RELATIONS["rpt_revenue_trends"] = """
select month, total_orders, unique_customers, total_revenue, avg_order_value, unique_products_sold,
       lag(total_revenue) over w as prev_month_revenue,
       round((total_revenue - lag(total_revenue) over w) * 100::double / nullif(lag(total_revenue) over w, 0), 2)
           as revenue_growth_pct,
       round(avg(total_revenue) over (w rows 2 preceding), 2) as rolling_3m_avg_revenue,
       sum(total_revenue) over w as cumulative_revenue
from (select date_trunc('month', date_key)::date as month, count(distinct order_id) as total_orders,
             count(distinct customer_id) as unique_customers, round(sum(total_line_value), 2) as total_revenue,
             round(avg(total_line_value), 2) as avg_order_value, count(distinct product_id) as unique_products_sold
      from delivered_lines group by 1) monthly
window w as (order by month)
"""

RELATIONS["rpt_customer_ltv"] = """
select person as customer_id, customer_city, customer_state, first_day as first_order_date, last_day as last_order_date,
       tenure as tenure_months, orders_placed as total_orders, spend as total_spend, line_mean as avg_order_value,
       round(spend / nullif(tenure, 0), 2) as monthly_spend_rate, score_mean as avg_review_given,
       case when spend >= 500 and orders_placed >= 3 then 'High Value'
            when spend >= 200 or orders_placed >= 2 then 'Medium Value'
            else 'Low Value' end as ltv_tier,
       ntile(10) over (order by spend, person) as ltv_decile
from (select person, min(date_key) as first_day, max(date_key) as last_day,
             datediff('month', min(date_key), max(date_key)) as tenure,
             count(distinct order_id) as orders_placed, round(sum(total_line_value), 2) as spend,
             round(avg(total_line_value), 2) as line_mean
      from delivered_lines group by person) bought
join dim_customers on customer_unique_id = person
left join (select customer_unique_id as person, round(avg(review_score), 2) as score_mean
           from fact_reviews join fact_orders using (order_id) join stg_customers using (customer_id)
           group by 1) given using (person)
"""

RELATIONS["order_categories"] = """
select distinct order_id, product_category_name as category from fact_order_items join dim_products using (product_id)
"""

RELATIONS["rpt_market_basket"] = """
select category_a, category_b, together as co_occurrence_count, a.orders_with as category_a_orders,
       b.orders_with as category_b_orders, round(100::double * together / a.orders_with, 2) as pct_of_category_a,
       round(100::double * together / b.orders_with, 2) as pct_of_category_b,
       round(together::double / (a.orders_with + b.orders_with - together), 4) as jaccard_similarity
from (select x.category as category_a, y.category as category_b, count(*) as together
      from order_categories x join order_categories y on y.order_id = x.order_id and y.category > x.category
      group by 1, 2 having count(*) >= 5) pairs
join (select category, count(*) as orders_with from order_categories group by 1) a on a.category = category_a
join (select category, count(*) as orders_with from order_categories group by 1) b on b.category = category_b
"""

_NAME = re.compile(r"[a-z_0-9]+")


def with_relations(query: str) -> str:
    """``query`` preceded by the relations it uses, each after those it uses itself."""
    ordered: list[str] = []

    def need(text: str) -> None:
        for name in dict.fromkeys(_NAME.findall(text)):
            if name in RELATIONS and name not in ordered:
                need(RELATIONS[name])
                ordered.append(name)

    need(query)
    if not ordered:
        return query.strip()
    return "with " + ",\n".join(f"{name} as ({RELATIONS[name].strip()})" for name in ordered) + "\n" + query.strip()
