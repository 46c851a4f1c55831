"""Independent SQL for every registered query, for DuckDB.

Each job is one SELECT named `j_<job>` over shop tables (`shop_*`) and other jobs; `oracle(name)` puts
the needed ones into one WITH statement. Written from the rules, in plain SQL style (windows, nested
CASE, BETWEEN joins), not from the DataFrame code.
"""

from __future__ import annotations

import re

from checks.bindings import CONVERSION_ROWS, duck_texts  # noqa: F401
from checks.columns import EXPORTS, shown_sql


def loc(x: str) -> str:
    return f"CAST(({x} AT TIME ZONE 'UTC') AT TIME ZONE 'America/Sao_Paulo' AS DATE)"


def ym(x: str) -> str:
    return f"strftime({x}, '%Y-%m')"


def my(x: str) -> str:
    return f"strftime({x}, '%m-%Y')"


def mon(x: str) -> str:
    return f"CAST(date_trunc('month', {x}) AS DATE)"


def slug(x: str) -> str:
    return f"regexp_replace(lower({x}), '[^a-z0-9]', '', 'g')"


def group_case(x: str) -> str:
    return f"""CASE WHEN {x} ILIKE '%emkt%' OR {x} ILIKE '%welcome%' OR {x} ILIKE '%howit%' OR {x} ILIKE '%baseat%'
        THEN 'emkt' WHEN {x} ILIKE '%push%' THEN 'push' WHEN {x} ILIKE '%direct%' THEN 'direct'
        WHEN {x} = 'null' THEN 'unattributed' WHEN {x} NOT ILIKE '%null%' THEN 'other' END"""


DEVICE = """CASE WHEN origin IN (1, 3) THEN 'Website' WHEN origin = 2 THEN 'iOS app' WHEN origin = 4 THEN 'Android app'
    WHEN origin = 5 THEN 'Mobile browser' {tail} END"""
FAILED = "('auth_failed','cancelled','capture_problems','fraud','risk_analysis_expired','risk_analysis_problems')"
MONTHS = "['Jan','Fev','Mar','Abr','Mai','Jun','Jul','Ago','Set','Out','Nov','Dez']"
MON_LABEL = "(" + MONTHS + "[CAST(month({0}) AS INT)] || '-' || strftime({0}, '%y'))"
TITLE = "[^a-z0-9A-Z_áéíóúÁÉÍÓÚãõÃÕàÀâêîôûÂÊÎÔÛçÇ &()äëïöüÄËÏÖÜ.-]"
AS_OF, MAIL_AS_OF = "DATE '2001-07-31'", "DATE '2024-01-31'"
PERIOD = "BETWEEN DATE '1997-08-01' AND DATE '1998-10-31'"
UTM_TEXT = ", ".join(f"coalesce(t.{c}, '') AS utm_{c}" for c in "source campaign medium term content gclid".split())
UTM_JOINED = ", ".join(
    f"CASE WHEN t.id IS NOT NULL THEN coalesce(t.{c}, '') END AS utm_{c}"
    for c in "source campaign medium term content gclid".split()
)
CAPITALIZED = "array_to_string(list_transform(string_split(lower({0}), ' '), lambda w: upper(w[1]) || w[2:]), ' ')"


def utm_lookup(prefix: str) -> str:
    fields = ", ".join(
        f"CASE WHEN t.id IS NULL THEN 'no utm' ELSE t.{c} END AS {prefix}_{c}" for c in ("source", "medium", "campaign")
    )
    group = group_case("coalesce(t.source, 'null')")
    return f"{fields}, CASE WHEN t.id IS NULL THEN 'no utm' ELSE {group} END AS {prefix}_source_group"


def month_rate(table: str, columns: str) -> str:
    return f"(SELECT month, {', '.join(f'min({c}) AS {c}' for c in columns.split())} FROM {table} GROUP BY month)"


ITEM_SUMS = """count(item_id) AS number_of_products, sum(original_item_value) AS original_order_value,
    sum(quantity) AS original_quantity, sum(all_cancelled_quantity) AS final_cancelled_quantity,
    sum(all_stockout_quantity) AS final_stockout_quantity, sum(unsold_quantity) AS final_unsold_quantity,
    sum(final_item_quantity) AS final_quantity, sum(final_item_value) AS final_order_value"""


def priced(stockout: str, cancelled: str, source: str) -> str:
    return f"""SELECT order_id, id AS item_id, campaign_id, variant_id AS product_key, quantity, final_price,
        original_price, so AS all_stockout_quantity, ca AS all_cancelled_quantity,
        quantity * final_price + shipping_price + stockout_shipping_price AS original_item_value,
        (quantity - ca - so) * final_price + shipping_price AS final_item_value,
        quantity - ca - so AS final_item_quantity, so + ca AS unsold_quantity
        FROM (SELECT i.*, {stockout} AS so, {cancelled} AS ca FROM {source})"""


COUNTED_ITEMS = """SELECT o.id AS order_id, o.state, o.user_id, o.shipping_price AS order_shipping_price,
    o.cached_final_value, i.id AS item_id, i.product_id, i.variant_id, i.campaign_id, i.name AS product_name, i.quantity,
    i.final_price, i.original_price, i.shipping_price, i.created_at, i.updated_at
    FROM shop_orders o LEFT JOIN shop_state_map m ON m.state = o.state LEFT JOIN shop_items i ON i.order_id = o.id
    WHERE coalesce(m.consider, 'error') <> 'no'"""

RULE_HIT = " AND ".join(
    f"(lower(coalesce(r.exact_{f}, '')) IN ('x', lower(c.{f}))) AND (lower(coalesce(r.like_{f}, '')) = 'x' OR "
    f"(coalesce(r.like_{f}, '') <> '' AND contains(lower(c.{f}), lower(r.like_{f}))))"
    for f in ("source", "medium", "campaign")
)


def channel_applied(source: str, prefix: str, key: str) -> str:
    open_ = "(l1 IS NULL OR trim(l1) IN ('', 'n/a'))"
    click = f"trim(coalesce(utm_gclid, '')) <> '' AND {open_}"
    search, display = f"{click} AND trim(coalesce(utm_term, '')) <> ''", f"{click} AND coalesce(utm_term, '') = ''"
    return f"""SELECT {key}, {prefix}_source,
        CASE WHEN {search} THEN 'Paid Search' WHEN {display} THEN 'Display Ads' ELSE l1 END AS level1,
        CASE WHEN {search} THEN 'Google Search' WHEN {display} THEN 'Google DCO' ELSE l2 END AS level2,
        CASE WHEN {search} THEN '' WHEN {display} THEN '' ELSE l3 END AS level3
        FROM (SELECT b.*, coalesce(c.level1, 'n/a') AS l1, coalesce(c.level2, 'n/a') AS l2,
                     coalesce(c.level3, 'n/a') AS l3
              FROM {source} b LEFT JOIN j_channel_rules c ON c.source = b.{prefix}_source
              AND c.medium = b.{prefix}_medium AND c.campaign = b.{prefix}_campaign AND c.unit = b.unit)"""


def label(n: str) -> str:
    return f"CAST(CAST({n} AS BIGINT) AS VARCHAR)"


def under(n: str) -> str:
    return f"CAST(CAST({n} - 0.01 AS DECIMAL(18,2)) AS VARCHAR)"


JOBS: dict[str, str] = {
    "source_groups": f"""SELECT source, {group_case('source')} AS source_group FROM (
        SELECT source FROM shop_utms WHERE source IS NOT NULL UNION SELECT 'null' FROM shop_utms WHERE source IS NULL)""",
    "utm_cube": f"""SELECT u.id AS utm_id, coalesce(u.source, 'null') AS source, coalesce(medium, 'null') AS medium,
        coalesce(campaign, 'null') AS campaign, g.source_group
        FROM shop_utms u LEFT JOIN j_source_groups g ON g.source = coalesce(u.source, 'null')""",
    "users_cube": f"""SELECT u.id AS user_id, email, gender, subscribed AS is_opt_in,
        CASE subscribed WHEN 0 THEN 'opt-out' WHEN 1 THEN 'opt-in' ELSE 'null' END AS email_subscription,
        {utm_lookup('user')}, {DEVICE.format(tail="ELSE 'no utm'")} AS user_origin,
        {loc('u.created_at')} AS register_date, year({loc('u.created_at')}) AS register_year,
        {ym(loc('u.created_at'))} AS register_cohort, {loc('u.most_recent_access')} AS last_web_access_date,
        {ym(loc('u.most_recent_access'))} AS web_access_cohort,
        CASE WHEN origin IN (2, 4) THEN 1 ELSE 0 END AS registered_via_app,
        CASE WHEN origin = 5 THEN 1 ELSE 0 END AS registered_via_mobile_browser,
        CASE WHEN origin IN (1, 3) THEN 1 ELSE 0 END AS registered_via_desktop,
        CASE WHEN u.most_recent_access IS NULL THEN 0 ELSE 1 END AS accessed_via_web,
        CASE WHEN s.last_access IS NOT NULL THEN 1 END AS accessed_via_app, {loc('s.last_access')} AS last_app_access_date,
        {ym(loc('s.last_access'))} AS app_access_cohort
        FROM shop_users u LEFT JOIN shop_utms t ON t.id = u.utm_id
        LEFT JOIN (SELECT user_id, max(most_recent_access) AS last_access FROM shop_app_sessions GROUP BY user_id) s
        ON s.user_id = u.id""",
    "users_buyer_flag": """SELECT u.*, CASE WHEN f.user_id IS NULL THEN 0 ELSE 1 END AS is_buyer,
        coalesce(f.ftb_cohort, '0') AS ftb_cohort FROM j_users_cube u LEFT JOIN j_first_time_buyers f USING (user_id)""",
    "non_buyers": "SELECT user_id, email, is_buyer FROM j_users_buyer_flag WHERE is_buyer IS DISTINCT FROM 1",
    "vip_cohorts": f"""SELECT id AS user_id, email AS vip_email, utm_id, origin, 1 AS vip_count,
        {loc('vip_since')} AS vip_date, {mon(loc('vip_since'))} AS vip_cohort,
        CAST(date_trunc('quarter', {loc('vip_since')}) AS DATE) AS vip_quarter
        FROM shop_users WHERE vip_since IS NOT NULL""",
    "newest_address": """SELECT user_id, city, state FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY id DESC)
        AS rn FROM shop_addresses) WHERE rn = 1""",
    "users_with_address": """SELECT u.id AS user_id, u.email, a.city, a.state FROM shop_users u
        LEFT JOIN j_newest_address a ON a.user_id = u.id""",
    "users_main_address": f"""SELECT u.id AS user_id, email AS first_register_email,
        {loc('created_at')} AS first_register_date, origin AS first_register_origin, main_address_id, a.city, a.state
        FROM shop_users u LEFT JOIN shop_addresses a ON a.id = u.main_address_id""",
    "customers_admin": f"""SELECT u.id AS customer_id, email, CAST(created_at AS DATE) AS registered_on, {UTM_JOINED},
        CASE WHEN subscribed = 1 THEN 'Sim' ELSE 'Não' END AS opt_in, gender, a.city, a.state
        FROM shop_users u LEFT JOIN shop_utms t ON t.id = u.utm_id LEFT JOIN j_newest_address a ON a.user_id = u.id""",
    "customer_source": """SELECT c.*, 'main' AS unit,
        CASE WHEN trim(coalesce(utm_source, '')) <> '' THEN utm_source ELSE coalesce(e.source, 'n/a') END AS customer_source,
        CASE WHEN trim(coalesce(utm_source, '')) <> '' THEN utm_medium ELSE coalesce(e.medium, 'n/a') END AS customer_medium,
        CASE WHEN trim(coalesce(utm_source, '')) <> '' THEN utm_campaign ELSE coalesce(e.campaign, 'n/a') END
            AS customer_campaign
        FROM j_customers_admin c LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY date, event_id)
            AS rn FROM shop_web_events) e ON e.customer_id = c.customer_id AND e.rn = 1""",
    "customers_states": """SELECT c.customer_id, CASE gender WHEN 'm' THEN 'Homem' WHEN 'f' THEN 'Mulher' END AS sex,
        trim(s.state) AS state, trim(s.region) AS region
        FROM j_customers_admin c LEFT JOIN shop_br_states s ON trim(s.state) = trim(upper(c.state))
        WHERE c.customer_id IN (SELECT customer_id FROM j_orders_base)""",
    "order_items_cube": priced(
        "CASE WHEN o.state = 'cancelled_stockout' THEN i.quantity ELSE i.stockout_quantity END",
        "CASE WHEN o.state = 'cancelled' THEN i.quantity ELSE i.cancelled_quantity END",
        "shop_items i LEFT JOIN shop_orders o ON o.id = i.order_id"),
    "order_items_plain": priced("i.stockout_quantity", "i.cancelled_quantity", "shop_items i"),
    "order_totals": f"SELECT order_id, {ITEM_SUMS} FROM j_order_items_cube GROUP BY order_id",
    "order_totals_by_state": "SELECT * FROM j_order_totals",
    "authorized_orders": f"""SELECT o.id AS order_id, o.user_id, o.state, {loc('o.created_at')} AS order_date,
        {ym(loc('o.created_at'))} AS order_cohort, year({loc('o.created_at')}) AS order_year, {utm_lookup('order')},
        {DEVICE.format(tail="ELSE 'no utm'")} AS order_origin,
        CASE WHEN origin IN (2, 4) THEN 1 ELSE 0 END AS via_app, CASE WHEN origin = 5 THEN 1 ELSE 0 END AS via_mobile_browser,
        CASE WHEN origin IN (1, 3) THEN 1 ELSE 0 END AS via_desktop, x.original_order_value, x.original_quantity,
        x.final_cancelled_quantity, x.final_stockout_quantity, x.final_unsold_quantity, x.final_quantity,
        x.final_order_value, CASE WHEN x.order_id IS NOT NULL THEN 1 END AS is_considered_order,
        CASE WHEN o.state IN ('shipping_successful', 'delivered') THEN 1 END AS is_billed_order
        FROM shop_orders o JOIN shop_state_map m ON m.state = o.state AND m.consider = 'yes'
        LEFT JOIN shop_utms t ON t.id = o.utm_id LEFT JOIN j_order_totals x ON x.order_id = o.id""",
    "first_time_buyers": f"""SELECT user_id, min(order_id) AS first_order_id, min(order_date) AS first_order_date,
        {ym('min(order_date)')} AS ftb_cohort, 1 AS ftb_count FROM j_authorized_orders GROUP BY user_id""",
    "orders_is_ftb": """SELECT a.order_id, a.user_id, a.order_cohort, CASE WHEN f.user_id IS NOT NULL THEN 1 END AS is_ftb
        FROM j_authorized_orders a LEFT JOIN j_first_time_buyers f ON f.first_order_id = a.order_id""",
    "monthly_buyer_type": """SELECT a.user_id, a.order_cohort, count(DISTINCT a.order_id) AS orders,
        CASE WHEN a.order_cohort = f.ftb_cohort THEN 1 ELSE 0 END AS is_ftb_in_month,
        CASE WHEN a.order_cohort = f.ftb_cohort THEN 'FTBs' ELSE 'Repeat Buyers' END AS buyer_type
        FROM j_authorized_orders a LEFT JOIN j_first_time_buyers f USING (user_id)
        GROUP BY a.user_id, a.order_cohort, f.ftb_cohort""",
    "orders_treated": f"""SELECT o.id AS order_id, o.user_id, {loc('o.created_at')} AS created_on,
        {mon(loc('o.created_at'))} AS order_month, {loc('o.updated_at')} AS updated_on, o.state AS order_state,
        coalesce(m.consider, 'error') AS consider, o.utm_id AS order_utm_id, cached_total_value AS basket_value,
        shipping_price AS shipping_value, cached_total_value + shipping_price AS sales_value,
        cached_credits AS credit_value, cached_final_value AS final_value,
        {DEVICE.format(tail='').replace('origin', 'o.origin')} AS order_origin, coupon_id, u.email,
        {loc('u.created_at')} AS register_date
        FROM shop_orders o LEFT JOIN shop_state_map m ON m.state = o.state LEFT JOIN shop_users u ON u.id = o.user_id""",
    "treated_first_buyers": """SELECT user_id, min(order_id) AS first_order_id, min(created_on) AS first_order_date,
        1 AS ftb_count FROM j_orders_treated WHERE consider = 'yes' GROUP BY user_id""",
    "ftb_report_users": f"""SELECT f.user_id, f.first_order_id, f.first_order_date, {mon('f.first_order_date')} AS ftb_month,
        f.ftb_count, {loc('u.created_at')} AS register_date, {mon(loc('u.created_at'))} AS register_cohort,
        v.vip_email, v.vip_count, v.vip_date, v.vip_cohort, v.vip_quarter
        FROM j_treated_first_buyers f LEFT JOIN shop_users u ON u.id = f.user_id LEFT JOIN j_vip_cohorts v ON v.user_id = f.user_id""",
    "ftb_report_orders": f"""SELECT t.order_id, t.user_id, t.created_on, t.consider, t.sales_value, v.vip_since AS vip_date,
        {mon('v.vip_since')} AS vip_cohort, CASE WHEN v.user_id IS NOT NULL THEN 1 END AS lifetime_vip,
        {mon('f.first_order_date')} AS ftb_cohort
        FROM j_orders_treated t LEFT JOIN shop_lifetime_vip v ON v.user_id = t.user_id
        LEFT JOIN j_treated_first_buyers f ON f.user_id = t.user_id""",
    "first_order_of_user": """SELECT user_id, id AS order_id, state FROM (SELECT *, row_number() OVER (PARTITION BY user_id
        ORDER BY created_at, id) AS rn FROM shop_orders) WHERE rn = 1""",
    "order_newest_version": """SELECT id, user_id, CASE WHEN state = 'pending' THEN 'captured' ELSE state END AS state,
        cached_total_value FROM shop_orders""",
    "status": """SELECT status_type, status_id, min(status_name) AS status_name FROM shop_status_names
        GROUP BY status_type, status_id""",
    "orders_admin": f"""SELECT o.id AS order_id, o.masked_id AS public_id, o.created_at, o.user_id AS customer_id, u.email,
        e.status_name AS erp_status, p.status_name AS payment_status_name, cached_final_value AS order_value,
        cached_total_value AS items_value, shipping_price AS shipping_value, {UTM_JOINED}, installments,
        o.state AS order_state, credit_card_operator, payment_method
        FROM shop_orders o LEFT JOIN shop_users u ON u.id = o.user_id
        LEFT JOIN j_status e ON e.status_type = 'status' AND e.status_id = o.status
        LEFT JOIN j_status p ON p.status_type = 'payment_status' AND p.status_id = o.payment_status
        LEFT JOIN shop_utms t ON t.id = o.utm_id""",
    "order_inclusion": """SELECT *, CASE WHEN order_state IS NOT NULL AND trim(order_state) <> '-'
            THEN CASE WHEN on_list THEN 'Sim' ELSE 'Não' END WHEN dropped THEN 'Não' ELSE 'Sim' END AS include_state,
        CASE WHEN dropped THEN 'Não' ELSE 'Sim' END AS include_erp_payment
        FROM (SELECT o.*, EXISTS (SELECT 1 FROM shop_status_lists s WHERE lower(trim(s.keep)) = 'incluir'
                AND trim(lower(s.state)) = trim(lower(o.order_state))) AS on_list,
            EXISTS (SELECT 1 FROM shop_status_lists s WHERE trim(lower(s.erp_exclude)) = trim(lower(o.erp_status)))
            OR EXISTS (SELECT 1 FROM shop_status_lists s WHERE trim(lower(s.payment_exclude)) =
                trim(lower(o.payment_status_name))) AS dropped FROM j_orders_admin o)""",
    "admin_items": """SELECT i.id AS item_id, i.order_id, i.name AS product_name, i.quantity, i.original_price AS unit_price,
        i.quantity * i.original_price AS total_price, i.final_price, i.campaign_id, p.erp_code AS product_code,
        v.erp_code AS variant_code, c.name AS category
        FROM shop_items i LEFT JOIN shop_products p ON p.id = i.product_id LEFT JOIN shop_products v ON v.id = i.variant_id
        LEFT JOIN shop_categories c ON c.id = p.main_category_id""",
    "orders_base": f"""SELECT order_id, public_id, CAST(created_at AS DATE) AS order_date, {mon('created_at')} AS month,
        year(created_at) AS order_year, customer_id, trim(erp_status) AS erp_status,
        coalesce(trim(payment_status_name), '-') AS payment_status,
        CAST((coalesce(items_value, 0) + coalesce(shipping_value, 0)) * CAST(0.98 AS DECIMAL(9,6)) AS DECIMAL(18,4)) AS revenue,
        shipping_value AS shipping_cost_shop, utm_source, utm_campaign, utm_medium, utm_term, utm_content, utm_gclid,
        CASE WHEN order_id % 3 = 0 THEN 'second' ELSE 'main' END AS unit,
        'Cartão de Crédito' AS payment_form, installments, payment_method,
        CASE WHEN lower(trim(payment_status_name)) = 'capturado' THEN 1 ELSE 0 END AS payment_confirmed,
        coalesce(lower(trim(order_state)), '-') AS order_state, credit_card_operator AS card_operator
        FROM j_orders_admin WHERE lower(trim(erp_status)) IN ('aguardando pagamento', 'capturado', 'despachado',
        'pagamento confirmado', 'faturado') AND lower(trim(payment_status_name)) IS DISTINCT FROM 'autorização falhou'""",
    "order_cardinal": """SELECT *, CASE WHEN cardinal = 1 THEN 1 ELSE 0 END AS is_ftp,
        CASE WHEN cardinal_paid = 1 THEN 1 ELSE 0 END AS is_ftp_paid FROM (
        SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY order_date, public_id) AS cardinal,
        CASE WHEN payment_confirmed = 1 THEN row_number() OVER (PARTITION BY customer_id, payment_confirmed
            ORDER BY order_date, public_id) END AS cardinal_paid FROM j_orders_base)""",
    "order_cardinal_expected": """SELECT c.*, c.is_ftp * e.conversion_factor AS is_ftp_expected
        FROM j_order_cardinal c JOIN j_conversion_estimate e USING (order_id)""",
    "customer_milestones": f"""SELECT *, {mon('register_date')} AS register_month, year(register_date) AS register_year FROM (
        SELECT c.*, f.d AS first_order_date, p.d AS first_paid_date, coalesce(n.orders, 0) AS orders,
        least(f.d, c.registered_on) AS register_date FROM j_customer_source c
        LEFT JOIN (SELECT customer_id, order_date AS d FROM j_order_cardinal WHERE is_ftp = 1) f USING (customer_id)
        LEFT JOIN (SELECT customer_id, order_date AS d FROM j_order_cardinal WHERE is_ftp_paid = 1) p USING (customer_id)
        LEFT JOIN (SELECT customer_id, count(DISTINCT order_id) AS orders FROM j_orders_base GROUP BY customer_id) n
        USING (customer_id))""",
    "months_since_first": """SELECT o.*, datediff('month', date_trunc('month', m.first_order_date),
            date_trunc('month', o.order_date)) AS months_ftp,
        datediff('month', date_trunc('month', m.first_paid_date), date_trunc('month', o.order_date)) AS months_ftp_paid
        FROM j_order_cardinal o LEFT JOIN j_customer_milestones m USING (customer_id)""",
    "conversion_days": f"""SELECT order_date, {AS_OF} - order_date AS age, sum(revenue) AS total,
        sum(CASE WHEN payment_confirmed = 1 THEN revenue ELSE 0 END) AS paid FROM j_orders_base
        WHERE {AS_OF} - order_date <= 120 GROUP BY order_date""",
    "conversion_snapshot": f"""SELECT unit, {AS_OF} AS day, rate_1_30, rate_91_120, rate_91_120 - rate_1_30 AS dif,
        revenue FROM (SELECT unit,
        1 - CAST(sum(CASE WHEN age BETWEEN 1 AND 30 THEN paid ELSE 0 END) AS DOUBLE)
          / nullif(CAST(sum(CASE WHEN age BETWEEN 1 AND 30 THEN total ELSE 0 END) AS DOUBLE), 0) AS rate_1_30,
        1 - CAST(sum(CASE WHEN age BETWEEN 91 AND 120 THEN paid ELSE 0 END) AS DOUBLE)
          / nullif(CAST(sum(CASE WHEN age BETWEEN 91 AND 120 THEN total ELSE 0 END) AS DOUBLE), 0) AS rate_91_120,
        sum(total) AS revenue FROM (SELECT unit, {AS_OF} - order_date AS age, revenue AS total,
            CASE WHEN payment_confirmed = 1 THEN revenue ELSE 0 END AS paid FROM j_orders_base
            WHERE {AS_OF} - order_date <= 120) GROUP BY unit)""",
    "conversion_history": f"""SELECT unit, day, dif, revenue FROM shop_conversion_history WHERE day <> {AS_OF}
        UNION ALL SELECT unit, day, dif, revenue FROM j_conversion_snapshot""",
    "conversion_estimate": f"""SELECT order_id, order_date, revenue, factor AS conversion_factor,
        CAST(revenue AS DOUBLE) * factor AS expected_revenue FROM (SELECT *, CASE WHEN unit <> 'main' THEN 1 ELSE 1 - greatest(0,
            (120 - ({AS_OF} - order_date)) * (SELECT coalesce(max(dif), 0.02) FROM (SELECT dif FROM j_conversion_history
                WHERE unit = 'main' AND (dif > 0.02 OR dif IS NULL) ORDER BY day DESC LIMIT 1)) / 120) END AS factor
            FROM j_orders_base)""",
    "adhoc_monthly_totals": f"""SELECT month({loc('created_at')}) AS month, count(id) AS orders,
        sum(cached_total_value) AS basket_value, sum(shipping_price) AS shipping FROM shop_orders
        WHERE state NOT IN {FAILED} AND origin = 1 AND {loc('created_at')} {PERIOD} GROUP BY 1""",
    "adhoc_daily_sales": f"""SELECT {loc('created_at')} AS order_date, count(DISTINCT id) AS orders,
        sum(cached_total_value) AS placed_basket_value, sum(shipping_price) AS placed_shipping,
        sum(cached_total_value + shipping_price) AS placed_order_value, sum(captured_shipping_price) AS captured_shipping,
        min({DEVICE.format(tail='')}) AS origin FROM shop_orders
        WHERE {loc('created_at')} {PERIOD} AND origin IN (1, 5) AND state NOT IN ('auth_failed', 'pending') GROUP BY 1""",
    "adhoc_registrations": f"""SELECT year({loc('created_at')}) AS year, month({loc('created_at')}) AS month, origin,
        count(id) AS users FROM shop_users GROUP BY ALL""",
    "adhoc_final_items": f"""SELECT user_id, {loc('o.created_at')} AS order_date, o.id AS order_id, state, i.id AS item_id,
        campaign_id, variant_id AS sku, name, final_price,
        quantity - (cancelled_quantity + stockout_quantity) AS final_quantity,
        final_price * (quantity - (cancelled_quantity + stockout_quantity)) AS basket_value,
        i.shipping_price AS item_shipping_price,
        final_price * (quantity - (cancelled_quantity + stockout_quantity)) + i.shipping_price AS final_value
        FROM shop_orders o, shop_items i WHERE o.id = i.order_id AND state NOT IN {FAILED}
        AND state <> 'cancelled_stockout' AND {loc('o.created_at')} {PERIOD}
        AND quantity - (cancelled_quantity + stockout_quantity) > 0""",
    "adhoc_orders_by_utm": f"""SELECT masked_id, {loc('o.created_at')} AS order_date, state,
        {DEVICE.format(tail='')} AS origin, utm_id, sum(cached_total_value) AS placed_basket_value,
        sum(shipping_price) AS placed_shipping, sum(cached_total_value + shipping_price) AS placed_order_value,
        source, campaign, medium, term, gclid FROM shop_orders o LEFT JOIN shop_utms u ON o.utm_id = u.id
        WHERE state NOT IN {FAILED} AND origin NOT IN (2, 4) AND {loc('o.created_at')} {PERIOD} GROUP BY ALL""",
    "adhoc_distinct_products": f"""SELECT month({loc('i.created_at')}) AS month, count(DISTINCT i.product_id) AS products
        FROM shop_items i, shop_orders o WHERE i.order_id = o.id AND o.state NOT IN {FAILED}
        AND {loc('i.created_at')} >= DATE '1997-08-01' GROUP BY 1""",
    "adhoc_users_with_utm": f"""SELECT {loc('u.created_at')} AS date, u.id AS user_id, source, medium
        FROM shop_users u LEFT JOIN shop_utms t ON u.utm_id = t.id WHERE {loc('u.created_at')} {PERIOD}""",
    # ---- catalogue
    "products_dimension": f"""SELECT v.id AS product_key, v.parent_product_id, v.sku AS sku_key,
        coalesce(CASE WHEN ta.id IS NULL THEN 'none' END, ta.label) AS age_group,
        CASE WHEN ts.id IS NULL THEN 'none' ELSE ts.label END AS size, v.supplier_size,
        {loc('v.created_at')} AS product_date, {my(loc('v.created_at'))} AS product_month,
        {loc('v.updated_at')} AS product_updated, v.name, v.original_price AS product_original_price,
        v.final_price AS product_final_price, v.erp_code, v.supplier_color, p.brand_id,
        CASE WHEN b.id IS NULL THEN 'none' ELSE b.name END AS brand_name,
        CASE WHEN tc.id IS NULL THEN 'none' ELSE tc.label END AS category,
        CASE WHEN tv.id IS NULL THEN 'none' ELSE tv.label END AS segment,
        CASE WHEN tg.id IS NULL THEN 'none' ELSE tg.label END AS gender,
        CASE WHEN tu.id IS NULL THEN 'none' ELSE tu.label END AS subcategory
        FROM (SELECT *, coalesce(parent_product_id, id) AS sku FROM shop_products WHERE parent_product_id IS NOT NULL
              OR id NOT IN (SELECT parent_product_id FROM shop_products WHERE parent_product_id IS NOT NULL)) v
        LEFT JOIN shop_products p ON p.id = v.sku LEFT JOIN shop_brands b ON b.id = p.brand_id
        LEFT JOIN shop_tags ta ON ta.id = v.age_id LEFT JOIN shop_tags ts ON ts.id = v.size_id
        LEFT JOIN shop_tags tc ON tc.id = p.category_id LEFT JOIN shop_tags tv ON tv.id = p.vertical_id
        LEFT JOIN shop_tags tg ON tg.id = p.gender_id LEFT JOIN shop_tags tu ON tu.id = p.subcategory_id""",
    "sku_category": """SELECT p.id AS product_id, parent_product_id, coalesce(parent_product_id, p.id) AS sku_key,
        c.final_category FROM shop_products p LEFT JOIN shop_category_table c ON c.id = p.id
        WHERE parent_product_id IS NOT NULL OR p.id NOT IN
        (SELECT parent_product_id FROM shop_products WHERE parent_product_id IS NOT NULL)""",
    "product_image": "SELECT id AS product_id, main_picture AS image FROM shop_products WHERE main_picture IS NOT NULL",
    "campaigns_dimension": f"""SELECT id AS campaign_id, name AS campaign_name, slug AS campaign_slug,
        year({loc('offer_starts_at')}) AS start_year, {mon(loc('offer_starts_at'))} AS start_month,
        strftime({loc('offer_starts_at')}, '%m/%d') AS starts, year({loc('offer_ends_at')}) AS end_year,
        {mon(loc('offer_ends_at'))} AS end_month, strftime({loc('offer_ends_at')}, '%m/%d') AS ends,
        CASE inventory_type WHEN 'INTERNAL' THEN 'Estoque interno' WHEN 'CONSIGNED' THEN 'Consignação'
            ELSE 'noinventorytype' END AS campaign_type,
        CASE fast_delivery WHEN 1 THEN 'Entrega Rápida' WHEN 2 THEN 'Entrega Normal' ELSE 'nodeliverytype' END
            AS delivery_type FROM shop_campaigns""",
    "campaign_stock": """SELECT d.campaign_id, d.campaign_name, p.product_id, p.stock AS initial_stock
        FROM j_campaigns_dimension d LEFT JOIN shop_campaigns_products p USING (campaign_id)""",
    "campaign_months": f"""SELECT id AS campaign_id, CASE WHEN offer_starts_at IS NULL THEN 'Null'
            ELSE {ym(loc('offer_starts_at'))} END AS month FROM shop_campaigns
        UNION ALL SELECT id, CASE WHEN offer_starts_at IS NULL THEN 'Null' ELSE {ym(loc('offer_ends_at'))} END
            FROM shop_campaigns""",
    "active_campaign_products": """SELECT DISTINCT c.campaign_id, c.month, p.product_id FROM j_campaign_months c
        LEFT JOIN shop_campaigns_products p USING (campaign_id)""",
    "active_campaigns_monthly": """SELECT month, count(DISTINCT campaign_id) AS active_campaigns
        FROM j_active_campaign_products GROUP BY month""",
    "counted_items": COUNTED_ITEMS,
    "product_revenue_items": f"""SELECT *, day({loc('created_at')}) AS order_day, month({loc('created_at')}) AS order_month,
        year({loc('created_at')}) AS order_year, strftime({loc('created_at')}, '%m/%d') AS day_label,
        {ym(loc('created_at'))} AS year_month, {my(loc('created_at'))} AS month_year, {loc('created_at')} AS order_date,
        CAST(campaign_id AS VARCHAR) || '|' || CAST(variant_id AS VARCHAR) AS campaign_product_key FROM j_counted_items""",
    "revenue_by_campaign": f"""SELECT x.*, coalesce(c.name, CAST(x.campaign_id AS VARCHAR)) AS campaign_name,
        {loc('x.created_at')} AS order_date, {ym(loc('x.created_at'))} AS order_year_month,
        {loc('x.updated_at')} AS updated_date FROM j_counted_items x LEFT JOIN shop_campaigns c ON c.id = x.campaign_id""",
    "campaign_product_list": f"""SELECT i.id AS item_id, i.variant_id, i.campaign_id, i.order_id,
        CASE WHEN p.id IS NULL THEN 'no id' ELSE p.erp_code END AS erp_product_id, o.external_id AS erp_order_id,
        {loc('o.created_at')} AS order_date, {ym(loc('o.created_at'))} AS order_year_month, c.name AS campaign_name,
        {loc('c.offer_starts_at')} AS campaign_starts, {loc('c.offer_ends_at')} AS campaign_ends,
        o.external_id || '|' || CASE WHEN p.id IS NULL THEN 'no id' ELSE p.erp_code END AS erp_key
        FROM shop_items i LEFT JOIN shop_products p ON p.id = i.variant_id LEFT JOIN shop_orders o ON o.id = i.order_id
        LEFT JOIN shop_campaigns c ON c.id = i.campaign_id""",
    "campaign_product_month_to_date": f"""SELECT * FROM j_campaign_product_list
        WHERE {mon('order_date')} = {mon(AS_OF)}""",
    "campaign_brand": f"""SELECT DISTINCT c.campaign_id, campaign_name, c.slug AS campaign_slug,
        replace(split_part(c.slug, '--', 1), '-', ' ') AS treated_slug, start_date, end_date,
        concat_ws(' - ', campaign_name, {MON_LABEL.format('start_date')}) AS label,
        concat_ws(' ', campaign_name, strftime(start_date, '%m.%y')) AS label_short, c.brand_id, b.name AS brand_name
        FROM (SELECT k.id AS campaign_id, k.name AS campaign_name, k.slug, CAST(offer_starts_at AS DATE) AS start_date,
              CAST(offer_ends_at AS DATE) AS end_date, coalesce(k.brand_id, p.brand_id) AS brand_id
              FROM shop_campaigns k LEFT JOIN (SELECT DISTINCT cp.campaign_id, q.brand_id FROM shop_campaigns_products cp
                   JOIN shop_products q ON q.id = cp.product_id WHERE q.brand_id IS NOT NULL) p ON p.campaign_id = k.id) c
        LEFT JOIN shop_brands b ON b.id = c.brand_id""",
    "reference_rows": """SELECT treated, slug, trim(brand) AS brand, trim(brand_kind) AS brand_kind,
        trim(campaign_kind) AS campaign_kind, trim(gender) AS gender FROM (SELECT *, trim(treated_slug) AS treated,
        row_number() OVER (PARTITION BY trim(treated_slug), trim(slug) ORDER BY row_no DESC) AS rn
        FROM shop_campaign_reference) WHERE rn = 1""",
    "catalogue_all": f"""SELECT c.campaign_id, {slug('c.brand_name')} AS slug_products, c.campaign_name, c.treated_slug,
        c.start_date, c.start_date - 1 AS start_day0, c.end_date, c.label, {MON_LABEL.format('c.start_date')} AS month_label,
        {mon('c.start_date')} AS month_sort,
        regexp_replace(concat_ws(' - ', c.campaign_name, {MON_LABEL.format('c.start_date')}), '{TITLE}', '', 'g') AS title,
        r.brand AS reference_brand, r.brand_kind, r.campaign_kind, r.gender,
        regexp_replace(r.brand, '{TITLE}', '', 'g') AS brand_folder
        FROM j_campaign_brand c LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY treated ORDER BY trim(slug)) AS n
            FROM j_reference_rows) r ON r.treated = c.treated_slug AND r.n = 1
        WHERE c.start_date >= DATE '1995-01-01'""",
    "campaign_catalogue": """SELECT * FROM j_catalogue_all WHERE reference_brand IS DISTINCT FROM 'NA'
        AND brand_kind IS DISTINCT FROM 'NA'""",
    "campaign_export_flag": f"""SELECT c.*, CASE WHEN {slug('label')} NOT IN (SELECT {slug('label')} FROM shop_skip_list)
        AND end_date <= (SELECT CAST(max(created_at) AS DATE) - 1 FROM shop_orders)
        AND coalesce(campaign_kind, '') NOT IN ('especial', 'super sale', 'conceito') THEN 1 ELSE 0 END AS export_flag
        FROM j_catalogue_all c""",
    "campaigns_without_reference": """SELECT campaign_id, treated_slug, end_date, brand_id,
        CASE WHEN brand_name IS NULL THEN 'vazio' ELSE 'single brand' END AS campaign_kind FROM j_campaign_brand c
        WHERE NOT EXISTS (SELECT 1 FROM j_reference_rows r WHERE r.treated = c.treated_slug
              AND trim(r.slug) = c.campaign_slug)
        AND end_date <= (SELECT CAST(max(created_at) AS DATE) - 1 FROM shop_orders)""",
    "campaign_products": f"""SELECT s.campaign_id, s.product_id, s.stock, d.slug_products, trim(erp_code) AS product_code,
        CASE WHEN erp_code IS NULL THEN d.slug_products ELSE d.slug_products || '_' || trim(erp_code) END AS product_uid,
        parent_product_id AS parent_code, {CAPITALIZED.format('subcategory')} AS product_group,
        trim(supplier_color) AS color, upper(supplier_size) AS size, product_original_price AS list_price,
        product_final_price AS final_price, trim(concat_ws(' ', category, segment)) AS product_kind,
        trim(gender) AS product_gender, trim(regexp_replace(trim(name), ' - .{{1,2}}$', '')) AS name_treated
        FROM (SELECT campaign_id, product_id, sum(stock) AS stock FROM shop_campaigns_products GROUP BY ALL) s
        JOIN (SELECT *, {slug('brand_name')} AS slug_products FROM j_products_dimension) d ON d.product_key = s.product_id
        WHERE d.slug_products IN (SELECT slug_products FROM j_campaign_catalogue WHERE slug_products IS NOT NULL)""",
    "size_order": """SELECT size, row_number() OVER (ORDER BY row_no NULLS LAST, size) AS size_sort FROM (
        SELECT coalesce(l.size, p.size) AS size, l.row_no FROM (SELECT upper(size) AS size, min(row_no) AS row_no
        FROM shop_size_list GROUP BY 1) l FULL JOIN (SELECT DISTINCT size FROM j_campaign_products) p ON p.size = l.size)""",
    "campaign_kind_gender": """SELECT c.campaign_id, c.slug_products, c.treated_slug,
        CASE WHEN date_trunc('month', c.start_date) < DATE '1998-06-01' THEN c.brand_kind ELSE p.product_kind END AS kind,
        CASE WHEN date_trunc('month', c.start_date) < DATE '1998-06-01' THEN c.gender ELSE p.product_gender END AS gender
        FROM j_campaign_catalogue c JOIN (SELECT *, row_number() OVER (PARTITION BY slug_products
            ORDER BY product_id, campaign_id) AS rn FROM j_campaign_products) p
        ON p.slug_products = c.slug_products AND p.rn = 1""",
    "band_base": """SELECT k.treated_slug, CAST(p.final_price AS DOUBLE) AS price, p.final_price, p.stock FROM (
        SELECT treated_slug, slug_products, row_number() OVER (PARTITION BY treated_slug
            ORDER BY campaign_id DESC, slug_products DESC NULLS LAST) AS rn FROM j_campaign_catalogue) k
        JOIN j_campaign_products p ON p.slug_products = k.slug_products AND k.rn = 1""",
    "band_mean": """SELECT treated_slug, round(CAST(sum(final_price * stock) AS DOUBLE) / CAST(sum(stock) AS DOUBLE)) AS mean
        FROM j_band_base GROUP BY 1""",
    "band_low": """SELECT treated_slug, round(CAST(sum(final_price * stock) AS DOUBLE) / CAST(sum(stock) AS DOUBLE)) AS low
        FROM j_band_base JOIN j_band_mean USING (treated_slug) WHERE price < mean GROUP BY 1""",
    "band_high": """SELECT treated_slug, round(CAST(sum(final_price * stock) AS DOUBLE) / CAST(sum(stock) AS DOUBLE)) AS high
        FROM j_band_base JOIN j_band_mean USING (treated_slug) WHERE price > mean GROUP BY 1""",
    "price_bands": f"""SELECT treated_slug, final_price, mean, low, high,
        CASE WHEN low IS NULL AND high IS NULL THEN 'R$' || CAST(CAST(final_price AS DECIMAL(18,2)) AS VARCHAR)
             WHEN low IS NULL THEN CASE WHEN price < mean THEN 'Abaixo de R$' || {under('mean')}
                  WHEN price < high THEN 'R$' || {label('mean')} || '-' || {under('high')} ELSE 'R$' || {label('high')} || '+' END
             WHEN high IS NULL THEN CASE WHEN price < low THEN 'Abaixo de R$' || {under('low')}
                  WHEN price < mean THEN 'R$' || {label('low')} || '-' || {under('mean')} ELSE 'R$' || {label('mean')} || '+' END
             WHEN price < low THEN 'Abaixo de R$' || {under('low')}
             WHEN price < mean THEN 'R$' || {label('low')} || '-' || {under('mean')}
             WHEN price < high THEN 'R$' || {label('mean')} || '-' || {under('high')} ELSE 'R$' || {label('high')} || '+' END AS band
        FROM (SELECT DISTINCT c.treated_slug, p.final_price, CAST(p.final_price AS DOUBLE) AS price
              FROM j_campaign_products p JOIN j_campaign_catalogue c USING (slug_products))
        LEFT JOIN j_band_mean USING (treated_slug) LEFT JOIN j_band_low USING (treated_slug)
        LEFT JOIN j_band_high USING (treated_slug)""",
    "product_prices": """SELECT product_code, slug_products, final_price, list_price FROM (SELECT *, row_number() OVER (
        PARTITION BY product_code, slug_products ORDER BY product_id) AS rn FROM j_campaign_products
        WHERE product_code IS NOT NULL) WHERE rn = 1""",
    "campaign_items": """SELECT i.item_id, i.order_id, c.campaign_id, c.slug_products, i.variant_code AS product_code,
        CAST(o.created_at AS DATE) AS order_date, i.quantity, p.final_price AS unit_value, p.list_price AS unit_list_value,
        p.final_price * i.quantity AS total
        FROM j_admin_items i JOIN j_order_inclusion o ON o.order_id = i.order_id AND o.include_state = 'Sim'
        JOIN j_product_prices p ON p.product_code = i.variant_code
        JOIN (SELECT DISTINCT campaign_id, slug_products, start_day0, end_date FROM j_campaign_catalogue) c
        ON c.slug_products = p.slug_products AND CAST(o.created_at AS DATE) BETWEEN c.start_day0 AND c.end_date""",
    "campaign_day": """SELECT i.item_id, i.campaign_id, i.order_date - (SELECT min(start_day0) FROM j_campaign_catalogue c
        WHERE c.campaign_id = i.campaign_id) AS campaign_day FROM j_campaign_items i""",
    "campaign_products_classified": """SELECT p.*, z.size_sort, k.treated_slug, b.band FROM j_campaign_products p
        LEFT JOIN j_size_order z ON z.size = p.size
        LEFT JOIN (SELECT DISTINCT slug_products, treated_slug FROM j_campaign_catalogue) k ON k.slug_products = p.slug_products
        LEFT JOIN j_price_bands b ON b.treated_slug = k.treated_slug AND b.final_price = p.final_price""",
    "campaign_orders": "SELECT *, hour(created_at) AS order_hour FROM j_order_inclusion WHERE order_id IN (SELECT order_id FROM j_campaign_items)",
    # ---- margin
    "order_attribution": """SELECT b.*, coalesce(w.source, utm_source) AS order_source,
        coalesce(w.medium, utm_medium) AS order_medium, coalesce(w.campaign, utm_campaign) AS order_campaign,
        w.revenue AS web_revenue FROM j_orders_base b LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY public_id, date
            ORDER BY source NULLS FIRST, medium NULLS FIRST, campaign NULLS FIRST, revenue) AS rn FROM shop_web_transactions) w
        ON w.public_id = b.public_id AND w.date = b.order_date AND w.rn = 1""",
    "channel_counts": """SELECT source, medium, campaign, 'main' AS unit, count(k) AS registrations FROM (
        SELECT utm_source AS source, utm_medium AS medium, utm_campaign AS campaign, CAST(order_id AS VARCHAR) AS k
            FROM j_orders_admin
        UNION ALL SELECT source, medium, campaign, public_id FROM shop_web_transactions WHERE public_id <> 'transactionId'
        UNION ALL SELECT customer_source, customer_medium, customer_campaign, CAST(customer_id AS VARCHAR)
            FROM j_customer_source) GROUP BY 1, 2, 3""",
    "channel_rules": f"""SELECT source, medium, campaign, unit, level1, level2, level3, rule_no FROM (
        SELECT c.*, coalesce(r.level1, '') AS level1, coalesce(r.level2, '') AS level2, coalesce(r.level3, '') AS level3,
        r.rule_no, row_number() OVER (PARTITION BY c.source, c.medium, c.campaign, c.unit ORDER BY r.rule_no) AS rn
        FROM j_channel_counts c JOIN shop_rules r ON c.source IS NOT NULL AND c.medium IS NOT NULL
        AND c.campaign IS NOT NULL AND {RULE_HIT}) WHERE rn = 1""",
    "untreated_channels": """SELECT c.source, c.medium, c.campaign, c.registrations FROM j_channel_counts c
        WHERE NOT EXISTS (SELECT 1 FROM j_channel_rules r WHERE r.source = c.source AND r.medium = c.medium
        AND r.campaign = c.campaign AND r.unit = c.unit)""",
    "channel_orders": channel_applied("j_order_attribution", "order", "order_id"),
    "channel_customers": channel_applied("j_customer_source", "customer", "customer_id"),
    "shipping_adjust": """SELECT b.*, CAST(shipping_cost_shop * coalesce(f.factor, 1) AS DECIMAL(18,4)) AS shipping_cost
        FROM j_orders_base b LEFT JOIN shop_shipping_factors f USING (month, unit)""",
    "item_cost": """SELECT b.order_id, b.month, b.unit, i.item_id, i.variant_code, i.quantity, e.erp_product_id, s.unit_cost
        FROM j_orders_base b LEFT JOIN j_admin_items i ON i.order_id = b.order_id
        LEFT JOIN shop_erp_products e ON e.variant_code = i.variant_code
        LEFT JOIN shop_erp_stock s ON s.month = b.month AND s.unit = b.unit AND s.erp_product_id = e.erp_product_id""",
    "previous_month": "SELECT CAST(max(month) - INTERVAL 1 MONTH AS DATE) AS month FROM j_orders_base",
    "frozen_order_cost": """SELECT b.*, CAST(coalesce(h.product_cost, c.computed) AS DECIMAL(18,4)) AS product_cost
        FROM j_shipping_adjust b LEFT JOIN shop_cost_history h USING (order_id)
        LEFT JOIN (SELECT order_id, coalesce(sum(unit_cost * quantity), 0) AS computed FROM j_item_cost
            WHERE month >= (SELECT month FROM j_previous_month) GROUP BY order_id) c USING (order_id)""",
    "new_cost_history": """SELECT order_id, product_cost FROM shop_cost_history UNION ALL SELECT order_id, product_cost
        FROM j_frozen_order_cost WHERE month = (SELECT month FROM j_previous_month)
        AND order_id NOT IN (SELECT order_id FROM shop_cost_history)""",
    "taxes": """SELECT f.order_id, revenue * revenue_rate AS revenue_tax, product_cost * product_rate AS product_tax,
        shipping_cost * freight_rate AS freight_tax FROM j_frozen_order_cost f LEFT JOIN shop_tax_rates r USING (month, unit)""",
    "base_by_method": """SELECT * EXCLUDE (payment_form), CASE payment_method WHEN 'boleto' THEN 'Boleto'
        WHEN 'debit' THEN 'Débito Online' ELSE 'Cartão de Crédito' END AS payment_form FROM j_orders_base""",
    "payment_fee": "SELECT b.order_id, b.payment_form, b.installments, coalesce(CASE payment_form WHEN 'Boleto' THEN boleto "
        "WHEN 'Débito Online' THEN debit ELSE CASE installments "
        + " ".join(f"WHEN {i} THEN fee_{i}" for i in range(1, 13))
        + " END END, 0) AS payment_fee FROM j_base_by_method b LEFT JOIN shop_payment_fees f USING (month)",
    "fraud_and_gateway": """SELECT b.order_id, CASE WHEN payment_form = 'Cartão de Crédito' THEN coalesce(o.fee, m.fee) END
        AS fraud_fee, g.fee AS gateway_fee FROM j_base_by_method b LEFT JOIN shop_fraud_by_order o USING (public_id)
        LEFT JOIN shop_fraud_by_month m USING (month) LEFT JOIN shop_gateway_by_month g USING (month)""",
    "packaging_share": """SELECT b.order_id, CAST(p.cost AS DOUBLE) / count(*) OVER (PARTITION BY b.month) AS packaging
        FROM j_orders_base b LEFT JOIN shop_packaging_by_month p USING (month)""",
    "fulfilment_share": """SELECT order_id, CAST(coalesce(fs, 0) AS DOUBLE) * share AS fulfilment_staff,
        CAST(coalesce(fw, 0) AS DOUBLE) * share AS fulfilment_warehouse, CAST(coalesce(ps, 0) AS DOUBLE) * share AS production_staff,
        CAST(coalesce(pt, 0) AS DOUBLE) * share AS production_studios FROM (
        SELECT b.order_id, CAST(revenue AS DOUBLE) / nullif(CAST(sum(revenue) OVER (PARTITION BY b.month, b.unit) AS DOUBLE), 0) AS share,
        f.fs, f.fw, p.staff AS ps, p.studios AS pt FROM j_orders_base b LEFT JOIN (SELECT month, unit, sum(staff) AS fs,
        sum(warehouse) AS fw FROM shop_fulfilment_by_month GROUP BY month, unit) f USING (month, unit)
        LEFT JOIN shop_production_by_month p USING (month, unit))""",
    "order_margin": """SELECT *, CAST(revenue AS DOUBLE) - order_cost AS margin FROM (
        SELECT b.order_id, b.month, b.unit, b.payment_form, b.revenue, f.product_cost, t.* EXCLUDE (order_id), p.payment_fee,
            g.* EXCLUDE (order_id), k.packaging, u.* EXCLUDE (order_id), r.freight, c.* EXCLUDE (order_id),
            coalesce(CAST(f.product_cost AS DOUBLE), 0)
            + coalesce(CAST(t.revenue_tax AS DOUBLE), 0)
            + coalesce(CAST(t.product_tax AS DOUBLE), 0)
            + coalesce(CAST(t.freight_tax AS DOUBLE), 0)
            + coalesce(CAST(p.payment_fee AS DOUBLE), 0)
            + coalesce(CAST(g.fraud_fee AS DOUBLE), 0)
            + coalesce(CAST(g.gateway_fee AS DOUBLE), 0)
            + coalesce(CAST(k.packaging AS DOUBLE), 0)
            + coalesce(CAST(u.fulfilment_staff AS DOUBLE), 0)
            + coalesce(CAST(u.fulfilment_warehouse AS DOUBLE), 0)
            + coalesce(CAST(u.production_staff AS DOUBLE), 0)
            + coalesce(CAST(u.production_studios AS DOUBLE), 0)
            + coalesce(CAST(r.freight AS DOUBLE), 0) AS order_cost
        FROM j_base_by_method b JOIN j_frozen_order_cost f USING (order_id) JOIN j_taxes t USING (order_id)
        JOIN j_payment_fee p USING (order_id) JOIN j_fraud_and_gateway g USING (order_id) JOIN j_packaging_share k USING (order_id)
        JOIN j_fulfilment_share u USING (order_id) JOIN j_real_freight r USING (order_id)
        JOIN j_contribution_margin c USING (order_id))""",
    "real_freight": """SELECT b.order_id, n.erp_order_id, n.invoice_id, n.invoice_number, b.shipping_cost,
        coalesce(c.freight, b.shipping_cost) AS freight FROM j_shipping_adjust b
        LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY public_id, unit ORDER BY invoice_id) AS rn
            FROM shop_erp_invoices) n ON n.public_id = b.public_id AND n.unit = b.unit AND n.rn = 1
        LEFT JOIN (SELECT CASE WHEN series = 1 THEN 'second' ELSE 'main' END AS unit,
            replace(invoice_number, ',00', '') AS invoice_number, min(freight) AS freight FROM shop_carrier GROUP BY 1, 2) c
        ON c.unit = b.unit AND c.invoice_number = n.invoice_number""",
    "invoices": """SELECT order_number AS erp_order_id, substr(order_number, 3) AS order_id,
        CAST(invoice_value AS DECIMAL(18,4)) AS total_value, CAST(goods_value AS DECIMAL(18,4)) AS basket_value,
        CAST(freight_value AS DECIMAL(18,4)) AS shipping_value, strptime(issued_on, '%d/%m/%Y') AS invoice_date,
        invoice_number, CASE WHEN left(tax_id, 3) <> '000' THEN 'erro no cpf'
            ELSE CAST(CAST(substr(tax_id, 4) AS BIGINT) AS VARCHAR) END AS tax_id, email AS erp_email
        FROM shop_invoice_lines WHERE order_number NOT LIKE '%DI%'""",
    # ---- service
    "plain_totals": f"SELECT order_id, {ITEM_SUMS} FROM j_order_items_plain GROUP BY order_id",
    "delivery_dates": f"""SELECT *, CASE delivery_status WHEN 'delivered' THEN actual_date WHEN 'no delivery data'
            THEN CASE WHEN shipping_date IS NOT NULL THEN estimated_date ELSE communicated_date END END AS best_date
        FROM (SELECT o.id AS order_id, {loc('o.created_at')} AS order_date, o.state, external_id AS erp_id, s.shipping_date,
        {loc('o.created_at')} + total_shipping_time AS communicated_date, {loc('delivered_at')} AS actual_date,
        CASE WHEN delivered_at IS NULL AND o.state = 'shipping_successful' THEN 'no delivery data'
             WHEN delivered_at IS NULL THEN 'not delivered' ELSE 'delivered' END AS delivery_status,
        CASE WHEN o.state IN ('shipping_successful', 'delivered') THEN s.shipping_date + shipping_period END AS estimated_date,
        x.original_order_value, x.final_quantity, x.final_order_value, CASE WHEN x.order_id IS NOT NULL THEN 1 END AS order_count
        FROM shop_orders o LEFT JOIN (SELECT order_id, min({loc('created_at')}) AS shipping_date FROM shop_transition_logs
            WHERE to_state = 'shipping_successful' GROUP BY order_id) s ON s.order_id = o.id
        LEFT JOIN j_plain_totals x ON x.order_id = o.id WHERE o.state IS NULL OR o.state NOT IN {FAILED})""",
    "risk_rules": " UNION ALL ".join(
        f"""SELECT r.order_id, 'Rule {n}' AS rule, '{title}' AS rule_name, CASE WHEN r.{column} = 0 THEN 'Clearsale'
        ELSE 'Whitelist' END AS rule_applies, CASE WHEN f.user_id IS NOT NULL THEN 'yes' ELSE 'no' END AS ftp,
        {loc('o.created_at')} AS order_date, {ym(loc('o.created_at'))} AS order_cohort, o.external_id
        FROM shop_risk_results r LEFT JOIN shop_orders o ON o.id = r.order_id
        LEFT JOIN j_first_time_buyers f ON f.first_order_id = r.order_id WHERE r.{column} IS NOT NULL"""
        for n, title, column in [
            (1, "Successful past order rule", "successful_past_order_rule"),
            (2, "Maximum order value rule", "maximum_order_value_rule"),
            (3, "Maximum of purchase in period rule", "maximum_of_purchase_on_period_rule"),
        ]),
    "risk_final_list": """SELECT DISTINCT order_id, CASE WHEN order_id IN (SELECT order_id FROM j_risk_rules
        WHERE rule_applies = 'Clearsale') THEN 'Clearsale' ELSE 'Whitelist' END AS final_list, 1 AS risk_analysis_data
        FROM j_risk_rules""",
    "nps_groups": f"""SELECT response_id, email, CAST(answered_at AS DATE) AS answer_date, {mon('answered_at')} AS answer_month,
        score, CASE WHEN score >= 9 THEN 'Promoters' WHEN score < 7 THEN 'Detractors' ELSE 'Passives' END AS nps_group,
        customer_id, CASE WHEN {MAIL_AS_OF} - CAST(answered_at AS DATE) <= 30 THEN 1 ELSE 0 END AS last_30_days
        FROM shop_survey WHERE score IN (0,1,2,3,4,5,6,7,8,9,10) AND answered_at > TIMESTAMP '2015-01-31 00:00:00'""",
    "credits": f"""SELECT id AS credit_id, {loc('used_at')} AS date_used, {mon(loc('used_at'))} AS month_used,
        5 AS credit_value, credit_type, invited_id, order_id, CAST(cancelled_at AS DATE) AS cancelled_on, origin_id
        FROM shop_credits WHERE used_at IS NOT NULL""",
    "orders_with_coupon": f"""SELECT o.id AS order_id, user_id, {loc('o.created_at')} AS order_date,
        {mon(loc('o.created_at'))} AS order_month, coalesce(m.consider, 'error') AS consider, o.coupon_id, c.code, c.value,
        CAST(c.value * 0.01 AS DECIMAL(18,6)) AS coupon_percent,
        cached_total_value * CAST(c.value * 0.01 AS DECIMAL(18,6)) AS coupon_value
        FROM shop_orders o LEFT JOIN shop_state_map m ON m.state = o.state LEFT JOIN shop_coupons c ON c.id = o.coupon_id""",
    "sales_metrics": """SELECT campaign_id, sum(quantity) AS gross_quantity,
        sum(quantity - cancelled_quantity - stockout_quantity) AS liquid_quantity,
        sum((quantity - cancelled_quantity - stockout_quantity) * final_price) AS basket_value,
        sum((quantity - cancelled_quantity - stockout_quantity) * final_price + shipping_price) AS sales_value,
        min(CAST(final_price AS DOUBLE) / CAST(original_price AS DOUBLE) - 1) AS deepest_discount,
        sum((quantity - cancelled_quantity - stockout_quantity) * final_price) AS total_value
        FROM shop_items GROUP BY campaign_id""",
    # ---- lifecycle
    "ltv_cohorts": f"""SELECT month, users, row_number() OVER (ORDER BY month) - 1 AS row FROM (SELECT
        {mon('first_order_date')} AS month, count(DISTINCT customer_id) AS users FROM j_customer_milestones
        WHERE first_order_date IS NOT NULL GROUP BY 1)""",
    "ltv_base": """SELECT distance, revenue, users, CAST(revenue AS DOUBLE) / CAST(users AS DOUBLE) AS ltv FROM (
        SELECT v.distance, v.revenue, (SELECT sum(c.users) FROM j_ltv_cohorts c
            WHERE c.row <= (SELECT max(months_ftp) FROM j_months_since_first) - v.distance) AS users
        FROM (SELECT months_ftp AS distance, sum(revenue) AS revenue FROM j_months_since_first
              WHERE months_ftp IS NOT NULL GROUP BY 1) v)""",
    "ltv_curve": """SELECT a.*, b.ltv AS ltv_previous, a.ltv / nullif(b.ltv, 0) AS ltv_ratio
        FROM j_ltv_base a LEFT JOIN j_ltv_base b ON b.distance = a.distance - 1""",
    "ltv_summary": """SELECT coalesce(sum(CASE WHEN distance = 1 THEN ltv_ratio END), 0) AS first_ratio,
        avg(CASE WHEN distance > 1 AND distance <= 12 THEN ltv_ratio END) AS mean_ratio FROM j_ltv_curve""",
    "contribution_margin": """SELECT order_id, revenue * margin_with AS margin_with_fulfilment,
        revenue * margin_without AS margin_without_fulfilment FROM j_orders_base LEFT JOIN shop_margin_by_month USING (month, unit)""",
    "mail_visits": """SELECT source, CASE WHEN regexp_matches(source, '^[0-9]{8}') THEN CAST(strptime(left(source, 8), '%Y%m%d') AS DATE)
        ELSE date END AS day, sum(visits) AS visits FROM shop_visits GROUP BY 1, 2""",
    "mail_sales": """SELECT source, CASE WHEN regexp_matches(source, '^[0-9]{8}') THEN CAST(strptime(left(source, 8), '%Y%m%d') AS DATE)
        ELSE date END AS day, count(DISTINCT transaction_id) AS transactions, sum(revenue) AS revenue
        FROM shop_mail_transactions GROUP BY 1, 2""",
    "email_send_summary": f"""SELECT s.*, 'main' AS unit, v.visits, coalesce(t.transactions, 0) AS transactions, t.revenue,
        {mon('s.email_date')} AS email_month, year(s.email_date) AS email_year FROM (
        SELECT email_name, CASE WHEN regexp_matches(email_name, '^[0-9]{{8}}') THEN CAST(strptime(left(email_name, 8), '%Y%m%d') AS DATE)
            ELSE CAST(send_started AS DATE) END AS email_date,
        CASE WHEN regexp_matches(email_name, '^[0-9]{{8}}') THEN substr(email_name, 10) ELSE 'Other' END AS email_type,
        sum(sends) AS sends, sum(deliveries) AS deliveries, sum(opens) AS opens, sum(clicks) AS clicks,
        sum(unsubscribes) AS unsubscribes FROM shop_sends GROUP BY 1, 2, 3) s
        LEFT JOIN j_mail_visits v ON v.source = s.email_name AND v.day = s.email_date
        LEFT JOIN j_mail_sales t ON t.source = s.email_name AND t.day = s.email_date""",
    "email_engagement": f"""SELECT c.*, o.last_open, least({MAIL_AS_OF} - o.last_open, 60) + 0 * ({MAIL_AS_OF} - o.last_open) AS open_age,
        CASE WHEN {MAIL_AS_OF} - o.last_open <= 15 THEN '0 - 15 dias' WHEN {MAIL_AS_OF} - o.last_open <= 30 THEN '15 - 30 dias'
             WHEN {MAIL_AS_OF} - o.last_open <= 45 THEN '30 - 45 dias' WHEN o.last_open IS NOT NULL THEN '45 - 60 dias' END AS open_band,
        CASE WHEN o.email IS NULL THEN 'Não' ELSE 'Sim' END AS opened,
        CASE WHEN c.email IN (SELECT email FROM shop_unsubscribes) THEN 'Sim' ELSE 'Não' END AS unsubscribed
        FROM j_customer_milestones c LEFT JOIN (SELECT email, max(opened_on) AS last_open FROM shop_opens GROUP BY email) o
        USING (email)""",
    "spend_long": " UNION ALL ".join(
        f"""SELECT DATE '2001-0{m}-01' AS month, s.name, s.m_2001_0{m} AS amount, p.m_2001_0{m} AS share
        FROM shop_spend_by_month s JOIN shop_spend_split p ON p.name = s.name""" for m in (5, 6, 7)),
    "marketing_spend": """SELECT l.month, l.name, a.purpose, a.payment, a.channel, a.unit,
        CAST(CASE WHEN a.unit = 'main' THEN l.amount * l.share ELSE l.amount * (1 - l.share) END * a.percent AS DECIMAL(18,4))
        AS value FROM j_spend_long l JOIN shop_spend_allocation a ON a.name = l.name
        WHERE CASE WHEN a.unit = 'main' THEN l.amount * l.share ELSE l.amount * (1 - l.share) END * a.percent > 0""",
    "acquisition_cost": """SELECT month, unit, coalesce(channel, 'n/a') AS channel, coalesce(sum(CASE WHEN purpose = 'Activation'
        OR purpose = 'Acquisition' THEN value END), 0) AS cost FROM j_marketing_spend GROUP BY 1, 2, 3""",
    "rfm_base": """SELECT customer_id, sum(revenue) AS revenue, count(order_id) AS frequency, max(order_date) AS recency
        FROM j_orders_base WHERE payment_confirmed = 1 GROUP BY 1""",
    "rfm_score": """SELECT *, CASE WHEN score >= 27 THEN 'Sim' ELSE 'Não' END AS is_vip FROM (
        SELECT *, (6 - r_class) + 2 * (6 - f_class) + 3 * (6 - m_class) AS score FROM (SELECT *,
        ceil(row_number() OVER (ORDER BY recency DESC, revenue DESC, frequency DESC, customer_id) * 5.0 / count(*) OVER ()) AS r_class,
        ceil(row_number() OVER (ORDER BY frequency DESC, revenue DESC, recency DESC, customer_id) * 5.0 / count(*) OVER ()) AS f_class,
        ceil(row_number() OVER (ORDER BY revenue DESC, frequency DESC, recency DESC, customer_id) * 5.0 / count(*) OVER ()) AS m_class
        FROM j_rfm_base))""",
    "optin_active": f"""SELECT c.*, CASE WHEN opt_in = 'Sim' AND unsubscribed <> 'Sim' THEN 1 ELSE 0 END AS is_opt_in,
        CASE WHEN last_open IS NOT NULL OR {AS_OF} - register_date <= 30 THEN 1 ELSE 0 END AS is_active,
        coalesce(p.n, 0) AS paid_orders, p.d AS first_paid_order_date FROM j_email_engagement c
        LEFT JOIN (SELECT customer_id, count(DISTINCT order_id) AS n, min(order_date) AS d FROM j_orders_base
            WHERE payment_confirmed = 1 GROUP BY 1) p USING (customer_id)""",
    "days_since_previous_order": """SELECT o.*, o.order_date - coalesce(lag(o.order_date) OVER (PARTITION BY o.customer_id
        ORDER BY o.cardinal), m.register_date) AS days_since_previous
        FROM j_order_cardinal o LEFT JOIN j_customer_milestones m USING (customer_id)""",
    "scored": """SELECT c.*, s.revenue, s.frequency, s.recency, s.r_class, s.f_class, s.m_class, s.score, s.is_vip
        FROM j_optin_active c LEFT JOIN j_rfm_score s USING (customer_id)""",
    "client_segments": "SELECT unit, count(DISTINCT customer_id) AS total, " + ", ".join(
        f"count(DISTINCT CASE WHEN {c} THEN customer_id END) AS {n}" for n, c in [
            ("opt_in", "is_opt_in = 1"), ("opt_out", "is_opt_in <> 1"), ("buyers", "is_opt_in = 1 AND paid_orders >= 1"),
            *[(f"{n}{suffix}", f"is_opt_in = 1 AND {c}{extra}") for n, c in [
                ("never_bought", "paid_orders = 0"), ("ftb", "coalesce(is_vip, '') <> 'Sim' AND paid_orders = 1"),
                ("vip", "is_vip = 'Sim' AND paid_orders >= 1"),
                ("repeat", "coalesce(is_vip, '') <> 'Sim' AND paid_orders > 1"),
            ] for suffix, extra in [("", ""), ("_active", " AND is_active = 1"), ("_inactive", " AND is_active <> 1")]],
        ]) + " FROM j_scored GROUP BY unit",
    "churn_snapshot": f"""SELECT {AS_OF} AS churn_date, l.level1, l.level2, l.level3, c.unit,
        count(DISTINCT c.customer_id) AS customers, """ + ", ".join(
        f"count(DISTINCT CASE WHEN is_active {a} 1 AND is_opt_in {o} 1 THEN c.customer_id END) AS {n}" for n, a, o in [
            ("active_opt_in", "=", "="), ("active_opt_out", "=", "<>"), ("inactive_opt_in", "<>", "="),
            ("inactive_opt_out", "<>", "<>")]) + """ FROM j_optin_active c LEFT JOIN j_channel_customers l USING (customer_id)
        GROUP BY 1, 2, 3, 4, 5""",
    "rfm_export": """SELECT s.*  REPLACE (round(s.revenue, 2) AS revenue), l.level1, l.level2 FROM j_scored s
        LEFT JOIN j_channel_customers l USING (customer_id) WHERE paid_orders > 0""",
    "orders_cardinal_export": """SELECT o.* REPLACE (CASE WHEN o.payment_confirmed = 1 THEN 'Sim' ELSE 'Não' END AS payment_confirmed),
        c.email, c.register_date, a.order_source, a.order_medium, a.order_campaign FROM j_days_since_previous_order o
        LEFT JOIN j_customer_milestones c USING (customer_id) LEFT JOIN j_order_attribution a USING (order_id)""",
}


def export_sql(source: str, headers: dict[str, str]) -> str:
    fields = [
        f"""strftime(created_at, '%Y-%m-%d %H:%M:%S') AS "{h}\"""" if c == "created_at" else f'{c} AS "{h}"'
        for c, h in headers.items()
    ]
    return f"SELECT {', '.join(fields)} FROM {source}"


JOBS |= {
    "named_items": """SELECT i.*, c.name AS campaign_name FROM j_admin_items i
        LEFT JOIN shop_campaigns c ON c.id = i.campaign_id""",
    "dated_customers": """SELECT c.*, u.created_at FROM j_customers_admin c JOIN shop_users u ON u.id = c.customer_id""",
    "landed_orders": """SELECT *, CAST(created_at AS DATE) AS created_on FROM shop_orders
        WHERE state IN ('delivered', 'captured')""",
    "invoices_from_files": "SELECT * FROM j_invoices",
    "web_events_from_files": "SELECT *, event_id AS unique_events FROM shop_web_events",
    "conversion_snapshot_stored": f"""SELECT unit, day, rate_1_30, rate_91_120, dif, revenue FROM shop_conversion_history
        WHERE day <> {AS_OF} UNION ALL SELECT unit, day, rate_1_30, rate_91_120, dif, revenue FROM j_conversion_snapshot""",
    "churn_snapshot_stored": f"""SELECT * FROM j_churn_snapshot UNION ALL
        SELECT * REPLACE ({AS_OF} - 1 AS churn_date) FROM j_churn_snapshot""",
    "export_orders": export_sql("j_orders_admin", EXPORTS["export_orders"]),
    "export_items": export_sql("j_named_items", EXPORTS["export_items"]),
    "export_users": export_sql("j_dated_customers", EXPORTS["export_users"]),
}


def statement(body: str) -> str:
    """`body` with every table it needs, directly or not, as common table expressions."""
    known = {**duck_texts(), **{f"j_{n}": t for n, t in JOBS.items()}}
    ordered: dict[str, str] = {}

    def need(text: str) -> None:
        for name in dict.fromkeys(re.findall(r"\b(?:shop|j)_\w+", text)):
            if name in known and name not in ordered:
                need(known[name])
                ordered[name] = known[name]

    need(body)
    return "WITH " + ",\n".join(f"{n} AS ({t})" for n, t in ordered.items()) + f"\n{body}"


def oracle(name: str) -> str:
    return statement(shown_sql(name, f"j_{name}"))
