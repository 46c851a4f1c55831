"""Shop tables derived from the given test tables.

Each shop table is one SELECT over a given table. The text is written in the part of SQL that both
Spark and DuckDB read; the few differences (timestamps, integer division) go through a dialect
object. So the jobs and the oracle see the same inputs, and every row comes from the given tables.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

from basketry.session import use_settings

GIVEN = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "labels",
]


class SparkText:
    string = "STRING"

    def ts(self, x):
        return f"CAST({x} AS TIMESTAMP)"

    def plus_hours(self, ts, n):
        return f"timestampadd(HOUR, CAST({n} AS INT), {ts})"

    def div(self, a, b):
        return f"(({a}) DIV ({b}))"

    def json_k(self, x):
        return f"CAST(get_json_object({x}, '$.k') AS INT)"

    def local_day(self, ts):
        return f"to_date(from_utc_timestamp({ts}, 'America/Sao_Paulo'))"

    def given(self, name):
        return f"given_{name}"

    def units(self, source):
        """Each row once per business unit of the sheets, from one scan."""
        return f"(SELECT *, explode(array('main', 'second')) AS unit FROM {source}) AS by_unit"

    def rows(self, names, rows, source):
        """Several output rows per source row, from one scan."""
        structs = ", ".join(
            "named_struct(" + ", ".join(f"'{n}', {x}" for n, x in zip(names, row)) + ")" for row in rows
        )
        return f"SELECT inline(array({structs})) FROM {source}"


class DuckText(SparkText):
    def plus_hours(self, ts, n):
        return f"({ts} + to_hours(CAST({n} AS BIGINT)))"

    def div(self, a, b):
        return f"(({a}) // ({b}))"

    def json_k(self, x):
        return f"CAST(regexp_extract({x}, '[0-9]+') AS INT)"

    def local_day(self, ts):
        return f"CAST(({ts} AT TIME ZONE 'UTC') AT TIME ZONE 'America/Sao_Paulo' AS DATE)"

    def given(self, name):
        return name

    def units(self, source):
        return f"(SELECT *, unnest(['main', 'second']) AS unit FROM {source}) AS by_unit"

    def rows(self, names, rows, source):
        structs = ", ".join("{" + ", ".join(f"'{n}': {x}" for n, x in zip(names, row)) + "}" for row in rows)
        return f"SELECT unnest([{structs}], recursive := true) FROM {source}"


def shop_tables(d: SparkText) -> dict[str, str]:
    """Name -> SELECT text in the dialect `d`."""
    T0 = d.ts("'1995-01-01 01:30:00'")
    money = lambda x: f"CAST({x} AS DECIMAL(18,4))"
    rate = lambda x: f"CAST({x} AS DECIMAL(18,6))"
    s = lambda x: f"CAST({x} AS STRING)"
    cents = lambda x: f"CAST(CAST(floor({x} * 100 + 0.5) AS BIGINT) AS STRING)"
    k = "o_orderkey"
    created = d.plus_hours(d.ts("o_orderdate"), f"{k} % 24")
    state = f"""CASE WHEN {k} % 97 = 0 THEN NULL
        WHEN o_orderstatus = 'F' THEN CASE {k} % 4 WHEN 0 THEN 'cancelled_stockout' WHEN 1 THEN 'shipping_successful'
             ELSE 'delivered' END
        WHEN o_orderstatus = 'O' THEN CASE {k} % 3 WHEN 0 THEN 'captured' WHEN 1 THEN 'shipping_successful'
             ELSE 'pending' END
        ELSE CASE {k} % 7 WHEN 0 THEN 'auth_failed' WHEN 1 THEN 'cancelled' WHEN 2 THEN 'capture_problems'
             WHEN 3 THEN 'fraud' WHEN 4 THEN 'risk_analysis_expired' WHEN 5 THEN 'risk_analysis_problems'
             ELSE 'on_hold' END END"""
    month = "CAST(date_trunc('MONTH', o_orderdate) AS DATE)"
    m = f"(year(month) * 12 + month(month))"
    months = f"(SELECT DISTINCT {month} AS month FROM {d.given('orders')}) AS calendar"
    month_units = d.units(months)
    # Months that a sheet lacks keep their rows, under a month that no order has.
    without = lambda missing: f"CASE WHEN month(month) {missing} THEN CAST('1900-01-01' AS DATE) ELSE month END AS month"
    item_id = (
        f"concat({s('l_orderkey')}, '-', {s('l_linenumber')}, '-', {s('l_partkey')}, '-', {s('l_suppkey')}, '-', "
        f"{cents('l_extendedprice')})"
    )
    event = "event_id"
    tables = {
        "shop_orders": f"""SELECT {k} AS id, o_custkey AS user_id, concat('M', {s(k)}) AS masked_id,
            concat('E', {s(k)}) AS external_id, {state} AS state, {s(f'{k} % 9')} AS status,
            {s(f'{k} % 5')} AS payment_status,
            CASE WHEN {k} % 10 < 7 THEN 'credit_card' WHEN {k} % 10 < 9 THEN 'boleto' ELSE 'debit' END AS payment_method,
            CASE {k} % 3 WHEN 0 THEN 'visa' WHEN 1 THEN 'master' ELSE 'amex' END AS credit_card_operator,
            CAST(1 + {k} % 13 AS INT) AS installments, CAST(substr(o_orderpriority, 1, 1) AS INT) AS origin,
            CASE WHEN {k} % 11 = 0 THEN NULL ELSE {k} % 250 END AS utm_id,
            CASE WHEN {k} % 3 = 0 THEN {k} % 30 END AS coupon_id,
            {created} AS created_at, {d.plus_hours(created, '72')} AS updated_at,
            CASE WHEN o_orderstatus = 'F' AND {k} % 4 > 1 AND {k} % 5 <> 0
                 THEN {d.plus_hours(created, f'24 * (5 + {k} % 10)')} END AS delivered_at,
            CASE WHEN {k} % 13 = 0 THEN NULL ELSE {money(f'{k} % 30 + 0.5')} END AS shipping_price,
            CASE WHEN o_orderstatus = 'F' THEN {money(f'{k} % 30 + 0.5')} END AS captured_shipping_price,
            CASE WHEN {k} % 101 = 0 THEN NULL ELSE {money('o_totalprice')} END AS cached_total_value,
            {money('o_totalprice')} AS cached_final_value,
            {money(f'CASE WHEN {k} % 17 = 0 THEN 5 ELSE 0 END')} AS cached_credits,
            CAST(3 + {k} % 8 AS INT) AS shipping_period, CAST(5 + {k} % 9 AS INT) AS total_shipping_time
            FROM {d.given('orders')}""",
        "shop_items": f"""SELECT {item_id} AS id, l_orderkey AS order_id, l_partkey - l_partkey % 10 AS product_id,
            l_partkey AS variant_id, l_suppkey AS campaign_id, concat('item ', {s('l_partkey')}) AS name,
            CAST(l_quantity AS INT) AS quantity,
            CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS cancelled_quantity,
            CASE WHEN l_linestatus = 'F' AND l_quantity > 30 THEN 2 ELSE 0 END AS stockout_quantity,
            CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(1 - l_discount AS DECIMAL(4,2)) AS DECIMAL(18,4))
                AS final_price,
            {money('l_extendedprice')} AS original_price, {money('l_linenumber + 0.25')} AS shipping_price,
            {money("CASE WHEN l_linestatus = 'F' THEN 1.5 ELSE 0 END")} AS stockout_shipping_price,
            {d.plus_hours(d.ts('l_shipdate'), 'l_linenumber')} AS created_at,
            {d.plus_hours(d.ts('l_shipdate'), '24 + l_linenumber')} AS updated_at
            FROM {d.given('lineitem')}""",
        "shop_campaigns": f"""SELECT s_suppkey AS id, concat('Brand#', {s('1 + s_suppkey % 25')}, ' Especial') AS name,
            concat('brand-', {s('1 + s_suppkey % 25')}, '-week--', {s('s_suppkey')}) AS slug,
            CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE 1 + s_suppkey % 25 END AS brand_id,
            CASE WHEN s_suppkey % 50 = 49 THEN NULL
                 ELSE {d.plus_hours(T0, '24 * ((s_suppkey * 37) % 2370)')} END AS offer_starts_at,
            {d.plus_hours(T0, '24 * ((s_suppkey * 37) % 2370 + 20 + s_suppkey % 40)')} AS offer_ends_at,
            CASE s_suppkey % 3 WHEN 0 THEN 'INTERNAL' WHEN 1 THEN 'CONSIGNED' END AS inventory_type,
            CASE WHEN s_suppkey % 4 < 3 THEN CAST(s_suppkey % 4 AS INT) END AS fast_delivery,
            concat('h', {s('s_suppkey')}) AS highlight, concat('b', {s('s_suppkey')}) AS banner,
            {T0} AS created_at
            FROM {d.given('supplier')}""",
        "shop_campaigns_products": f"""SELECT l_suppkey AS campaign_id, l_partkey AS product_id,
            CAST(l_quantity AS INT) AS stock FROM {d.given('lineitem')}""",
        "shop_products": f"""SELECT p_partkey AS id,
            CASE WHEN p_partkey % 10 IN (0, 9) THEN NULL ELSE p_partkey - p_partkey % 10 END AS parent_product_id,
            concat(p_name, CASE p_partkey % 3 WHEN 0 THEN ' - M' WHEN 1 THEN ' - GG' ELSE '' END) AS name,
            CASE WHEN p_partkey % 41 = 0 THEN NULL ELSE concat('P', {s('p_partkey')}) END AS erp_code,
            CASE WHEN p_partkey % 29 = 0 THEN NULL ELSE CAST(substr(p_brand, 7) AS BIGINT) END AS brand_id,
            CASE p_type WHEN 'ECONOMY' THEN 1 WHEN 'SMALL' THEN 2 WHEN 'MEDIUM' THEN 3 WHEN 'PROMO' THEN 4
                 WHEN 'STANDARD' THEN 5 ELSE 6 END AS main_category_id,
            100 + p_partkey % 4 AS age_id, 200 + p_size AS size_id, 300 + p_partkey % 3 AS vertical_id,
            400 + p_partkey % 3 AS gender_id, 500 + p_partkey % 8 AS subcategory_id, 600 + p_size % 5 AS category_id,
            CASE WHEN p_size < 9 THEN 'p' WHEN p_size < 17 THEN 'm' WHEN p_size < 25 THEN 'g' WHEN p_size < 33 THEN 'gg'
                 WHEN p_size < 41 THEN 'u' ELSE '38' END AS supplier_size,
            split_part(p_name, ' ', 1) AS supplier_color, {money('p_retailprice')} AS original_price,
            {money('300 + (p_partkey * 7) % 400')} AS final_price,
            CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE concat('img/', {s('p_partkey')}, '.jpg') END AS main_picture,
            {d.plus_hours(T0, '24 * (p_partkey % 2000)')} AS created_at,
            {d.plus_hours(T0, '24 * (p_partkey % 2000 + 10)')} AS updated_at
            FROM {d.given('part')}""",
        "shop_brands": f"""SELECT DISTINCT CAST(substr(p_brand, 7) AS BIGINT) AS id, p_brand AS name,
            concat('brand-', substr(p_brand, 7)) AS slug FROM {d.given('part')}""",
        "shop_tags": "SELECT DISTINCT CASE WHEN type <> 'size' OR id <= 245 THEN id ELSE -id END AS id, type, label FROM (" + d.rows(["id", "type", "label"], [
            ("100 + p_partkey % 4", "'age'", f"concat('Age ', {s('p_partkey % 4')})"),
            ("200 + p_size", "'size'", f"concat('Size ', {s('p_size')})"),
            ("300 + p_partkey % 3", "'vertical'", f"concat('Segment ', {s('p_partkey % 3')})"),
            ("400 + p_partkey % 3", "'gender'", "CASE p_partkey % 3 WHEN 0 THEN 'Feminino' WHEN 1 THEN 'Masculino' END"),
            ("500 + p_partkey % 7", "'subcategory'", f"concat('sub grupo ', {s('p_partkey % 7')})"),
            ("600 + p_size % 5", "'category'", f"concat('Category ', {s('p_size % 5')})"),
        ], d.given("part")) + ") AS t",
        "shop_categories": f"""SELECT DISTINCT CASE p_type WHEN 'ECONOMY' THEN 1 WHEN 'SMALL' THEN 2
            WHEN 'MEDIUM' THEN 3 WHEN 'PROMO' THEN 4 WHEN 'STANDARD' THEN 5 ELSE 6 END AS id, p_type AS name
            FROM {d.given('part')}""",
        "shop_users": f"""SELECT c_custkey AS id, concat('user', {s('c_custkey')}, '@mail.example') AS email,
            concat('First', {s('c_custkey % 100')}) AS first_name, concat('Last', {s('c_custkey % 77')}) AS last_name,
            CASE c_custkey % 3 WHEN 0 THEN 'm' WHEN 1 THEN 'f' END AS gender,
            CASE WHEN c_custkey % 23 = 0 THEN NULL WHEN c_custkey % 4 = 0 THEN 0 ELSE 1 END AS subscribed,
            CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_custkey % 300 END AS utm_id,
            CAST(1 + c_custkey % 6 AS INT) AS origin, c_custkey * 2 + 1 AS main_address_id,
            CASE WHEN c_custkey % 9 = 0 THEN {d.plus_hours(T0, '24 * ((c_custkey * 17) % 2300)')} END AS vip_since,
            {d.plus_hours(T0, '24 * ((c_custkey * 13) % 2300)')} AS created_at,
            CASE WHEN c_custkey % 6 = 0 THEN NULL
                 ELSE {d.plus_hours(T0, '24 * ((c_custkey * 13) % 2300 + 45)')} END AS most_recent_access
            FROM {d.given('customer')}""",
        "shop_addresses": f"""SELECT c_custkey * 2 AS id, c_custkey AS user_id,
                concat('City', {s('c_nationkey')}) AS city, 'SP' AS state FROM {d.given('customer')}
            UNION ALL SELECT CASE WHEN c_acctbal > 1000 THEN 1 ELSE -1 END * (c_custkey * 2 + 1),
                CASE WHEN c_acctbal > 1000 THEN 1 ELSE -1 END * c_custkey, concat('Town', {s('c_nationkey')}),
                CASE c_nationkey % 5 WHEN 0 THEN ' sp' WHEN 1 THEN 'RJ ' WHEN 2 THEN 'mg' WHEN 3 THEN 'ZZ' END
                FROM {d.given('customer')}""",
        "shop_app_sessions": f"""SELECT user_id, {d.ts('ts')} AS created_at,
            {d.plus_hours(d.ts('ts'), 'event_id % 50')} AS most_recent_access FROM {d.given('events')}""",
        "shop_utms": f"""SELECT doc_id AS id,
            CASE doc_id % 10 WHEN 0 THEN 'EMKT-diario' WHEN 1 THEN 'Push_app' WHEN 2 THEN 'direct' WHEN 3 THEN NULL
                 WHEN 4 THEN 'Welcome mail' WHEN 5 THEN 'google' WHEN 6 THEN 'facebook' WHEN 7 THEN ''
                 WHEN 8 THEN 'nullified' ELSE source END AS source,
            CASE WHEN doc_id % 12 = 5 THEN NULL WHEN doc_id % 4 = 1 THEN 'cpc' ELSE lang END AS medium,
            CASE WHEN doc_id % 13 = 5 THEN NULL ELSE concat('Camp-', {s('doc_id % 9')}) END AS campaign,
            CASE WHEN doc_id % 5 = 0 THEN 'term' WHEN doc_id % 5 = 1 THEN '' END AS term,
            CASE WHEN doc_id % 4 = 0 THEN 'content' END AS content,
            CASE WHEN doc_id % 3 = 2 THEN concat('g', {s('doc_id')}) END AS gclid
            FROM {d.given('documents')}""",
        "shop_risk_results": f"""SELECT {k} AS id, {k} AS order_id,
            CASE WHEN {k} % 4 = 0 THEN NULL ELSE CAST({k} % 2 AS INT) END AS successful_past_order_rule,
            CASE WHEN {k} % 5 = 0 THEN NULL ELSE CAST(1 - {d.div(f'{k} % 6', '5')} AS INT) END
                AS maximum_order_value_rule,
            CASE WHEN {k} % 7 = 0 THEN NULL ELSE 1 END AS maximum_of_purchase_on_period_rule
            FROM {d.given('orders')}""",
        "shop_transition_logs": f"""SELECT {k} * 2 AS id, 'captured' AS from_state,
                CASE WHEN {k} % 8 = 1 THEN 'risk_analysis' ELSE 'shipping_successful' END AS to_state,
                CASE WHEN o_orderstatus <> 'P' THEN {k} ELSE -{k} END AS order_id,
                {d.plus_hours(created, f'24 * (1 + {k} % 4)')} AS created_at FROM {d.given('orders')}
            UNION ALL SELECT {k} * 2 + 1, 'shipping_successful', CASE WHEN {k} % 10 = 0 THEN 'shipping_successful'
                ELSE 'delivered' END, CASE WHEN o_orderstatus = 'F' THEN {k} ELSE -{k} END,
                {d.plus_hours(created, f'24 * (6 + {k} % 4)')} FROM {d.given('orders')}""",
        "shop_survey": f"""SELECT {event} AS response_id, concat('user', {s('user_id')}, '@mail.example') AS email,
            {d.plus_hours(d.ts('ts'), f'24 * CASE WHEN {event} % 5 = 0 THEN -3285 ELSE 0 END')} AS answered_at,
            CASE WHEN {event} % 31 = 0 THEN NULL ELSE CAST({event} % 13 - 1 AS INT) END AS score,
            event_type AS reason, user_id AS customer_id, {event} AS order_id FROM {d.given('events')}""",
        "shop_credits": f"""SELECT {event} AS id, {event} AS order_id, user_id, {money('value')} AS value,
            CASE WHEN event_type = 'signup' THEN 'invite' ELSE 'refund' END AS credit_type,
            CASE WHEN {event} % 4 = 0 THEN NULL ELSE {d.ts('ts')} END AS used_at,
            CASE WHEN {event} % 3 = 0 THEN user_id END AS invited_id,
            CASE WHEN {event} % 10 = 0 THEN {d.ts('ts')} END AS cancelled_at, {event} % 6 AS origin_id
            FROM {d.given('events')}""",
        "shop_coupons": f"""SELECT CAST(n_nationkey AS BIGINT) AS id, concat('CODE', {s('n_nationkey')}) AS code,
            {money('5 * (1 + n_nationkey % 6)')} AS value, 'any' AS user_constraint,
            CASE WHEN n_nationkey % 2 = 0 THEN 'first' END AS order_constraint, 'web' AS channel_constraint,
            CAST(n_nationkey % 2 AS INT) AS enabled, {money('50')} AS min_order_value FROM {d.given('nation')}""",
        "shop_web_events": f"""SELECT CAST(ts AS DATE) AS date,
            CASE WHEN event_type = 'error' THEN NULL ELSE concat('web-', event_type) END AS source,
            'organic' AS medium, concat('k', {s(d.json_k('props'))}) AS campaign, user_id AS customer_id,
            {event} AS event_id FROM {d.given('events')}""",
        "shop_web_transactions": f"""SELECT concat(CASE WHEN o_orderpriority < '4' THEN 'M' ELSE 'none' END, {s(k)}) AS public_id,
                CAST({d.plus_hours(created, f'24 * CASE WHEN {k} % 10 = 4 THEN 2 ELSE 0 END')} AS DATE) AS date,
                CASE {k} % 6 WHEN 0 THEN 'google' WHEN 2 THEN 'EMKT-diario' ELSE 'partner.site' END AS source,
                CASE WHEN {k} % 3 = 0 THEN 'cpc' WHEN {k} % 3 = 1 THEN 'email' END AS medium,
                concat('Camp-', {s(f'{k} % 9')}) AS campaign, {money('o_totalprice')} AS revenue
                FROM {d.given('orders')}
            UNION ALL SELECT concat(CASE WHEN o_orderpriority < '2' THEN 'M' ELSE 'none' END, {s(k)}), CAST({created} AS DATE),
                'zz-second', 'zz', 'zz', {money('0')} FROM {d.given('orders')}""",
        "shop_unsubscribes": f"""SELECT concat(CASE WHEN event_type = 'error' AND value < 1.5 THEN 'user' ELSE 'none' END,
            {s('user_id')}, '@mail.example') AS email FROM {d.given('events')}""",
        "shop_opens": f"""SELECT concat(CASE WHEN event_type = 'click' AND value > 15 THEN 'user' ELSE 'none' END,
                {s('user_id')}, '@mail.example') AS email, CAST(ts AS DATE) AS opened_on FROM {d.given('events')}
            UNION ALL SELECT concat(CASE WHEN event_type = 'signup' AND value > 20 THEN 'user' ELSE 'none' END,
                {s('user_id')}, '@mail.example'), NULL FROM {d.given('events')}""",
        "shop_sends": f"""SELECT CASE WHEN {event} % 7 = 0 THEN 'winback' ELSE concat(CASE WHEN {event} % 2 = 0
                THEN '20240105' ELSE '20240112' END, '_', event_type) END AS email_name, {d.ts('ts')} AS send_started,
            CAST(10 + {event} % 5 AS INT) AS sends, CAST(9 + {event} % 4 AS INT) AS deliveries,
            CAST({event} % 6 AS INT) AS opens, CAST({event} % 3 AS INT) AS clicks,
            CAST({d.div(f'{event} % 40', '39')} AS INT) AS unsubscribes FROM {d.given('events')}""",
        "shop_visits": f"""SELECT CAST(ts AS DATE) AS date, CASE WHEN {event} % 7 = 0 THEN 'winback'
                ELSE concat(CASE WHEN {event} % 2 = 0 THEN '20240105' ELSE '20240112' END, CASE event_type WHEN 'signup' THEN '_none_' ELSE '_' END, event_type) END AS source,
            CAST(1 + {event} % 3 AS INT) AS visits FROM {d.given('events')}""",
        "shop_mail_transactions": f"""SELECT CAST(ts AS DATE) AS date, CASE WHEN {event} % 7 = 0 THEN 'winback'
                ELSE concat(CASE WHEN {event} % 2 = 0 THEN '20240105' ELSE '20240112' END, CASE event_type WHEN 'purchase' THEN '_' ELSE '_none_' END, event_type) END AS source,
            concat('T', {s(d.div(event, '2'))}) AS transaction_id, {money('value')} AS revenue
            FROM {d.given('events')}""",
        "shop_invoice_lines": f"""SELECT concat(CASE WHEN {k} % 20 = 0 THEN 'DI' ELSE '01' END, {s(k)}) AS order_number,
            concat('NF', {s(k)}) AS invoice_number, '1' AS series,
            concat(lpad({s('day(o_orderdate)')}, 2, '0'), '/', lpad({s('month(o_orderdate)')}, 2, '0'), '/',
                   {s('year(o_orderdate)')}) AS issued_on,
            {s(money('o_totalprice'))} AS goods_value, {s(money(f'{k} % 30'))} AS freight_value,
            {s(money(f'o_totalprice + {k} % 30'))} AS invoice_value,
            concat('user', {s('o_custkey')}, '@mail.example') AS email,
            concat(CASE WHEN {k} % 15 = 0 THEN '123' ELSE '000' END, lpad({s('o_custkey')}, 11, '0')) AS tax_id
            FROM {d.given('orders')}""",
        "shop_erp_invoices": f"""SELECT concat(CASE WHEN o_orderstatus <> 'O' THEN 'M' ELSE 'none' END, {s(k)}) AS public_id, 'main' AS unit, concat('A', {s(k)}) AS erp_order_id,
                {k} AS invoice_id, {s(k)} AS invoice_number FROM {d.given('orders')}
            UNION ALL SELECT concat(CASE o_orderpriority WHEN '1-URGENT' THEN 'M' ELSE 'none' END, {s(k)}), 'main',
                concat('B', {s(k)}), {k} + 900000000000, {s(f'{k} + 7')} FROM {d.given('orders')}""",
        "shop_carrier": f"""SELECT CAST(2 - {d.div(f'{k} % 10', '9')} AS INT) AS series,
            concat(CASE o_orderpriority WHEN '3-MEDIUM' THEN 'none' ELSE '' END, {s(k)}, ',00') AS invoice_number,
            {money(f'{k} % 40 + 0.75')} AS freight FROM {d.given('orders')}""",
        "shop_erp_products": f"""SELECT concat(CASE p_type WHEN 'PROMO' THEN 'none' ELSE 'P' END, {s('p_partkey')}) AS variant_code,
            {s('p_partkey + 5000')} AS erp_product_id FROM {d.given('part')}""",
        "shop_erp_stock": f"""SELECT DISTINCT {month} AS month,
            concat(CASE l_returnflag WHEN 'A' THEN 'none' ELSE '' END, {s('l_partkey + 5000')}) AS erp_product_id, unit,
            {money(f"10 + l_partkey % 50 + month({month}) * 0.5 + CASE unit WHEN 'main' THEN 0 ELSE 3 END")} AS unit_cost
            FROM {d.units(d.given('lineitem'))} JOIN {d.given('orders')} ON l_orderkey = o_orderkey""",
        "shop_cost_history": f"""SELECT CASE WHEN o_orderdate < {d.ts("'2001-05-01 00:00:00'")} AND o_orderstatus <> 'P' THEN {k} ELSE -{k} END
            AS order_id, {month} AS month, {money(f'{k} % 100 + 0.125')} AS product_cost
            FROM {d.given('orders')}""",
        "shop_shipping_factors": f"""SELECT {without('= 4')}, unit, {rate(f"CASE unit WHEN 'main' THEN 0.8 ELSE 0.3 END + {m} % 5 * 0.1")} AS factor
            FROM {month_units}""",
        "shop_tax_rates": f"""SELECT {without('= 9')}, unit, {rate(f"CASE unit WHEN 'main' THEN 0.1 ELSE 0.05 END + {m} % 3 * 0.01")} AS revenue_rate,
            {rate(f'0.05 + {m} % 4 * 0.01')} AS product_rate, {rate("CASE unit WHEN 'main' THEN 0.02 ELSE 0.04 END")} AS freight_rate
            FROM {month_units}""",
        "shop_payment_fees": "SELECT month, " + rate("1.5") + " AS boleto, CASE WHEN " + m
            + " % 5 = 0 THEN NULL ELSE " + rate("2.25") + " END AS debit, "
            + ", ".join(f"{rate(f'{i} * 0.1 + {m} % 3')} AS fee_{i}" for i in range(1, 13)) + f" FROM {months}",
        "shop_fraud_by_order": f"""SELECT concat(CASE o_orderpriority WHEN '1-URGENT' THEN 'M' ELSE 'none' END, {s(k)}) AS public_id,
            {money(f'{k} % 6 + 0.2')} AS fee FROM {d.given('orders')}""",
        "shop_fraud_by_month": f"SELECT {without('= 6')}, {money(f'{m} % 4 + 0.3')} AS fee FROM {months}",
        "shop_gateway_by_month": f"SELECT {without('= 8')}, {money(f'{m} % 2 + 0.15')} AS fee FROM {months}",
        "shop_packaging_by_month": f"SELECT month, {money(f'1000 + {m} % 12 * 10')} AS cost FROM {months}",
        "shop_fulfilment_by_month": f"""SELECT month, unit, {money(f"CASE unit WHEN 'main' THEN 5000 ELSE 70 END + {m} % 7")} AS staff, {money('800')} AS warehouse
                FROM {month_units}
            UNION ALL SELECT {without('<= 6')}, 'second', {money('100')}, NULL FROM {months}""",
        "shop_production_by_month": f"""SELECT {without('>= 9')}, 'main' AS unit, {money(f'300 + {m} % 5')} AS staff, {money('77.7')} AS studios
            FROM {months}""",
        "shop_margin_by_month": f"""SELECT {without('= 10')}, unit, {rate(f"CASE unit WHEN 'main' THEN 0.2 ELSE 0.5 END + {m} % 4 * 0.01")} AS margin_with,
            {rate(f'0.3 + {m} % 4 * 0.01')} AS margin_without FROM {month_units}""",
        "shop_spend_by_month": f"""SELECT c_mktsegment AS name,
            {money("sum(CASE WHEN c_nationkey % 3 = 0 THEN CAST(c_acctbal AS DECIMAL(18,2)) ELSE 0 END)")} AS m_2001_05,
            {money("sum(CASE WHEN c_nationkey % 3 = 1 THEN CAST(c_acctbal AS DECIMAL(18,2)) ELSE 0 END)")} AS m_2001_06,
            {money("sum(CASE WHEN c_nationkey % 3 = 2 THEN CAST(c_acctbal AS DECIMAL(18,2)) END)")} AS m_2001_07
            FROM {d.given('customer')} GROUP BY c_mktsegment""",
        "shop_spend_split": f"""SELECT DISTINCT c_mktsegment AS name, {rate('0.6')} AS m_2001_05, {rate('0.7')} AS m_2001_06,
            CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE {rate('0.75')} END AS m_2001_07
            FROM {d.given('customer')}""",
        "shop_spend_allocation": f"""SELECT DISTINCT c_mktsegment AS name, 'main' AS unit,
            CASE WHEN c_mktsegment < 'C' THEN 'Activation' WHEN c_mktsegment < 'H' THEN 'Acquisition' ELSE 'Brand' END
                AS purpose,
            CASE WHEN c_nationkey % 2 = 0 THEN 'paid' ELSE 'owned' END AS payment,
            CASE WHEN c_nationkey % 2 = 0 THEN 'Paid Search' ELSE 'E-mail' END AS channel,
            CASE WHEN c_nationkey % 2 = 0 THEN {rate('0.65')} ELSE {rate('0.35')} END AS percent
            FROM {d.given('customer')}
            UNION ALL SELECT DISTINCT CASE c_mktsegment WHEN 'MACHINERY' THEN 'none' ELSE c_mktsegment END, 'second', 'Acquisition',
            'paid', NULL, {rate('1')} FROM {d.given('customer')}""",
        "shop_lifetime_vip": f"""SELECT CASE c_mktsegment WHEN 'BUILDING' THEN c_custkey ELSE -c_custkey END AS user_id, CAST({d.plus_hours(T0, '24 * ((c_custkey * 11) % 2300)')}
            AS DATE) AS vip_since FROM {d.given('customer')}""",
        "shop_category_table": f"""SELECT CASE p_type WHEN 'SMALL' THEN -p_partkey ELSE p_partkey END AS id,
            concat('Final ', p_type) AS final_category FROM {d.given('part')}""",
        "shop_campaign_reference": f"""SELECT concat(CASE WHEN s_acctbal > 500 THEN '' ELSE 'none ' END, 'brand ', {s('1 + s_suppkey % 25')}, ' week') AS treated_slug,
            concat(CASE WHEN s_acctbal > 500 THEN '' ELSE 'none' END, ' brand-', {s('1 + s_suppkey % 25')}, '-week--', {s('s_suppkey')}, ' ') AS slug,
            CASE WHEN s_suppkey % 25 = 3 THEN 'NA' ELSE concat('Brand#', {s('1 + s_suppkey % 25')}) END AS brand,
            CASE s_suppkey % 4 WHEN 0 THEN 'Moda ' WHEN 1 THEN 'Casa' WHEN 2 THEN 'Kids' END AS brand_kind,
            CASE s_suppkey % 5 WHEN 0 THEN 'especial' WHEN 1 THEN 'normal' WHEN 2 THEN 'conceito' ELSE 'single' END
                AS campaign_kind,
            CASE s_suppkey % 2 WHEN 0 THEN 'Feminino' ELSE 'Unissex' END AS gender,
            CASE WHEN s_suppkey % 6 = 0 THEN 'x' END AS exported, s_suppkey AS row_no
            FROM {d.given('supplier')}""",
        "shop_skip_list": f"""SELECT DISTINCT concat(CASE WHEN s_acctbal < 3000 THEN '' ELSE 'none ' END, 'Brand#', {s('1 + s_suppkey % 25')}, ' Especial - Jan-95') AS label
            FROM {d.given('supplier')}""",
        "shop_size_list": f"""SELECT DISTINCT CASE WHEN p_size < 9 THEN 'p' WHEN p_size < 17 THEN 'm'
            WHEN p_size < 25 THEN 'g' WHEN p_size < 33 THEN 'gg' ELSE 'none' END AS size,
            CASE WHEN p_size < 9 THEN 1 WHEN p_size < 17 THEN 2 WHEN p_size < 25 THEN 3 WHEN p_size < 33 THEN 4 ELSE 5 END AS row_no
            FROM {d.given('part')}""",
    }
    return tables


# Which order states count as authorised.
STATE_ROWS = [
    ("delivered", "yes"), ("shipping_successful", "yes"), ("captured", "yes"), ("cancelled_stockout", "yes"),
    ("pending", "no"), ("auth_failed", "no"), ("cancelled", "no"), ("capture_problems", "no"), ("fraud", "no"),
    ("risk_analysis_expired", "no"), ("risk_analysis_problems", "no"),
]
STATUS_ROWS = [
    ("status", "0", "Aguardando Pagamento"), ("status", "1", "Capturado"), ("status", "2", "despachado "),
    ("status", "3", "Pagamento Confirmado"), ("status", "4", "Faturado"), ("status", "5", "Cancelado"),
    ("status", "6", "Devolvido"), ("status", "7", None), ("status", "1", "Segundo nome"),
    ("payment_status", "0", "Capturado"), ("payment_status", "1", "Capturado"), ("payment_status", "2", "Pendente"),
    ("payment_status", "3", "Autorização falhou"),
]
# Status names to keep or drop, one column per list as in the sheet.
STATUS_LIST_ROWS = [
    ("Delivered ", "Incluir", "Cancelado", "Pendente"),
    ("shipping_successful", "incluir", "Devolvido", None),
    ("captured", "Incluir", None, None),
    ("pending", "Excluir", None, None),
]
BR_STATE_ROWS = [
    ("São Paulo", "SP", "Sudeste"), ("Rio de Janeiro", "RJ", "Sudeste"), ("Minas Gerais", " MG", "Sudeste"),
    ("Bahia", "BA", "Nordeste"),
]
RULE_ROWS = [
    (1, "x", "cpc", "x", "goo", "x", "x", "Paid Search", "Google", "Generic"),
    (2, "x", "x", "x", "emkt", "x", "x", "E-mail", "Daily", ""),
    (3, "x", "x", "camp-3", "push", "x", "x", "Push", "Camp 3", ""),
    (4, "x", "x", "x", "push", "x", "x", "Push", "App", ""),
    (5, "direct", "x", "x", "x", "x", "x", "Direct", "Direct", ""),
    (6, "x", "email", "x", "x", "x", "x", "E-mail", "Partner", ""),
    (10, "facebook", "x", "x", "x", "x", "camp-1", "Social", "Facebook 1", ""),
    (9, "facebook", "x", "x", "x", "x", "camp", "Social", "Facebook", ""),
    (11, "x", "x", "x", "web-", "organic", "x", "n/a", "Web", ""),
    (12, None, "x", "x", "x", "x", "x", "Blank", "Blank", ""),
]
# Earlier runs of the conversion estimate; the last row is of the run day and gets replaced.
CONVERSION_ROWS = [
    ("main", "2001-06-28", 0.2, 0.31, 0.11, 1000), ("main", "2001-07-02", 0.2, 0.255, 0.055, 1100),
    ("main", "2001-07-10", 0.2, 0.21, 0.01, 1200), ("main", "2001-07-31", 0.1, 0.9, 0.8, 1300),
    ("second", "2001-07-20", 0.1, 1.0, 0.9, 900),
]
DELIVERY_LABELS = {1: "Entrega Rápida", 2: "Entrega Normal"}
INVENTORY_LABELS = {"INTERNAL": "Estoque interno", "CONSIGNED": "Consignação"}


def _literal(value: object) -> str:
    if value is None:
        return "CAST(NULL AS STRING)"
    return str(value) if isinstance(value, int) else "'" + value.replace("'", "''") + "'"


def inline_tables() -> dict[str, str]:
    """Name -> SELECT text of the literal sheets; the same text runs in both engines."""

    def rows(columns: str, data: list[tuple]) -> str:
        listed = ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in data)
        return f"SELECT * FROM (VALUES {listed}) AS t({', '.join(columns.split())})"

    return {
        "shop_state_map": rows("state consider", STATE_ROWS),
        "shop_status_names": rows("status_type status_id status_name", STATUS_ROWS),
        "shop_status_lists": rows("state keep erp_exclude payment_exclude", STATUS_LIST_ROWS),
        "shop_br_states": rows("state_name state region", BR_STATE_ROWS),
        "shop_conversion_history": " UNION ALL ".join(
            f"SELECT '{unit}' AS unit, CAST('{day}' AS DATE) AS day, CAST({a} AS DOUBLE) AS rate_1_30, "
            f"CAST({b} AS DOUBLE) AS rate_91_120, CAST({dif} AS DOUBLE) AS dif, "
            f"CAST({total} AS DECIMAL(38,4)) AS revenue" for unit, day, a, b, dif, total in CONVERSION_ROWS
        ),
        "shop_rules": rows(
            "rule_no exact_source exact_medium exact_campaign like_source like_medium like_campaign "
            "level1 level2 level3", RULE_ROWS,
        ),
    }


@lru_cache(maxsize=1)
def spark_texts() -> dict[str, str]:
    return {**shop_tables(SparkText()), **inline_tables()}


@lru_cache(maxsize=1)
def duck_texts() -> dict[str, str]:
    return {**shop_tables(DuckText()), **inline_tables()}


class Shop:
    """The shop tables of one test folder, as attributes: `Shop(spark, folder).orders`."""

    def __init__(self, spark: SparkSession, folder: str):
        use_settings(spark)
        self._spark, self._folder, self._views, self._frames = spark, folder, set(), {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._frames:
            text = spark_texts()[f"shop_{name}"]
            for given in GIVEN:
                if given not in self._views and f"given_{given}" in text:
                    table = self._spark.read.parquet(f"{self._folder}/{given}.parquet")
                    table.createOrReplaceTempView(f"given_{given}")
                    self._views.add(given)
            self._frames[name] = self._spark.sql(text)
        return self._frames[name]
