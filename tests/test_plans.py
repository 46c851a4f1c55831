import datetime as dt
import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from basketry.plans import catalogue, costs, lifecycle, margin, orders, service, users

D = dt.date


def t(text):
    return dt.datetime.fromisoformat(text)


# ---- channels and users

def test_source_groups_first_match_wins_and_null_is_unattributed(frame):
    utms = frame([("EMKT_push",), ("x-push",), ("direct",), (None,), (None,), ("null",), ("annulled",), ("base",), ("baseat",)],
                 "source string")
    got = dict(rows(users.source_groups(utms), "source", "source_group"))
    assert got == {"EMKT_push": "emkt", "x-push": "push", "direct": "direct", "null": "unattributed", "annulled": None,
                   "base": "other", "baseat": "emkt"}


def test_source_holding_the_text_null_has_no_group(frame):
    got = dict(rows(users.source_groups(frame([("nullable",)], "source string"))))
    assert got == {"nullable": None}


def test_non_buyers_include_unknown_flags(frame):
    df = frame([(1, 1), (2, 0), (3, None)], "user_id int, is_buyer int")
    assert rows(users.non_buyers(df), "user_id") == [(2,), (3,)]


def test_many_app_sessions_keep_one_user_row(frame):
    people = frame(
        [(1, "e", "f", "l", "m", 1, None, 5, t("2015-12-01 01:00:00"), None)],
        "id long, email string, first_name string, last_name string, gender string, subscribed int, utm_id long, "
        "origin int, created_at timestamp, most_recent_access timestamp")
    utms = frame([], "id long, source string, medium string, campaign string")
    sessions = frame([(1, t("2015-01-01 12:00:00")), (1, t("2015-02-01 12:00:00"))], "user_id long, most_recent_access timestamp")
    row = users.users_cube(people, utms, sessions).collect()
    assert len(row) == 1
    row = row[0]
    assert (row.user_source, row.user_origin, row.registered_via_mobile_browser, row.register_cohort) == (
        "no utm", "Mobile browser", 1, "2015-11")
    assert (row.last_app_access_date, row.accessed_via_web, row.accessed_via_app) == (D(2015, 2, 1), 0, 1)


def test_customer_without_utm_row_falls_back_to_first_event(frame):
    customers = frame([(1, None, None, None), (2, "", "m", "c"), (3, "own", None, "c"), (4, None, None, None)],
                      "customer_id long, utm_source string, utm_medium string, utm_campaign string")
    events = frame([(1, D(2015, 1, 2), 5, "late", "x", "x"), (1, D(2015, 1, 1), 9, "early", None, "y"),
                    (2, D(2015, 1, 1), 1, "web", "wm", "wc")],
                   "customer_id long, date date, event_id long, source string, medium string, campaign string")
    got = users.customer_source(customers, events)
    assert rows(got, "customer_id", "customer_source", "customer_medium", "customer_campaign") == [
        (1, "early", "n/a", "y"), (2, "web", "wm", "wc"), (3, "own", None, "c"), (4, "n/a", "n/a", "n/a")]


# ---- orders

ITEM = ("id string, order_id long, campaign_id long, variant_id long, quantity int, cancelled_quantity int, "
        "stockout_quantity int, final_price double, original_price double, shipping_price double, "
        "stockout_shipping_price double")


def test_item_values_follow_the_order_state(frame):
    items = frame([(str(o), o, 1, 1, 10, 1, 2, 5.0, 8.0, 3.0, 0.5) for o in (1, 2, 3)], ITEM)
    states = frame([(1, "delivered"), (2, "cancelled"), (3, "cancelled_stockout")], "id long, state string")
    got = orders.order_items_cube(items, states)
    assert rows(got, "order_id", "all_stockout_quantity", "all_cancelled_quantity", "final_item_quantity",
                "original_item_value", "final_item_value") == [
        (1, 2, 1, 7, 53.5, 38.0), (2, 2, 10, -2, 53.5, -7.0), (3, 10, 1, -1, 53.5, -2.0)]


def test_totals_before_and_after_the_state_join_agree(frame):
    items = frame([(f"{o}-{n}", o, 1, 1, 10 + n, 1, 2 if n else None, 5.0, 8.0, 3.0 if n < 2 else None, 0.5)
                   for o in (1, 2, 3, 4, 5) for n in range(4)], ITEM)
    states = frame([(1, "delivered"), (2, "cancelled"), (3, "cancelled_stockout"), (4, None)], "id long, state string")
    columns = ["order_id", "number_of_products", *orders.TOTALS]
    assert rows(orders.order_totals_by_state(items, states), *columns) == rows(
        orders.order_totals(orders.order_items_cube(items, states)), *columns)


def test_first_id_and_first_day_are_independent(frame):
    df = frame([(1, 10, D(2015, 5, 1)), (1, 11, D(2015, 4, 1))], "user_id long, order_id long, order_date date")
    row = orders.first_time_buyers(df).first()
    assert (row.first_order_id, row.first_order_date, row.ftb_cohort) == (10, D(2015, 4, 1), "2015-04")


def test_inclusion_rules(frame):
    lists = frame([("Delivered", "Incluir", "Cancelado", None), ("pending", "Excluir", None, "Falhou ")],
                  "state string, keep string, erp_exclude string, payment_exclude string")
    df = frame([(1, "delivered ", "ok", "ok"), (2, "pending", "ok", "ok"), (3, None, "ok", "ok"), (4, None, "CANCELADO", "ok"),
                (5, "delivered", None, "falhou"), (6, "-", None, None)],
               "order_id int, order_state string, erp_status string, payment_status_name string")
    got = orders.order_inclusion(df, lists)
    assert rows(got, "order_id", "include_state", "include_erp_payment") == [
        (1, "Sim", "Sim"), (2, "Não", "Sim"), (3, "Sim", "Sim"), (4, "Não", "Não"), (5, "Sim", "Não"), (6, "Sim", "Sim")]


def test_unknown_payment_status_is_kept_in_the_base(frame, spark):
    schema = ("order_id long, public_id string, created_at timestamp, customer_id long, erp_status string, "
              "payment_status_name string, items_value decimal(18,4), shipping_value decimal(18,4), installments int, "
              "order_state string, credit_card_operator string")
    df = frame([(1, "M1", t("2015-01-01 10:00:00"), 1, " Faturado", None, None, None, 1, None, "v"),
                (2, "M2", t("2015-01-01 10:00:00"), 1, "Faturado", "Autorização falhou", None, None, 1, None, "v"),
                (3, "M3", t("2015-01-01 10:00:00"), 1, "Outro", "Capturado", None, None, 1, None, "v")], schema)
    for column in ("source", "campaign", "medium", "term", "content", "gclid"):
        df = df.withColumn(f"utm_{column}", F.lit(""))
    got = orders.orders_base(df, "0.5").collect()
    assert [(r.order_id, r.revenue, r.payment_status, r.order_state) for r in got] == [(1, 0, "-", "-")]


def base(frame, data):
    return frame(data, "order_id long, public_id string, customer_id long, order_date date, month date, "
                 "payment_confirmed int, revenue double, unit string")


def test_cardinals(frame):
    df = base(frame, [(1, "A", 7, D(2015, 1, 1), None, 0, 1.0, "main"), (2, "B", 7, D(2015, 1, 1), None, 1, 1.0, "main"),
                      (3, "C", 7, D(2015, 2, 1), None, 1, 1.0, "main"), (4, "D", 8, D(2015, 2, 1), None, 0, 1.0, "main")])
    got = orders.order_cardinal(df)
    assert rows(got, "order_id", "cardinal", "cardinal_paid", "is_ftp", "is_ftp_paid") == [
        (1, 1, None, 1, 0), (2, 2, 1, 0, 1), (3, 3, 2, 0, 0), (4, 1, None, 1, 0)]
    people = frame([(7, D(2015, 3, 1)), (9, D(2015, 3, 1))], "customer_id long, registered_on date")
    stones = orders.customer_milestones(people, got)
    assert rows(stones, "customer_id", "orders", "register_date", "first_paid_date") == [
        (7, 3, D(2015, 1, 1), D(2015, 1, 1)), (9, 0, D(2015, 3, 1), None)]
    days = lifecycle.days_since_previous_order(got, stones)
    assert rows(days, "order_id", "days_since_previous") == [(1, 0), (2, 0), (3, 31), (4, None)]


def history(frame, data):
    return frame(data, "unit string, day date, rate_1_30 double, rate_91_120 double, dif double, revenue double")


def test_conversion_uses_the_newest_rate_above_two_percent(frame):
    df = base(frame, [(1, "A", 1, D(2015, 4, 1), None, 1, 100.0, "main"), (2, "B", 1, D(2014, 1, 1), None, 1, 100.0, "main")])
    as_of = D(2015, 4, 1)
    rates = [("main", D(2015, 3, n), 0.0, 0.0, dif, 0.0) for n, dif in [(1, 0.5), (2, 0.3), (3, 0.02), (4, 0.01)]]
    got = orders.conversion_estimate(df, history(frame, rates), as_of)
    assert rows(got, "order_id", "conversion_factor") == [(1, 0.7), (2, 1.0)]
    # a missing difference ends the search, and so does an empty history
    ended = history(frame, rates + [("main", D(2015, 3, 5), None, None, None, 0.0)])
    assert rows(orders.conversion_estimate(df, ended, as_of), "order_id", "conversion_factor") == [(1, 0.98), (2, 1.0)]
    assert rows(orders.conversion_estimate(df, history(frame, []), as_of), "conversion_factor") == [(0.98,), (1.0,)]
    # another unit's newer rate changes nothing, and orders of a unit that is not estimated count in full
    df = base(frame, [(1, "A", 1, D(2015, 4, 1), None, 1, 100.0, "main"), (2, "B", 1, D(2015, 4, 1), None, 1, 100.0, "second")])
    rates = [("main", D(2015, 3, 1), 0.0, 0.0, 0.1, 0.0), ("second", D(2015, 3, 2), 0.0, 0.0, 0.9, 0.0)]
    got = rows(orders.conversion_estimate(df, history(frame, rates), as_of), "order_id", "conversion_factor")
    assert got == [(1, 0.9), (2, 1.0)]


def test_costs_of_one_unit_do_not_reach_the_other(frame):
    jan = D(2015, 1, 1)
    df = frame([(1, "main", jan, 10.0, 100.0, 10.0, 10.0), (2, "second", jan, 10.0, 100.0, 10.0, 10.0)],
               "order_id long, unit string, month date, shipping_cost_shop double, revenue double, product_cost double, shipping_cost double")
    two = lambda a, b, name: frame([(jan, "main", a), (jan, "second", b)], f"month date, unit string, {name} double")
    adjusted = margin.shipping_adjust(df.drop("shipping_cost"), two(1.5, 0.5, "factor"))
    assert [(i, float(c)) for i, c in rows(adjusted, "order_id", "shipping_cost")] == [(1, 15.0), (2, 5.0)]
    rates = two(0.1, 0.05, "revenue_rate").withColumns({"product_rate": F.lit(0.0), "freight_rate": F.lit(0.0)})
    assert rows(margin.taxes(df, rates), "order_id", "revenue_tax") == [(1, 10.0), (2, 5.0)]
    spent = frame([(jan, "second", 100.0, 0.0)], "month date, unit string, staff double, warehouse double")
    made = frame([], "month date, unit string, staff double, studios double")
    assert rows(margin.fulfilment_share(df, spent, made), "order_id", "fulfilment_staff") == [(1, 0.0), (2, 100.0)]
    margins = two(0.2, 0.1, "margin_with").withColumn("margin_without", F.lit(0.0))
    assert rows(lifecycle.contribution_margin(df, margins), "order_id", "margin_with_fulfilment") == [(1, 20.0), (2, 10.0)]
    items = frame([(7, 1, "x", "v", 1), (8, 2, "x", "v", 1)], "item_id long, order_id long, product_name string, variant_code string, quantity int")
    erp = frame([("v", "e")], "variant_code string, erp_product_id string")
    stock = frame([(jan, "e", "main", 20.0), (jan, "e", "second", 3.0)], "month date, erp_product_id string, unit string, unit_cost double")
    assert rows(margin.item_cost(df, items, erp, stock), "order_id", "unit_cost") == [(1, 20.0), (2, 3.0)]


def test_conversion_snapshot_paid_switch_and_rerun(frame):
    df = base(frame, [(1, "A", 1, D(2015, 3, 30), None, 1, 60.0, "main"), (2, "B", 1, D(2015, 3, 30), None, 0, 40.0, "main"),
                      (3, "C", 1, D(2014, 12, 25), None, 0, 10.0, "main")])
    snap = orders.conversion_snapshot(df, D(2015, 4, 1))
    row = snap.first()
    assert (row.rate_1_30, row.rate_91_120, round(row.dif, 9)) == (0.4, 1.0, 0.6)
    raw = orders.conversion_snapshot(df, D(2015, 4, 1), paid_only=False).first()
    assert (raw.rate_1_30, raw.rate_91_120, raw.dif) == (0.0, 0.0, 0.0)
    stored = history(frame, [("main", D(2015, 4, 1), 0.0, 0.0, 0.9, 0.0), ("main", D(2015, 3, 1), 0.0, 0.0, 0.1, 0.0)])
    merged = orders.conversion_history(stored, snap, D(2015, 4, 1))
    assert [round(d, 9) for (d,) in rows(merged, "dif")] == [0.1, 0.6]


def test_orders_without_items_are_kept_once(frame):
    head = frame([(1, "delivered", 1, 1.0, 1.0, 1.0, None, 1.0), (2, "odd", 1, 1.0, 1.0, 1.0, None, 1.0),
                  (3, "pending", 1, 1.0, 1.0, 1.0, None, 1.0)],
                 "id long, state string, user_id long, cached_final_value double, cached_total_value double, "
                 "cached_credits double, coupon_id long, shipping_price double")
    items = frame([("a", 1, 1, 1, 1, "n", 1, 0, 0, 1.0, 1.0, 1.0, None, None), ("b", 1, 1, 1, 1, "n", 1, 0, 0, 1.0, 1.0, 1.0, None, None)],
                  "id string, order_id long, product_id long, variant_id long, campaign_id long, name string, quantity int, "
                  "cancelled_quantity int, stockout_quantity int, final_price double, original_price double, "
                  "shipping_price double, created_at timestamp, updated_at timestamp")
    states = frame([("delivered", "yes"), ("pending", "no")], "state string, consider string")
    assert rows(catalogue.counted_order_items(head, items, states), "order_id", "item_id") == [(1, "a"), (1, "b"), (2, None)]


# ---- catalogue

def test_only_parents_without_variants_stand_alone(frame):
    products = frame([(1, None), (2, 1), (3, None), (4, 9)], "id long, parent_product_id long")
    assert rows(catalogue.with_sku_key(products), "id", "sku_key") == [(2, 1), (3, 3), (4, 9)]


def test_months_between_start_and_end_are_not_counted(frame):
    campaigns = frame([(1, t("2015-01-10 12:00:00"), t("2015-03-10 12:00:00")), (2, None, t("2015-03-10 12:00:00"))],
                      "id long, offer_starts_at timestamp, offer_ends_at timestamp")
    assert rows(catalogue.active_campaigns_monthly(campaigns)) == [("2015-01", 1), ("2015-03", 1), ("Null", 1)]


def test_campaign_brand_from_products_and_no_repeats(frame):
    campaigns = frame([(1, "A", "a-b--c", None, t("2015-12-01 00:00:00"), t("2015-12-05 00:00:00"), "h", "b"),
                       (2, "B", "x", 5, t("2015-12-01 00:00:00"), None, "h", "b")],
                      "id long, name string, slug string, brand_id long, offer_starts_at timestamp, offer_ends_at timestamp, "
                      "highlight string, banner string")
    pairs = frame([(1, 10), (1, 10), (1, 11), (1, 12), (2, 10), (2, 11)], "campaign_id long, product_id long")
    products = frame([(10, 7), (11, 8), (12, None)], "id long, brand_id long")
    brands = frame([(5, "five"), (7, "seven")], "id long, name string")
    got = catalogue.campaign_brand(campaigns, pairs, products, brands)
    assert rows(got, "campaign_id", "brand_id", "brand_name", "treated_slug", "label", "label_short") == [
        (1, 7, "seven", "a b", "A - Dez-15", "A 12.15"), (1, 8, None, "a b", "A - Dez-15", "A 12.15"),
        (2, 5, "five", "x", "B - Dez-15", "B 12.15")]


def test_sizes_listed_first_then_alphabetical(frame):
    got = catalogue.size_order(frame([("p", 1), ("m", 2)], "size string, row_no int"),
                               frame([("P",), ("XL",), ("38",), (None,)], "size string"))
    assert rows(got) == [("38", 3), ("M", 2), ("P", 1), ("XL", 4)]


def bands(frame, prices):
    products = frame([("b", float(p), s) for p, s in prices], "slug_products string, final_price double, stock long")
    kinds = frame([("k", "b", 1)], "treated_slug string, slug_products string, campaign_id long")
    return {p: b for p, b in rows(catalogue.price_bands(products, kinds), "final_price", "band")}


def test_bands_cover_every_price(frame):
    assert bands(frame, [(10, 1), (20, 1), (30, 1), (40, 1)]) == {
        10.0: "Abaixo de R$14.99", 20.0: "R$15-24.99", 30.0: "R$25-34.99", 40.0: "R$35+"}
    assert bands(frame, [(10, 5)]) == {10.0: "R$10.00"}
    # the mean rounds to the lowest price, so nothing lies below it
    assert bands(frame, [(10, 100), (12, 1)]) == {10.0: "R$10-11.99", 12.0: "R$12+"}
    # the mean rounds to the highest price, so nothing lies above it
    assert bands(frame, [(10, 1), (12, 100)]) == {10.0: "R$10-11.99", 12.0: "R$12+"}


def test_newest_campaign_decides_the_bands(frame):
    products = frame([("old", 10.0, 1), ("new", 100.0, 1), ("new", 200.0, 1)], "slug_products string, final_price double, stock long")
    kinds = frame([("k", "old", 1), ("k", "new", 2)], "treated_slug string, slug_products string, campaign_id long")
    got = rows(catalogue.price_bands(products, kinds), "final_price", "mean", "band")
    assert got == [(10.0, 150.0, "Abaixo de R$99.99"), (100.0, 150.0, "R$100-149.99"), (200.0, 150.0, "R$200+")]


# ---- margin

def test_payment_fee_by_form_and_instalment(frame):
    fees = frame([(D(2015, 1, 1), 1.5, None, *[i / 10 for i in range(1, 13)])],
                 "month date, boleto double, debit double, " + ", ".join(f"fee_{i} double" for i in range(1, 13)))
    df = frame([(1, D(2015, 1, 1), "Cartão de Crédito", 3), (2, D(2015, 1, 1), "Boleto", 3), (3, D(2015, 1, 1), "Débito Online", 1),
                (4, D(2015, 1, 1), "Cartão de Crédito", 13), (5, D(2015, 2, 1), "Boleto", 1)],
               "order_id int, month date, payment_form string, installments int")
    assert [(i, float(f)) for i, f in rows(margin.payment_fee(df, fees), "order_id", "payment_fee")] == [
        (1, 0.3), (2, 1.5), (3, 0.0), (4, 0.0), (5, 0.0)]


def test_monthly_costs_are_spread_completely(frame):
    jan, feb = D(2015, 1, 1), D(2015, 2, 1)
    df = frame([(1, jan, "main", 30.0), (2, jan, "main", 10.0), (3, feb, "main", 0.0)], "order_id int, month date, unit string, revenue double")
    fulfilment = frame([(jan, "main", 100.0, 8.0), (jan, "main", 20.0, None)], "month date, unit string, staff double, warehouse double")
    production = frame([(feb, "main", 5.0, 5.0)], "month date, unit string, staff double, studios double")
    got = margin.fulfilment_share(df, fulfilment, production)
    assert rows(got, "order_id", "fulfilment_staff", "fulfilment_warehouse", "production_staff") == [
        (1, 90.0, 6.0, 0.0), (2, 30.0, 2.0, 0.0), (3, None, None, None)]
    packed = margin.packaging_share(df, frame([(jan, 9.0)], "month date, cost double"))
    assert rows(packed, "order_id", "packaging") == [(1, 4.5), (2, 4.5), (3, None)]


def test_stored_cost_never_changes(frame):
    months = [D(2015, 1, 1), D(2015, 2, 1), D(2015, 3, 1)]
    df = frame([(i + 1, m) for i, m in enumerate(months)] + [(4, months[1])], "order_id long, month date")
    costs = frame([(i, m, 2.0, 3) for i, m in [(1, months[0]), (2, months[1]), (3, months[2])]] + [(4, months[1], None, 3)],
                  "order_id long, month date, unit_cost double, quantity int")
    stored = frame([(2, 99.0), (8, 1.0)], "order_id long, product_cost double")
    got = margin.frozen_order_cost(df, costs, stored)
    assert [(o, None if c is None else float(c)) for o, c in rows(got, "order_id", "product_cost")] == [
        (1, None), (2, 99.0), (3, 6.0), (4, 0.0)]
    assert [(o, float(c)) for o, c in rows(margin.new_cost_history(got, stored))] == [(2, 99.0), (4, 0.0), (8, 1.0)]


def test_click_id_rule_only_fills_missing_channels(frame):
    df = frame([(1, "s", "m", "c", "g", "term"), (2, "s", "m", "c", "g", ""), (3, "s", "m", "c", " ", "term"),
                (4, "known", "m", "c", "g", "term"), (5, "s", "m", "c", "g", " ")],
               "id int, order_source string, order_medium string, order_campaign string, utm_gclid string, utm_term string"
               ).withColumn("unit", F.lit("main"))
    channels = frame([("known", "m", "c", "main", "A", "B", "C", 1)],
                     "source string, medium string, campaign string, unit string, level1 string, level2 string, level3 string, rule_no int")
    got = margin.channel_apply(df, channels, "order_")
    assert rows(got, "id", "level1", "level2", "level3") == [
        (1, "Paid Search", "Google Search", ""), (2, "Display Ads", "Google DCO", ""), (3, "n/a", "n/a", "n/a"),
        (4, "A", "B", "C"), (5, "n/a", "n/a", "n/a")]


def test_invoices(frame):
    lines = frame([("01123", "N1", "31/12/2015", "10.5", "1", "11.5", "e", "00000000000012"),
                   ("DI124", "N2", "31/12/2015", "1", "1", "1", "e", "000"), ("01125", "N3", "bad", "1", "1", "1", "e", "123456")],
                  "order_number string, invoice_number string, issued_on string, goods_value string, freight_value string, "
                  "invoice_value string, email string, tax_id string")
    assert rows(margin.invoices(lines), "order_id", "invoice_date", "tax_id") == [
        ("123", D(2015, 12, 31), "12"), ("125", None, "erro no cpf")]


# ---- service

def test_best_delivery_date(frame):
    schema = ("id long, state string, external_id string, shipping_period int, total_shipping_time int, created_at timestamp, "
              "delivered_at timestamp")
    noon = t("2015-01-01 12:00:00")
    heads = frame([(1, "delivered", "E", 3, 9, noon, t("2015-01-08 12:00:00")), (2, "shipping_successful", "E", 3, 9, noon, None),
                   (3, "shipping_successful", "E", 3, 9, noon, None), (4, "pending", "E", 3, 9, noon, None),
                   (5, "fraud", "E", 3, 9, noon, None), (6, None, "E", 3, 9, noon, None)], schema)
    log = frame([(2, "shipping_successful", t("2015-01-05 12:00:00")), (2, "shipping_successful", t("2015-01-04 12:00:00")),
                 (3, "delivered", noon)], "order_id long, to_state string, created_at timestamp")
    totals = frame([(1, 1.0, 1, 1.0)], "order_id long, original_order_value double, final_quantity int, final_order_value double")
    got = service.delivery_dates(heads, log, totals)
    assert rows(got, "order_id", "delivery_status", "best_date") == [
        (1, "delivered", D(2015, 1, 8)), (2, "no delivery data", D(2015, 1, 7)), (3, "no delivery data", D(2015, 1, 10)),
        (4, "not delivered", None), (6, "not delivered", None)]


def test_risk_list_has_one_row_per_order(frame):
    results = frame([(1, 0, 1, None), (2, 1, 1, 1), (3, None, None, None)],
                    "order_id long, successful_past_order_rule int, maximum_order_value_rule int, maximum_of_purchase_on_period_rule int")
    heads = frame([(1, t("2015-01-01 12:00:00"), "E1"), (2, t("2015-01-01 12:00:00"), "E2")], "id long, created_at timestamp, external_id string")
    long = service.risk_rules(results, heads, frame([(1,)], "first_order_id long"))
    assert rows(long, "order_id", "rule", "rule_applies", "ftp") == [
        (1, "Rule 1", "Clearsale", "yes"), (1, "Rule 2", "Whitelist", "yes"), (2, "Rule 1", "Whitelist", "no"),
        (2, "Rule 2", "Whitelist", "no"), (2, "Rule 3", "Whitelist", "no")]
    assert rows(service.risk_final_list(long), "order_id", "final_list") == [(1, "Clearsale"), (2, "Whitelist")]


def test_nps_edges(frame):
    survey = frame([(i, "e", t("2015-02-01 10:00:00"), s, "r", 1, 1) for i, s in enumerate([0, 6, 7, 8, 9, 10, 11, -1, None])]
                   + [(99, "e", t("2015-01-31 00:00:00"), 5, "r", 1, 1)],
                   "response_id int, email string, answered_at timestamp, score int, reason string, customer_id int, order_id int")
    got = service.nps_groups(survey, D(2015, 3, 3))
    assert [g for _, g in rows(got, "response_id", "nps_group")] == [
        "Detractors", "Detractors", "Passives", "Passives", "Promoters", "Promoters"]
    assert {f for (f,) in rows(got, "last_30_days")} == {1}


# ---- lifecycle

def test_ltv_divides_by_cohorts_old_enough(frame):
    df = frame([(0, 100.0), (0, 50.0), (1, 30.0), (2, 20.0)], "months_ftp int, revenue double")
    people = frame([(1, D(2015, 1, 5)), (2, D(2015, 2, 5)), (3, D(2015, 2, 6)), (4, D(2015, 3, 1)), (5, None)],
                   "customer_id long, first_order_date date")
    got = lifecycle.ltv_curve(df, people)
    assert rows(got, "distance", "revenue", "users", "ltv") == [(0, 150.0, 4, 37.5), (1, 30.0, 3, 10.0), (2, 20.0, 1, 20.0)]
    summary = lifecycle.ltv_summary(got).first()
    assert (round(summary.first_ratio, 6), summary.mean_ratio) == (round(10 / 37.5, 6), 2.0)


def test_age_bands(frame):
    df = frame([(a,) for a in (None, 0, 15, 16, 30, 45, 46, 90)], "a int")
    got = {r["a"]: r["b"] for r in df.select("a", lifecycle.age_band(F.col("a")).alias("b")).collect()}
    assert got == {None: None, 0: "0 - 15 dias", 15: "0 - 15 dias", 16: "15 - 30 dias", 30: "15 - 30 dias",
                   45: "30 - 45 dias", 46: "45 - 60 dias", 90: "45 - 60 dias"}


def test_mail_visits_do_not_repeat_transactions(frame):
    sends = frame([("20150101_promo", t("2015-01-05 10:00:00"), 10, 9, 3, 1, 0), ("20150101_promo", t("2015-01-06 10:00:00"), 5, 5, 1, 1, 0)],
                  "email_name string, send_started timestamp, sends int, deliveries int, opens int, clicks int, unsubscribes int")
    visits = frame([(D(2015, 1, 1), "20150101_promo", 7)], "date date, source string, visits int")
    sales = frame([(D(2015, 1, 1), "20150101_promo", "T1", 5.0), (D(2015, 1, 2), "20150101_promo", "T2", 6.0)],
                  "date date, source string, transaction_id string, revenue double")
    row = lifecycle.email_send_summary(sends, visits, sales).first()
    assert (row.email_date, row.email_type, row.sends, row.visits, row.transactions, row.revenue) == (
        D(2015, 1, 1), "promo", 15, 7, 2, 11.0)


def test_rfm_quintiles_and_vip(frame):
    df = frame([(c, c * 100 + n, D(2015, 1, 1) + dt.timedelta(days=c), float(c)) for c in range(1, 11) for n in range(c)],
               "customer_id long, order_id long, order_date date, revenue double")
    got = lifecycle.rfm_score(df)
    assert rows(got.where("customer_id in (10, 1, 7)"), "customer_id", "m_class", "f_class", "r_class", "score", "is_vip") == [
        (1, 5, 5, 5, 6, "Não"), (10, 1, 1, 1, 30, "Sim"), (7, 2, 2, 2, 24, "Não")]


def test_segments_are_exhaustive(frame):
    data = [(i, "main", int(i % 2 == 0), i % 4, int(i % 3 == 0), "Sim" if i % 5 == 0 else None) for i in range(60)]
    df = frame(data, "customer_id long, unit string, is_opt_in int, paid_orders int, is_active int, is_vip string")
    row = lifecycle.client_segments(df).first()
    assert row.total == row.opt_in + row.opt_out == 60
    assert row.never_bought == row.never_bought_active + row.never_bought_inactive
    assert row.buyers == row.ftb + row.vip + row["repeat"]


# ---- items matched to campaigns

def campaign_tables(frame, campaigns):
    """Two items of brand a, ordered within and after the windows of its campaigns, and one order left out."""
    orders = frame(
        [(1, "Sim", dt.datetime(2020, 1, 5, 9)), (2, "Sim", dt.datetime(2020, 3, 1, 9)), (3, "Não", dt.datetime(2020, 1, 5, 9))],
        "order_id long, include_state string, created_at timestamp",
    )
    items = frame([(f"i{o}", o, "A1", 2) for o in (1, 2, 3)], "item_id string, order_id long, variant_code string, quantity int")
    windows = frame(
        [(c, "a", dt.date(2020, 1, 1), dt.date(2020, 1, 31)) for c in range(campaigns)],
        "campaign_id int, slug_products string, start_day0 date, end_date date",
    )
    products = frame([("A1", "a", 7, 5, 6)], "product_code string, slug_products string, product_id int, final_price int, list_price int")
    return orders, items, windows, products


def most_rows(df, kind="Join", metric="numOutputRows"):
    """The largest number of rows that any join gave (or an operator of another kind, by a metric of it)."""
    df.collect()
    counts, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        elif node.nodeName().endswith("QueryStage"):
            todo.append(node.plan())
        else:
            todo += [node.children().apply(i) for i in range(node.children().length())]
        if kind in node.nodeName() and node.metrics().contains(metric):
            counts.append(node.metrics().apply(metric).value())
    return max(counts)


def test_campaign_orders_do_not_multiply_items_by_campaigns(frame):
    got = catalogue.campaign_orders(*campaign_tables(frame, 500))
    assert rows(got, "order_id", "order_hour") == [(1, 9)]
    # The 500 open days of the campaigns are the most that a join gives; items of many orders would show the product.
    orders, items, windows, products = campaign_tables(frame, 500)
    many = frame([(f"i{n}", 1, "A1", 1) for n in range(40)], "item_id string, order_id long, variant_code string, quantity int")
    assert most_rows(catalogue.campaign_orders(orders, many, windows, products)) <= 500


def test_campaign_items_meet_only_campaigns_open_on_their_day(frame):
    """Items meet the campaigns by equality on brand and day, with no test of the window left to do per item."""
    orders, items, windows, products = campaign_tables(frame, 3)
    many = frame([(f"i{n}", 2 - n % 2, "A1", 2) for n in range(40)], "item_id string, order_id long, variant_code string, quantity int")
    late = windows.selectExpr("campaign_id + 100 as campaign_id", "slug_products", "date'2020-01-06' as start_day0", "date'2020-02-05' as end_date")
    got = catalogue.campaign_items(orders, many, windows.union(late), products)
    assert rows(got, "item_id", "campaign_id", "total") == sorted((f"i{n}", c, 10) for n in range(1, 40, 2) for c in range(3))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"Join \[slug_products#\d+, order_date#\d+\], \[slug_products#\d+, order_date#\d+\], Inner[^(]*\n", plan), plan


def test_campaign_days_are_numbered_before_items_multiply_them(frame, spark):
    orders, items, windows, products = campaign_tables(frame, 3)
    early = windows.selectExpr("campaign_id", "slug_products", "date'2019-12-01' as start_day0", "date'2019-12-02' as end_date").where("campaign_id = 1")
    many = frame([(f"i{n}", 1, "A1", 2) for n in range(40)], "item_id string, order_id long, variant_code string, quantity int")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = catalogue.campaign_day(orders, many, windows.union(early), products)
        moved = most_rows(got, "Exchange", "shuffleRecordsWritten")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert moved <= 40, moved  # of 120 matched items none is moved
    assert rows(got, "item_id", "campaign_id", "campaign_day") == sorted((f"i{n}", c, 35 if c == 1 else 4) for n in range(40) for c in range(3))


@pytest.mark.parametrize("plan", [catalogue.campaign_items, catalogue.campaign_day])
def test_matched_items_keep_only_the_last_shuffle(frame, spark, plan):
    """What the plan still holds, without broadcasts, is the shuffle by brand and day: those by order and by product are done and removed."""
    orders, items, windows, products = campaign_tables(frame, 3)
    many = frame([(f"i{n}", 2 - n % 2, "A1", 2) for n in range(40)], "item_id string, order_id long, variant_code string, quantity int")
    names = frame([("A1",)], "erp_code string")
    looked_up = many.join(names, many["variant_code"] == names["erp_code"], "left").drop("erp_code")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = plan(orders, looked_up, windows, products)
        text = got._jdf.queryExecution().executedPlan().toString()
        assert rows(got, "item_id", "campaign_id") == sorted((f"i{n}", c) for n in range(1, 40, 2) for c in range(3))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "hashpartitioning(slug_products" in text and not re.search(r"hashpartitioning\((order_id|product_code|variant_code)", text), text


def test_classified_products_are_not_shuffled_after_kinds_multiply_them(frame, spark):
    products = frame(
        [(n, "a", n % 3, "p") for n in range(100)] + [(100, "b", 1, "m"), (101, "a", None, "p"), (102, None, 1, None)],
        "product_id int, slug_products string, final_price int, size string",
    )
    kinds = frame([("a", f"k{i}") for i in range(20)] + [("a", "k1"), (None, "k1")], "slug_products string, treated_slug string")
    bands = frame([(f"k{i}", price, f"{i}-{price}") for i in range(20) for price in (0, 1)], "treated_slug string, final_price int, band string")
    sizes = frame([("p", 1), ("m", 2)], "size string, size_sort int")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = catalogue.classified_products(products, sizes, bands, kinds)
        moved = most_rows(got, "Exchange", "shuffleRecordsWritten")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert moved <= 103, moved
    expected = [(n, f"k{i}", f"{i}-{n % 3}" if n % 3 < 2 else None, 1) for n in range(100) for i in range(20)]
    expected += [(101, f"k{i}", None, 1) for i in range(20)] + [(100, None, None, 2), (102, None, None, None)]
    key = lambda r: tuple((v is None, str(v)) for v in r)
    assert rows(got, "product_id", "treated_slug", "band", "size_sort") == sorted(expected, key=key)
    assert got.columns == ["treated_slug", "final_price", "slug_products", "size", "product_id", "size_sort", "band"]


def test_final_items_are_joined_once(frame):
    """The sort draws its ranges from the joined rows, without joining them a second time."""
    head = frame([(1, 5, "delivered", t("2020-01-05 12:00")), (2, 5, "cancelled", t("2020-01-05 12:00"))], "id long, user_id long, state string, created_at timestamp")
    items = frame(
        [(o, f"{o}{n}", 3, 4, "x", 2.5, n, 0, 1, 0.5) for o in (2, 1) for n in (3, 2, 1)],
        "order_id long, id string, campaign_id long, variant_id long, name string, final_price double, quantity int, "
        "cancelled_quantity int, stockout_quantity int, shipping_price double",
    )
    got = orders.final_items(head, items, D(2020, 1, 1), D(2020, 1, 31))
    assert [tuple(r) for r in got.select("order_id", "item_id", "final_quantity", "basket_value", "final_value").collect()] == [
        (1, "12", 1, 2.5, 3.0), (1, "13", 2, 5.0, 5.5)]
    assert "Join" not in got._jdf.queryExecution().executedPlan().toString()


def test_items_of_orders_before_the_previous_month_need_no_unit_cost(frame):
    heads = frame(
        [(1, D(2020, 3, 1), "main"), (2, D(2020, 2, 1), "main"), (3, D(2020, 1, 1), "main"), (4, None, "main")],
        "order_id long, month date, unit string",
    )
    items = frame([(f"i{o}", o, "x", "A", 2) for o in (1, 2, 3, 4)],
                  "item_id string, order_id long, product_name string, variant_code string, quantity int")
    products = frame([("A", "E")], "variant_code string, erp_product_id string")
    stock = frame([(D(2020, m, 1), "E", "main", 10 * m) for m in (1, 2, 3)], "month date, erp_product_id string, unit string, unit_cost int")
    history = frame([(1, 7), (3, 8)], "order_id long, product_cost int")
    recent = margin.item_cost(costs.recent_heads(heads), items, products, stock)
    assert rows(recent, "order_id", "unit_cost") == [(1, 30), (2, 20)]
    got = margin.frozen_order_cost(heads, costs.product_costs(recent), history)
    every = margin.frozen_order_cost(heads, costs.product_costs(margin.item_cost(heads, items, products, stock)), history)
    assert rows(got) == rows(every)
    assert [(o, c and int(c)) for o, c in rows(got, "order_id", "product_cost")] == [(1, 7), (2, 40), (3, 8), (4, None)]
