"""Schemas of the raw shop tables, as DDL. Instants are UTC; money is decimal(18,4)."""

from __future__ import annotations

MONEY = "decimal(18,4)"

TABLES: dict[str, str] = {
    "orders": f"""id long, user_id long, masked_id string, external_id string, state string, status string,
        payment_status string, payment_method string, credit_card_operator string, installments int, origin int,
        utm_id long, coupon_id long, created_at timestamp, updated_at timestamp, delivered_at timestamp,
        shipping_price {MONEY}, captured_shipping_price {MONEY}, cached_total_value {MONEY}, cached_final_value {MONEY}, cached_credits {MONEY},
        shipping_period int, total_shipping_time int""",
    "order_items": f"""id string, order_id long, product_id long, variant_id long, campaign_id long, name string,
        quantity int, cancelled_quantity int, stockout_quantity int, final_price {MONEY}, original_price {MONEY},
        shipping_price {MONEY}, stockout_shipping_price {MONEY}, created_at timestamp, updated_at timestamp""",
    "campaigns": """id long, name string, slug string, brand_id long, offer_starts_at timestamp,
        offer_ends_at timestamp, inventory_type string, fast_delivery int, exclusive int, kids int, banner string,
        highlight string, created_at timestamp, updated_at timestamp""",
    "campaigns_products": f"""id long, product_id long, campaign_id long, stock int, sold int, active int,
        cost_price {MONEY}, icms {MONEY}, created_at timestamp, updated_at timestamp""",
    "products": f"""id long, parent_product_id long, name string, erp_code string, brand_id long,
        main_category_id long, category_id long, vertical_id long, gender_id long, subcategory_id long, age_id long,
        size_id long, supplier_size string, supplier_color string, original_price {MONEY}, final_price {MONEY},
        main_picture string, created_at timestamp, updated_at timestamp""",
    "brands": "id long, name string, slug string",
    "tags": "id long, type string, label string",
    "users": """id long, email string, first_name string, last_name string, gender string, subscribed int,
        birthdate date, utm_id long, origin int, main_address_id long, vip_since timestamp, created_at timestamp,
        most_recent_access timestamp""",
    "app_sessions": "user_id long, created_at timestamp, most_recent_access timestamp",
    "utms": "id long, source string, medium string, campaign string, term string, content string, gclid string",
    "categories": "id long, name string, slug string, parent_category long",
    "risk_analysis_results": """id long, order_id long, successful_past_order_rule int,
        maximum_order_value_rule int, maximum_of_purchase_on_period_rule int""",
    "order_transition_logs": "id long, from_state string, to_state string, order_id long, created_at timestamp",
    "tracking_infos": """id long, order_id long, tax_invoice_number string, shipping_company_name string,
        created_at timestamp""",
    "annotations": "id long, target_type string, target_id long, subject string, data string",
    "credits": f"""id long, order_id long, user_id long, value {MONEY}, credit_type string, used_at timestamp,
        invited_id long, cancelled_at timestamp, origin_id long""",
    "coupons": f"""id long, code string, value {MONEY}, user_constraint string, order_constraint string,
        channel_constraint string, enabled int, min_order_value {MONEY}, start_date timestamp, end_date timestamp""",
    "addresses": "id long, user_id long, neighborhood string, city string, state string",
}

# Source columns that are landed under another name.
RENAMED: dict[str, dict[str, str]] = {"order_transition_logs": {"from": "from_state", "to": "to_state"}}

# Column whose presence an extract demands in the source query.
EXTRACT_FILTERS: dict[str, str] = {"credits": "used_at IS NOT NULL"}

# Positional layouts of headerless text files.
WEB_EVENTS = ["date", "source", "medium", "campaign", "customer_id", "unique_events"]
WEB_TRANSACTIONS = ["date", "source", "medium", "campaign", "public_id", "_6", "_7", "revenue"]
