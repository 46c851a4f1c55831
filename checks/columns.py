"""Result columns of every registered query: `name:type` with types i (integer), d (date, shown as ISO
text), s (text), m (money, exact decimal shown as double) and f (double, rounded to six digits).

Both sides of a check are cast to these columns, so integer widths, decimal scales and date containers
of the two engines cannot differ.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.plans.margin import ITEM_HEADERS, ORDER_HEADERS, USER_HEADERS

UTM = "utm_source:s utm_campaign:s utm_medium:s utm_term:s utm_content:s utm_gclid:s"
BASE = "order_id:i public_id:s order_date:d month:d customer_id:i revenue:m"
COUNTED = "order_id:i state:s item_id:s product_id:i variant_id:i campaign_id:i quantity:i final_price:m"
TOTALS = (
    "original_order_value:m original_quantity:i final_cancelled_quantity:i final_stockout_quantity:i "
    "final_unsold_quantity:i final_quantity:i final_order_value:m"
)

COLUMNS = {
    # channels and users
    "source_groups": "source:s source_group:s",
    "utm_cube": "utm_id:i source:s medium:s campaign:s source_group:s",
    "users_cube": "user_id:i email:s gender:s is_opt_in:i email_subscription:s user_source:s user_medium:s "
    "user_campaign:s user_origin:s user_source_group:s register_date:d register_year:i register_cohort:s "
    "last_web_access_date:d web_access_cohort:s registered_via_app:i registered_via_mobile_browser:i "
    "registered_via_desktop:i accessed_via_web:i accessed_via_app:i last_app_access_date:d app_access_cohort:s",
    "users_buyer_flag": "user_id:i email:s is_buyer:i ftb_cohort:s",
    "non_buyers": "user_id:i email:s is_buyer:i",
    "vip_cohorts": "user_id:i vip_email:s utm_id:i origin:i vip_count:i vip_date:d vip_cohort:d vip_quarter:d",
    "users_with_address": "user_id:i email:s city:s state:s",
    "users_main_address": "user_id:i first_register_email:s first_register_date:d first_register_origin:i "
    "main_address_id:i city:s state:s",
    "customers_admin": f"customer_id:i email:s registered_on:d {UTM} opt_in:s gender:s city:s state:s",
    "customer_source": "customer_id:i customer_source:s customer_medium:s customer_campaign:s unit:s",
    "customers_states": "customer_id:i sex:s state:s region:s",
    # orders
    "order_items_cube": "order_id:i item_id:s campaign_id:i product_key:i quantity:i all_stockout_quantity:i "
    "all_cancelled_quantity:i original_item_value:m final_item_value:m final_item_quantity:i unsold_quantity:i",
    "order_items_plain": "order_id:i item_id:s final_item_value:m final_item_quantity:i unsold_quantity:i",
    "order_totals": f"order_id:i number_of_products:i {TOTALS}",
    "order_totals_by_state": f"order_id:i number_of_products:i {TOTALS}",
    "authorized_orders": "order_id:i user_id:i state:s order_date:d order_cohort:s order_year:i order_source:s "
    "order_medium:s order_campaign:s order_origin:s order_source_group:s via_app:i via_mobile_browser:i via_desktop:i "
    f"{TOTALS} is_considered_order:i is_billed_order:i",
    "orders_treated": "order_id:i user_id:i created_on:d order_month:d updated_on:d order_state:s consider:s "
    "order_utm_id:i basket_value:m shipping_value:m sales_value:m credit_value:m final_value:m order_origin:s "
    "coupon_id:i email:s register_date:d",
    "first_time_buyers": "user_id:i first_order_id:i first_order_date:d ftb_cohort:s ftb_count:i",
    "orders_is_ftb": "order_id:i user_id:i order_cohort:s is_ftb:i",
    "monthly_buyer_type": "user_id:i order_cohort:s orders:i is_ftb_in_month:i buyer_type:s",
    "ftb_report_users": "user_id:i first_order_id:i first_order_date:d ftb_month:d ftb_count:i register_date:d "
    "register_cohort:d vip_email:s vip_count:i vip_date:d vip_cohort:d vip_quarter:d",
    "ftb_report_orders": "order_id:i user_id:i created_on:d consider:s sales_value:m vip_date:d vip_cohort:d "
    "lifetime_vip:i ftb_cohort:d",
    "first_order_of_user": "user_id:i order_id:i state:s",
    "order_newest_version": "id:i user_id:i state:s cached_total_value:m",
    "orders_admin": "order_id:i public_id:s customer_id:i email:s erp_status:s payment_status_name:s order_value:m "
    f"items_value:m shipping_value:m {UTM} installments:i order_state:s credit_card_operator:s payment_method:s",
    "order_inclusion": "order_id:i order_state:s erp_status:s payment_status_name:s include_state:s "
    "include_erp_payment:s",
    "admin_items": "item_id:s order_id:i product_name:s quantity:i unit_price:m total_price:m final_price:m "
    "campaign_id:i product_code:s variant_code:s category:s",
    "orders_base": f"{BASE} order_year:i erp_status:s payment_status:s shipping_cost_shop:m {UTM} unit:s "
    "payment_form:s installments:i payment_confirmed:i order_state:s card_operator:s",
    "order_cardinal": "order_id:i customer_id:i order_date:d payment_confirmed:i cardinal:i cardinal_paid:i is_ftp:i "
    "is_ftp_paid:i",
    "order_cardinal_expected": "order_id:i customer_id:i cardinal:i is_ftp:i is_ftp_paid:i is_ftp_expected:f",
    "customer_milestones": "customer_id:i first_order_date:d first_paid_date:d orders:i register_date:d "
    "register_month:d register_year:i",
    "months_since_first": "order_id:i customer_id:i months_ftp:i months_ftp_paid:i",
    "conversion_snapshot": "unit:s day:d rate_1_30:f rate_91_120:f dif:f revenue:m",
    "conversion_history": "unit:s day:d dif:f revenue:m",
    "conversion_estimate": "order_id:i order_date:d revenue:m conversion_factor:f expected_revenue:f",
    "adhoc_monthly_totals": "month:i orders:i basket_value:m shipping:m",
    "adhoc_daily_sales": "order_date:d orders:i placed_basket_value:m placed_shipping:m placed_order_value:m "
    "captured_shipping:m origin:s",
    "adhoc_registrations": "year:i month:i origin:i users:i",
    "adhoc_final_items": "order_id:i user_id:i order_date:d state:s item_id:s campaign_id:i sku:i name:s "
    "final_price:m final_quantity:i basket_value:m item_shipping_price:m final_value:m",
    "adhoc_orders_by_utm": "masked_id:s order_date:d state:s origin:s utm_id:i placed_basket_value:m "
    "placed_shipping:m placed_order_value:m source:s campaign:s medium:s term:s gclid:s",
    "adhoc_distinct_products": "month:i products:i",
    "adhoc_users_with_utm": "date:d user_id:i source:s medium:s",
    # catalogue
    "products_dimension": "product_key:i parent_product_id:i sku_key:i age_group:s size:s supplier_size:s "
    "product_date:d product_month:s product_updated:d name:s product_original_price:m product_final_price:m erp_code:s "
    "supplier_color:s brand_id:i brand_name:s category:s segment:s gender:s subcategory:s",
    "sku_category": "product_id:i parent_product_id:i sku_key:i final_category:s",
    "campaigns_dimension": "campaign_id:i campaign_name:s campaign_slug:s start_year:i start_month:d starts:s "
    "end_year:i end_month:d ends:s campaign_type:s delivery_type:s",
    "campaign_stock": "campaign_id:i campaign_name:s product_id:i initial_stock:i",
    "active_campaign_products": "campaign_id:i month:s product_id:i",
    "active_campaigns_monthly": "month:s active_campaigns:i",
    "product_revenue_items": f"{COUNTED.replace('state:s ', '')} original_price:m shipping_price:m order_day:i order_month:i order_year:i "
    "day_label:s year_month:s month_year:s order_date:d campaign_product_key:s",
    "revenue_by_campaign": f"{COUNTED} user_id:i order_shipping_price:m cached_final_value:m campaign_name:s "
    "shipping_price:m order_date:d order_year_month:s updated_date:d",
    "campaign_product_list": "item_id:s variant_id:i campaign_id:i order_id:i erp_product_id:s erp_order_id:s "
    "order_date:d order_year_month:s campaign_name:s campaign_starts:d campaign_ends:d erp_key:s",
    "campaign_product_month_to_date": "erp_order_id:s erp_product_id:s campaign_id:i campaign_name:s "
    "campaign_starts:d campaign_ends:d",
    "campaign_brand": "campaign_id:i campaign_name:s treated_slug:s start_date:d end_date:d label:s label_short:s "
    "brand_id:i brand_name:s",
    "campaign_catalogue": "campaign_id:i slug_products:s treated_slug:s start_date:d start_day0:d end_date:d "
    "month_label:s month_sort:d title:s reference_brand:s brand_kind:s campaign_kind:s gender:s brand_folder:s",
    "campaign_export_flag": "campaign_id:i slug_products:s label:s campaign_kind:s end_date:d export_flag:i",
    "campaigns_without_reference": "campaign_id:i treated_slug:s end_date:d brand_id:i campaign_kind:s",
    "campaign_products": "campaign_id:i product_id:i stock:i slug_products:s product_code:s product_uid:s parent_code:i "
    "product_group:s color:s size:s list_price:m final_price:m product_kind:s product_gender:s name_treated:s",
    "campaign_products_classified": "campaign_id:i product_id:i slug_products:s size:s size_sort:i treated_slug:s final_price:m band:s",
    "size_order": "size:s size_sort:i",
    "campaign_kind_gender": "campaign_id:i slug_products:s treated_slug:s kind:s gender:s",
    "price_bands": "treated_slug:s final_price:m mean:f low:f high:f band:s",
    "campaign_items": "item_id:s order_id:i campaign_id:i slug_products:s product_code:s order_date:d quantity:i "
    "unit_value:m unit_list_value:m total:m",
    "campaign_day": "item_id:s campaign_id:i campaign_day:i",
    "campaign_orders": "order_id:i public_id:s include_state:s order_hour:i",
    "product_image": "product_id:i image:s",
    # margin
    "order_attribution": "order_id:i order_source:s order_medium:s order_campaign:s web_revenue:m",
    "channel_counts": "source:s medium:s campaign:s unit:s registrations:i",
    "channel_rules": "source:s medium:s campaign:s unit:s level1:s level2:s level3:s rule_no:i",
    "untreated_channels": "source:s medium:s campaign:s registrations:i",
    "channel_orders": "order_id:i order_source:s level1:s level2:s level3:s",
    "channel_customers": "customer_id:i customer_source:s level1:s level2:s level3:s",
    "shipping_adjust": "order_id:i shipping_cost_shop:m shipping_cost:m",
    "item_cost": "order_id:i month:d item_id:s variant_code:s quantity:i erp_product_id:s unit_cost:m",
    "frozen_order_cost": "order_id:i month:d product_cost:m",
    "new_cost_history": "order_id:i product_cost:m",
    "taxes": "order_id:i revenue_tax:m product_tax:m freight_tax:m",
    "payment_fee": "order_id:i payment_form:s installments:i payment_fee:m",
    "fraud_and_gateway": "order_id:i fraud_fee:m gateway_fee:m",
    "packaging_share": "order_id:i packaging:f",
    "fulfilment_share": "order_id:i fulfilment_staff:f fulfilment_warehouse:f production_staff:f production_studios:f",
    "real_freight": "order_id:i erp_order_id:s invoice_id:i invoice_number:s shipping_cost:m freight:m",
    "order_margin": "order_id:i month:d unit:s payment_form:s revenue:m product_cost:m revenue_tax:m product_tax:m freight_tax:m "
    "payment_fee:m fraud_fee:m gateway_fee:m packaging:f fulfilment_staff:f fulfilment_warehouse:f production_staff:f "
    "production_studios:f freight:m margin_with_fulfilment:m margin_without_fulfilment:m order_cost:f margin:f",
    "invoices": "erp_order_id:s order_id:s total_value:m basket_value:m shipping_value:m invoice_date:d "
    "invoice_number:s tax_id:s erp_email:s",
    # sources and sinks
    "landed_orders": "id:i user_id:i state:s cached_total_value:m created_on:d",
    "web_events_from_files": "date:d source:s medium:s campaign:s customer_id:i unique_events:i",
    "conversion_snapshot_stored": "unit:s day:d rate_1_30:f rate_91_120:f dif:f revenue:m",
    # service
    "delivery_dates": "order_id:i order_date:d state:s erp_id:s shipping_date:d communicated_date:d estimated_date:d "
    "actual_date:d delivery_status:s best_date:d original_order_value:m final_quantity:i final_order_value:m order_count:i",
    "risk_rules": "order_id:i rule:s rule_name:s rule_applies:s ftp:s order_date:d order_cohort:s external_id:s",
    "risk_final_list": "order_id:i final_list:s risk_analysis_data:i",
    "nps_groups": "response_id:i email:s answer_date:d answer_month:d score:i nps_group:s customer_id:i last_30_days:i",
    "credits": "credit_id:i date_used:d month_used:d credit_value:i credit_type:s invited_id:i order_id:i "
    "cancelled_on:d origin_id:i",
    "orders_with_coupon": "order_id:i user_id:i order_date:d order_month:d consider:s coupon_id:i code:s value:m "
    "coupon_percent:m coupon_value:m",
    "sales_metrics": "campaign_id:i gross_quantity:i liquid_quantity:i basket_value:m sales_value:m deepest_discount:f "
    "total_value:m",
    # lifecycle
    "ltv_curve": "distance:i revenue:m users:i ltv:f ltv_previous:f ltv_ratio:f",
    "ltv_summary": "first_ratio:f mean_ratio:f",
    "contribution_margin": "order_id:i margin_with_fulfilment:m margin_without_fulfilment:m",
    "email_send_summary": "email_name:s email_date:d email_type:s unit:s sends:i deliveries:i opens:i clicks:i "
    "unsubscribes:i visits:i transactions:i revenue:m email_month:d email_year:i",
    "email_engagement": "customer_id:i unsubscribed:s opened:s last_open:d open_age:i open_band:s",
    "marketing_spend": "month:d name:s purpose:s payment:s channel:s unit:s value:m",
    "rfm_score": "customer_id:i revenue:m frequency:i recency:d r_class:i f_class:i m_class:i score:i is_vip:s",
    "optin_active": "customer_id:i is_opt_in:i is_active:i paid_orders:i first_paid_order_date:d",
    "days_since_previous_order": "order_id:i customer_id:i cardinal:i days_since_previous:i",
    "acquisition_cost": "month:d unit:s channel:s cost:m",
    "client_segments": "unit:s total:i opt_in:i opt_out:i buyers:i never_bought:i never_bought_active:i "
    "never_bought_inactive:i ftb:i ftb_active:i ftb_inactive:i vip:i vip_active:i vip_inactive:i repeat:i "
    "repeat_active:i repeat_inactive:i",
    "churn_snapshot": "churn_date:d level1:s level2:s level3:s unit:s customers:i active_opt_in:i active_opt_out:i "
    "inactive_opt_in:i inactive_opt_out:i",
    "rfm_export": "unit:s email:s customer_id:i register_date:d first_order_date:d level1:s level2:s score:i is_vip:s "
    "recency:d frequency:i revenue:m r_class:i f_class:i m_class:i",
    "orders_cardinal_export": "customer_id:i email:s register_date:d order_id:i public_id:s order_date:d "
    "payment_confirmed:s cardinal:i cardinal_paid:i days_since_previous:i order_source:s order_medium:s "
    "order_campaign:s card_operator:s installments:i revenue:m erp_status:s",
}
COLUMNS["invoices_from_files"] = COLUMNS["invoices"]
COLUMNS["churn_snapshot_stored"] = COLUMNS["churn_snapshot"]

EXPORT_TYPES = {
    "order_id": "i", "customer_id": "i", "campaign_id": "i", "installments": "i", "quantity": "i", "order_value": "m",
    "items_value": "m", "shipping_value": "m", "unit_price": "m", "total_price": "m", "final_price": "m",
}
EXPORTS = {"export_orders": ORDER_HEADERS, "export_items": ITEM_HEADERS, "export_users": USER_HEADERS}


def parsed(name: str) -> list[tuple[str, str]]:
    if name in EXPORTS:
        return [(header, EXPORT_TYPES.get(column, "s")) for column, header in EXPORTS[name].items()]
    return [tuple(part.rsplit(":", 1)) for part in COLUMNS[name].split()]


def shown(df: DataFrame, name: str) -> DataFrame:
    """The result cast to the declared columns."""
    casts = {
        "i": lambda c: c.cast("bigint"), "d": lambda c: c.cast("date").cast("string"), "s": lambda c: c.cast("string"),
        "m": lambda c: c.cast("decimal(28,4)").cast("double"), "f": lambda c: F.round(c.cast("double"), 6),
    }
    return df.select(*[casts[kind](F.col(f"`{column}`")).alias(column) for column, kind in parsed(name)])


def shown_sql(name: str, source: str) -> str:
    casts = {
        "i": "CAST({0} AS BIGINT)", "d": "CAST(CAST({0} AS DATE) AS VARCHAR)", "s": "CAST({0} AS VARCHAR)",
        "m": "CAST(CAST({0} AS DECIMAL(28,4)) AS DOUBLE)", "f": "round(CAST({0} AS DOUBLE), 6)",
    }
    body = ", ".join(f"""{casts[kind].format(f'"{column}"')} AS "{column}\"""" for column, kind in parsed(name))
    return f"SELECT {body} FROM {source}"
