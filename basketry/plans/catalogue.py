"""Products and campaigns."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.dates import (
    campaign_month_label, local_date, local_ts, month_label, month_label_reversed, month_start, same_month,
)
from basketry.functions.numbers import ratio
from basketry.functions.text import cut_size_suffix, differs, keep_chars, recode, slug
from basketry.operators.grouping import first_by
from basketry.operators.intervals import interval_match
from basketry.operators.joins import KEY, anti, full_on, has_key, left_many, lookup, natural_left, semi, star_lookup
from basketry.operators.ranking import rank_rows
from basketry.plans.orders import with_consider
from basketry.session import drop_stage, stage_table

NONE = "none"

# Characters allowed in a campaign title.
TITLE_CHARS = (
    "abcdefghijklmnopqrstuvwxyz0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ_"
    "áéíóúÁÉÍÓÚãõÃÕàÀâêîôûÂÊÎÔÛçÇ &()äëïöüÄËÏÖÜ.\\-"
)
# Campaign kinds that are never exported.
SPECIAL_KINDS = ["especial", "super sale", "conceito"]


# ---------------------------------------------------------------- products

def with_sku_key(products: DataFrame) -> DataFrame:
    """Variants under their parent's key, and products that neither have nor are a parent."""
    parents = products.select("parent_product_id")
    marked = has_key(products, parents, "id", "__is_parent", table_key="parent_product_id")
    kept = marked.where(F.col("parent_product_id").isNotNull() | (F.col("__is_parent") == 0))
    return kept.withColumn("sku_key", F.coalesce("parent_product_id", "id")).drop("__is_parent")


#: Label -> id column, of the product row itself and of the parent's row (brand, category, segment, gender, subcategory).
OWN_LABELS = {"age_group": "age_id", "size": "size_id"}
GROUP_LABELS = {"category": "category_id", "segment": "vertical_id", "gender": "gender_id", "subcategory": "subcategory_id"}


def product_families(products: DataFrame) -> DataFrame:
    """Per product id: the ids that its variants take from it, if it exists, and if it has variants.

    Each product plays two parts, as itself and as a child of its parent, so one aggregation replaces two joins.
    """
    ids = ["brand_id", *GROUP_LABELS.values()]

    def part(key: str, own: bool) -> Column:
        given = [(F.col(c) if own else F.when(F.lit(False), F.col(c))).alias(c) for c in ids]
        return F.struct(F.col(key).alias("sku_key"), F.lit(own).alias("exists"), F.lit(not own).alias("has_variants"), *given)

    parts = products.select(F.explode(F.array(part("id", True), part("parent_product_id", False))).alias("part"))
    return parts.select("part.*").where("sku_key is not null").groupBy("sku_key").agg(
        F.max("exists").alias("parent_exists"), F.max("has_variants").alias("has_variants"), *[F.max(c).alias(f"parent_{c}") for c in ids]
    )


def products_dimension(products: DataFrame, tags: DataFrame, brands: DataFrame) -> DataFrame:
    """Variants and single products with their own labels and their parent's group columns.

    A label is `none` when its tag or brand does not exist, and null when the parent does not.
    """
    day = local_date("created_at")
    keyed = products.withColumn("sku_key", F.coalesce("parent_product_id", "id"))
    kept = natural_left(keyed, product_families(products), "sku_key").where(
        F.col("parent_product_id").isNotNull() | ~F.col("has_variants")
    ).select(
        F.col("id").alias("product_key"), "parent_product_id", "sku_key", "supplier_size", day.alias("product_date"),
        month_label_reversed(day).alias("product_month"), local_date("updated_at").alias("product_updated"), "name",
        F.col("original_price").alias("product_original_price"), F.col("final_price").alias("product_final_price"),
        "erp_code", "supplier_color", "parent_exists", F.col("parent_brand_id").alias("brand_id"),
        *OWN_LABELS.values(), *[f"parent_{c}" for c in GROUP_LABELS.values()],
    )
    entries = tags.select(F.lit("tag").alias("kind"), "id", "label").unionByName(
        brands.select(F.lit("brand").alias("kind"), "id", F.col("name").alias("label"))
    )
    wanted = {out: ("tag", column) for out, column in OWN_LABELS.items()}
    wanted |= {"brand_name": ("brand", "brand_id")} | {out: ("tag", f"parent_{column}") for out, column in GROUP_LABELS.items()}
    labelled = star_lookup(kept, "product_key", entries, wanted, NONE)
    return labelled.withColumns(
        {out: F.when(F.col("parent_exists"), F.col(out)) for out in ("brand_name", *GROUP_LABELS)}
    ).drop("parent_exists", *OWN_LABELS.values(), *[f"parent_{c}" for c in GROUP_LABELS.values()])


def sku_category(products: DataFrame, category_table: DataFrame) -> DataFrame:
    """Product to SKU key with its final category."""
    keyed = with_sku_key(products).select(F.col("id").alias("product_id"), "parent_product_id", "sku_key")
    categories = category_table.select(F.col("id").alias("product_id"), "final_category")
    return natural_left(keyed, categories, "product_id")


def product_image(products: DataFrame) -> DataFrame:
    """One picture per product that has any."""
    return products.where(F.col("main_picture").isNotNull()).groupBy("id").agg(
        F.min("main_picture").alias("image")
    ).withColumnRenamed("id", "product_id")


# ---------------------------------------------------------------- campaigns

def campaigns_dimension(campaigns: DataFrame, inventory: dict[str, str], delivery: dict[int, str]) -> DataFrame:
    """Campaign with local start and end, inventory and delivery label."""
    start, end = local_date("offer_starts_at"), local_date("offer_ends_at")
    return campaigns.select(
        F.col("id").alias("campaign_id"), F.col("name").alias("campaign_name"), F.col("slug").alias("campaign_slug"),
        F.year(start).alias("start_year"), month_start(start).alias("start_month"),
        F.date_format(start, "MM/dd").alias("starts"), local_ts("offer_starts_at").alias("starts_at"),
        F.year(end).alias("end_year"), month_start(end).alias("end_month"),
        F.date_format(end, "MM/dd").alias("ends"), local_ts("offer_ends_at").alias("ends_at"),
        recode("inventory_type", inventory, "noinventorytype").alias("campaign_type"),
        recode("fast_delivery", delivery, "nodeliverytype").alias("delivery_type"),
    )


def campaign_stock(campaigns: DataFrame, campaigns_products: DataFrame) -> DataFrame:
    """Campaign x product with the initial stock; a campaign without products keeps one row."""
    stock = campaigns_products.select("campaign_id", "product_id", F.col("stock").alias("initial_stock"))
    return left_many(campaigns, stock, "campaign_id")


def campaign_months(campaigns: DataFrame) -> DataFrame:
    """Start month and end month of each campaign, as text; `Null` without a start.

    The months in between are not counted.
    """
    has_start = F.col("offer_starts_at").isNotNull()

    def months(column: str) -> DataFrame:
        label = F.when(has_start, month_label(local_date(column))).otherwise("Null")
        return campaigns.select(F.col("id").alias("campaign_id"), label.alias("month"))

    return months("offer_starts_at").unionByName(months("offer_ends_at"))


def active_campaign_products(campaigns: DataFrame, campaigns_products: DataFrame) -> DataFrame:
    """Products of the campaigns active per month, each combination once."""
    products = campaigns_products.select("campaign_id", "product_id").distinct()
    return left_many(campaign_months(campaigns).distinct(), products, "campaign_id")


def active_campaigns_monthly(campaigns: DataFrame) -> DataFrame:
    """Distinct active campaigns per month. Products play no part in the count, so none are joined."""
    return campaign_months(campaigns).groupBy("month").agg(
        F.count_distinct("campaign_id").alias("active_campaigns")
    )


def counted_order_items(orders: DataFrame, items: DataFrame, state_map: DataFrame) -> DataFrame:
    """Orders whose state is not mapped to `no`, each with its items (or one row without an item)."""
    counted = with_consider(orders, state_map).where(differs("consider", "no")).select(
        F.col("id").alias("order_id"), "state", "user_id", "cached_final_value", "cached_total_value",
        "cached_credits", "coupon_id", F.col("shipping_price").alias("order_shipping_price"),
    )
    lines = items.select(
        "order_id", F.col("id").alias("item_id"), "product_id", "variant_id", "campaign_id",
        F.col("name").alias("product_name"), "quantity", "cancelled_quantity", "stockout_quantity", "final_price",
        "original_price", "shipping_price", "created_at", "updated_at",
    )
    return left_many(counted, lines, "order_id")


def product_revenue_items(orders: DataFrame, items: DataFrame, state_map: DataFrame) -> DataFrame:
    """Items of counted orders with date parts and the campaign-product key."""
    day = local_date("created_at")
    return counted_order_items(orders, items, state_map).select(
        "item_id", "order_id", "product_id", "product_name", "variant_id", "campaign_id", "quantity", "final_price",
        "original_price", "cancelled_quantity", "stockout_quantity", "shipping_price",
        F.dayofmonth(day).alias("order_day"), F.month(day).alias("order_month"), F.year(day).alias("order_year"),
        F.date_format(day, "MM/dd").alias("day_label"), month_label(day).alias("year_month"),
        month_label_reversed(day).alias("month_year"), day.alias("order_date"),
        F.when(F.col("campaign_id").isNotNull() & F.col("variant_id").isNotNull(),
               F.concat_ws("|", "campaign_id", "variant_id")).alias("campaign_product_key"),
    )


def revenue_by_campaign(
    orders: DataFrame, items: DataFrame, campaigns: DataFrame, state_map: DataFrame
) -> DataFrame:
    """Counted orders with items, campaign name (the id itself when unknown) and local dates."""
    lines = counted_order_items(orders, items, state_map).withColumn("campaign_key", F.col("campaign_id").cast("string"))
    names = campaigns.select(F.col("id").cast("string").alias("campaign_key"), "name")
    named = lookup(lines, names, "campaign_key", {"campaign_name": ("name", KEY)}, unique=True)
    day = local_date("created_at")
    return named.select(
        "order_id", "state", "user_id", "order_shipping_price", "cached_final_value", "cached_total_value",
        "cached_credits", "coupon_id", "item_id", "product_id", "variant_id", "quantity", "final_price",
        "shipping_price", "campaign_id", "campaign_name", "cancelled_quantity", "stockout_quantity",
        day.alias("order_date"), month_label(day).alias("order_year_month"),
        local_date("updated_at").alias("updated_date"),
    )


def campaign_product_list(
    items: DataFrame, orders: DataFrame, campaigns: DataFrame, products: DataFrame
) -> DataFrame:
    """Item with ERP ids of order and product and the window of its campaign."""
    coded = lookup(
        items.select(F.col("id").alias("item_id"), "variant_id", "campaign_id", "order_id"), products, "variant_id",
        {"erp_product_id": ("erp_code", "no id")}, table_key="id", unique=True,
    )
    heads = orders.select(
        F.col("id").alias("order_id"), F.col("external_id").alias("erp_order_id"),
        local_date("created_at").alias("order_date"), month_label(local_date("created_at")).alias("order_year_month"),
    )
    windows = campaigns.select(
        F.col("id").alias("campaign_id"), F.col("name").alias("campaign_name"),
        local_date("offer_starts_at").alias("campaign_starts"), local_date("offer_ends_at").alias("campaign_ends"),
    )
    joined = natural_left(natural_left(coded, heads, "order_id"), windows, "campaign_id")
    both = F.col("erp_order_id").isNotNull() & F.col("erp_product_id").isNotNull()
    return joined.withColumn("erp_key", F.when(both, F.concat_ws("|", "erp_order_id", "erp_product_id")))


def campaign_product_month_to_date(listed: DataFrame, as_of: dt.date) -> DataFrame:
    """Export of the rows ordered in the month of the run day."""
    return listed.where(same_month("order_date", as_of)).select(
        "erp_order_id", "erp_product_id", "campaign_id", "campaign_name", "campaign_starts", "campaign_ends"
    )


# ---------------------------------------------------------------- campaign catalogue

def treated_slug(column: str = "slug") -> Column:
    """Slug up to the first double dash, dashes as spaces."""
    return F.replace(F.split_part(column, F.lit("--"), F.lit(1)), F.lit("-"), F.lit(" "))


def campaign_brand(
    campaigns: DataFrame, campaigns_products: DataFrame, products: DataFrame, brands: DataFrame
) -> DataFrame:
    """Campaign with its brand, else with each brand of its products; labels and treated slug.

    Only products of campaigns without a brand are looked at, and they are reduced to distinct
    (campaign, product) pairs before the product join.
    """
    open_ids = campaigns.where(F.col("brand_id").isNull()).select(F.col("id").alias("campaign_id"))
    pairs = semi(campaigns_products.select("campaign_id", "product_id"), open_ids, "campaign_id").distinct()
    product_brands = pairs.join(
        products.where(F.col("brand_id").isNotNull()).select(F.col("id").alias("product_id"), F.col("brand_id").alias("product_brand")),
        "product_id",
    ).select("campaign_id", "product_brand").distinct()
    day = F.to_date("offer_starts_at")
    rows = natural_left(campaigns.withColumnRenamed("id", "campaign_id"), product_brands, "campaign_id").select(
        "campaign_id", F.col("name").alias("campaign_name"), F.col("slug").alias("campaign_slug"),
        treated_slug().alias("treated_slug"), day.alias("start_date"),
        F.to_date("offer_ends_at").alias("end_date"), "highlight", "banner",
        F.concat_ws(" - ", "name", campaign_month_label(day)).alias("label"),
        F.concat_ws(" ", "name", F.date_format(day, "MM.yy")).alias("label_short"),
        F.coalesce("brand_id", "product_brand").alias("brand_id"),
    )
    return lookup(rows, brands, "brand_id", {"brand_name": ("name", None)}, table_key="id", unique=True)


REFERENCE = {"brand": "reference_brand", "brand_kind": "brand_kind", "campaign_kind": "campaign_kind", "gender": "gender"}


def reference_rows(reference: DataFrame) -> DataFrame:
    """Latest row per (treated slug, slug) of the hand-kept reference sheet, texts trimmed."""
    keyed = reference.withColumns({"treated_slug": F.trim("treated_slug"), "slug": F.trim("slug")})
    latest = first_by(keyed, ["treated_slug", "slug"], ["row_no"], [*REFERENCE, "exported"], latest=True)
    return latest.withColumns({c: F.trim(c) for c in [*REFERENCE, "exported"]})


def campaign_catalogue(
    campaigns: DataFrame, reference: DataFrame, since: dt.date, *, drop_not_available: bool = True
) -> DataFrame:
    """Campaigns started since a day, with day zero, label, title and the reference row of their slug."""
    chosen = first_by(
        reference_rows(reference), "treated_slug", ["slug"], {out: c for c, out in REFERENCE.items()}
    )
    rows = campaigns.where(F.col("start_date") >= F.lit(since)).select(
        "campaign_id", slug("brand_name").alias("slug_products"), "brand_name", "campaign_name", "treated_slug",
        "start_date", F.date_sub("start_date", 1).alias("start_day0"), "end_date", "highlight", "banner",
        campaign_month_label("start_date").alias("month_label"), month_start("start_date").alias("month_sort"),
        "label", "label_short",
    ).withColumn("title", keep_chars(F.concat_ws(" - ", "campaign_name", "month_label"), TITLE_CHARS))
    joined = natural_left(rows, chosen, "treated_slug").withColumn(
        "brand_folder", keep_chars("reference_brand", TITLE_CHARS)
    )
    if not drop_not_available:
        return joined
    return joined.where(differs("reference_brand", "NA") & differs("brand_kind", "NA"))


def last_full_order_day(orders: DataFrame) -> Column:
    """The day before the newest order day, as a scalar subquery."""
    return orders.agg(F.date_sub(F.to_date(F.max("created_at")), 1).alias("day")).scalar()


def campaign_export_flag(catalogue: DataFrame, skip_list: DataFrame, orders: DataFrame) -> DataFrame:
    """1 for campaigns that are over, not of a special kind and not on the skip list."""
    skipped = skip_list.select(slug("label").alias("__slug")).distinct().withColumn("__skip", F.lit(1))
    joined = natural_left(catalogue.withColumn("__slug", slug("label")), skipped, "__slug")
    kinds = [differs("campaign_kind", kind) for kind in SPECIAL_KINDS]
    ready = (
        F.col("__skip").isNull() & (F.col("end_date") <= last_full_order_day(orders)) & kinds[0] & kinds[1] & kinds[2]
    )
    return joined.withColumn("export_flag", F.when(ready, 1).otherwise(0)).drop("__slug", "__skip")


def campaigns_without_reference(campaigns: DataFrame, reference: DataFrame, orders: DataFrame) -> DataFrame:
    """Finished campaigns whose (treated slug, slug) has no reference row: the list to fill in by hand."""
    known = reference_rows(reference).select("treated_slug", F.col("slug").alias("campaign_slug"))
    missing = anti(campaigns, known, ["treated_slug", "campaign_slug"])
    return missing.where(F.col("end_date") <= last_full_order_day(orders)).select(
        "campaign_id", "campaign_name", "campaign_slug", "treated_slug", "start_date", "end_date", "brand_id",
        F.when(F.col("brand_name").isNull(), "vazio").otherwise("single brand").alias("campaign_kind"),
    )


def campaign_products(
    campaigns_products: DataFrame, dimension: DataFrame, catalogue: DataFrame
) -> DataFrame:
    """Stock per campaign and product with cleaned attributes, for brands that have a campaign."""
    stock = campaigns_products.groupBy("campaign_id", "product_id").agg(F.sum("stock").alias("stock"))
    brand_slug = slug("brand_name")
    known = dimension.withColumn("slug_products", brand_slug)
    known = semi(known, catalogue.select("slug_products"), "slug_products").select(
        F.col("product_key").alias("product_id"), "slug_products", F.trim("erp_code").alias("product_code"),
        F.concat_ws("_", "slug_products", F.trim("erp_code")).alias("product_uid"),
        F.col("parent_product_id").alias("parent_code"), F.trim("name").alias("name_original"),
        F.coalesce(F.trim(F.initcap("subcategory")), F.lit("Sem Categoria")).alias("product_group"),
        F.trim("supplier_color").alias("color"), F.upper("supplier_size").alias("size"),
        F.col("product_original_price").alias("list_price"), F.col("product_final_price").alias("final_price"),
        F.trim(F.concat_ws(" ", "category", "segment")).alias("product_kind"), F.trim("gender").alias("product_gender"),
        cut_size_suffix("name").alias("name_treated"),
    )
    return stock.join(known, "product_id", "inner")


def size_order(size_list: DataFrame, products: DataFrame) -> DataFrame:
    """Every size once: listed sizes in their order, then unknown sizes alphabetically.

    Sizes are the suppliers' free text, so the numbering does not assume a small vocabulary.
    """
    listed = size_list.groupBy(F.upper("size").alias("size")).agg(F.min("row_no").alias("row_no"))
    found = products.select("size").where("size is not null").distinct()
    order = [F.col("row_no").asc_nulls_last(), F.col("size").asc()]
    return rank_rows(full_on(listed, found, "size"), order, "size_sort").select("size", "size_sort")


def campaign_kind_gender(catalogue: DataFrame, products: DataFrame, cutoff: dt.date) -> DataFrame:
    """Kind and gender from the reference row before the cut-off month, from the products after it.

    Campaigns whose brand has no campaign product are dropped.
    """
    firsts = first_by(
        products, "slug_products", ["product_id", "campaign_id"],
        {"kind_by_products": "product_kind", "gender_by_products": "product_gender"},
    )
    joined = catalogue.join(firsts, "slug_products", "inner")
    early = month_start("start_date") < F.lit(cutoff)
    return joined.select(
        "campaign_id", "slug_products", "treated_slug", "start_date",
        F.when(early, F.col("brand_kind")).otherwise(F.col("kind_by_products")).alias("kind"),
        F.when(early, F.col("gender")).otherwise(F.col("gender_by_products")).alias("gender"),
    )


# ---------------------------------------------------------------- price bands

def band_label(price: Column, low: Column, mean: Column, high: Column) -> Column:
    """Band text of a price given the mean below (low), the mean and the mean above (high)."""
    whole = lambda c: c.cast("long").cast("string")
    below = lambda c: (c - 0.01).cast("decimal(18,2)").cast("string")

    def under(limit: Column) -> Column:
        return F.concat(F.lit("Abaixo de R$"), below(limit))

    def between(start: Column, end: Column) -> Column:
        return F.concat(F.lit("R$"), whole(start), F.lit("-"), below(end))

    def over(limit: Column) -> Column:
        return F.concat(F.lit("R$"), whole(limit), F.lit("+"))

    exact = F.concat(F.lit("R$"), price.cast("decimal(18,2)").cast("string"))
    no_low = F.when(price < mean, under(mean)).when(price < high, between(mean, high)).otherwise(over(high))
    no_high = F.when(price < low, under(low)).when(price < mean, between(low, mean)).otherwise(over(mean))
    both = (
        F.when(price < low, under(low)).when(price < mean, between(low, mean))
        .when(price < high, between(mean, high)).otherwise(over(high))
    )
    return (
        F.when(low.isNull() & high.isNull(), exact).when(low.isNull(), no_low).when(high.isNull(), no_high)
        .otherwise(both)
    )


def price_bands(products: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Band of every price of a campaign kind (treated slug), computed from its newest campaign.

    Products are first summed per brand and price, so a kind shrinks to its distinct price points however many rows it has.
    The means are sums per kind, combined on the map side and joined back, so a kind is never one task's.
    """
    priced = products.groupBy("slug_products", "final_price").agg(F.sum("stock").alias("stock"))
    brands = catalogue.groupBy("treated_slug", "slug_products").agg(F.max("campaign_id").alias("campaign_id"))
    newest = brands.groupBy("treated_slug").agg(F.max_by("slug_products", F.struct("campaign_id", "slug_products")).alias("newest_slug"))
    marked = brands.join(*of_kind(newest, brands)).withColumn(
        "is_newest", F.col("slug_products").eqNullSafe(F.col("newest_slug"))).drop("kind", "newest_slug")
    points = stage_table(marked.join(priced, "slug_products").groupBy("treated_slug", "final_price").agg(
        F.sum(F.when(F.col("is_newest"), F.col("stock"))).alias("stock")
    ))
    price = F.col("final_price").cast("double")

    def mean_where(condition: Column) -> Column:
        value = F.sum(F.when(condition, F.col("final_price") * F.col("stock")))
        return F.round(ratio(value, F.sum(F.when(condition, F.col("stock")))), 0)

    means = points.groupBy("treated_slug").agg(mean_where(F.lit(True)).alias("mean"))
    sides = points.join(*of_kind(means, points)).groupBy("treated_slug").agg(
        F.max("mean").alias("mean"), mean_where(price < F.col("mean")).alias("low"), mean_where(price > F.col("mean")).alias("high")
    )
    return points.join(*of_kind(sides, points)).select(
        "treated_slug", "final_price", "mean", "low", "high", band_label(price, F.col("low"), F.col("mean"), F.col("high")).alias("band")
    )


def of_kind(per_kind: DataFrame, rows: DataFrame) -> tuple[DataFrame, Column]:
    """The table and condition that join one row per treated slug to rows; a missing slug is a kind of its own."""
    renamed = per_kind.withColumnRenamed("treated_slug", "kind")
    return renamed, rows["treated_slug"].eqNullSafe(renamed["kind"])


def classified_products(products: DataFrame, sizes: DataFrame, bands: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Campaign products with the number of their size and the price band of each campaign kind of their brand.

    A brand with several kinds gives a row per kind. Kinds and bands meet the distinct (brand, price) points of the products, and
    products join the labelled points, so rows are shuffled before kinds multiply them and not again after.
    """
    kinds = catalogue.select("slug_products", "treated_slug").distinct()
    sized = natural_left(products, sizes.select("size", "size_sort"), "size")
    points = left_many(products.select("slug_products", "final_price").distinct(), kinds, "slug_products")
    labelled = natural_left(points, bands.select("treated_slug", "final_price", "band"), ["treated_slug", "final_price"]).select(
        F.col("slug_products").alias("point_slug"), F.col("final_price").alias("point_price"), "treated_slug", "band"
    )
    # Every product has its point, also without a brand or a price.
    of_point = sized["slug_products"].eqNullSafe(labelled["point_slug"]) & sized["final_price"].eqNullSafe(labelled["point_price"])
    keys = ["treated_slug", "final_price", "slug_products"]
    return sized.join(labelled, of_point, "inner").select(*keys, *[c for c in sized.columns if c not in keys], "band")


# ---------------------------------------------------------------- items matched to campaigns

#: Turns in which items are looked up; each has its share of the orders on the way at once.
TURNS = 2


def included_orders(orders: DataFrame) -> DataFrame:
    """Id and day of the orders to be included, staged, as items and campaigns both meet them. `orders` carries `include_state`."""
    return stage_table(orders.where(F.col("include_state") == "Sim").select("order_id", F.to_date("created_at").alias("order_date")))


def dated_items(included: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """Items of campaign products in included orders, with the order day, the product's prices and the total.

    Items of other orders go first: the semi join sinks below the lookups that `items` was made by. Items are staged twice on
    their way, the first time in TURNS parts, and prices once, so the disks hold the shuffles of one step and not those of all.
    """
    prices = stage_table(first_by(
        products.where(F.col("product_code").isNotNull()), ["product_code", "slug_products"], ["product_id"],
        {"unit_value": "final_price", "unit_list_value": "list_price"},
    ))
    turn_of = F.pmod(F.xxhash64("order_id"), F.lit(TURNS))
    parts = [
        stage_table(semi(items.where(turn_of == turn), included, "order_id").select(
            "item_id", "order_id", F.col("variant_code").alias("product_code"), "quantity"))
        for turn in range(TURNS)
    ]
    lines = reduce(DataFrame.unionByName, parts)
    dated = stage_table(lines.join(included, "order_id", "inner").join(prices, "product_code", "inner"))
    for done in (*parts, prices):
        drop_stage(done)
    return dated.withColumn("total", F.col("unit_value") * F.col("quantity"))


def open_days(included: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Each campaign once per day that it was open and an included order was placed, with its brand."""
    days = included.select("order_date").distinct()
    windows = catalogue.select("campaign_id", "slug_products", "start_day0", "end_date").distinct()
    matched = interval_match(days, "order_date", windows, "start_day0", "end_date")
    return matched.select("slug_products", "order_date", "campaign_id")


MATCHED = [
    "item_id", "order_id", "campaign_id", "slug_products", "product_code", "order_date", "quantity", "unit_value", "unit_list_value", "total",
]


def campaign_items(
    orders: DataFrame, items: DataFrame, catalogue: DataFrame, products: DataFrame
) -> DataFrame:
    """Item matched to each campaign that was open on the order day and has the item's product.

    Days, not items, are matched to the windows; items then meet the campaigns by equality on (brand, day). So a row of
    the last join is a row of the result, with no candidates to test.
    """
    included = included_orders(orders)
    dated, opened = dated_items(included, items, products), open_days(included, catalogue)
    return dated.join(opened, ["slug_products", "order_date"], "inner").select(*MATCHED)


def campaign_day(
    orders: DataFrame, items: DataFrame, catalogue: DataFrame, products: DataFrame
) -> DataFrame:
    """Matched items (see `campaign_items`) with the day of the campaign on which they were ordered.

    Day zero is the day before the start. The number belongs to the campaign and the day, so it is worked out before the
    items multiply them, and the matched items meet no further join.
    """
    zero = catalogue.groupBy("campaign_id").agg(F.min("start_day0").alias("start_day0"))
    included = included_orders(orders)
    numbered = natural_left(open_days(included, catalogue), zero, "campaign_id").withColumn(
        "campaign_day", F.datediff("order_date", "start_day0")
    )
    return dated_items(included, items, products).join(numbered, ["slug_products", "order_date"], "inner").select(*MATCHED, "campaign_day")


def campaign_orders(
    orders: DataFrame, items: DataFrame, catalogue: DataFrame, products: DataFrame
) -> DataFrame:
    """Orders that kept at least one matched item (see `campaign_items`), with the hour of their creation.

    An item is kept as soon as one campaign of its brand was open on its day, so it is not multiplied by those campaigns.
    """
    included = included_orders(orders)
    kept = semi(dated_items(included, items, products), open_days(included, catalogue), ["slug_products", "order_date"])
    return semi(orders, kept, "order_id").withColumn("order_hour", F.hour("created_at"))
