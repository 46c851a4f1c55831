import datetime as dt

from pyspark.sql import functions as F

from basketry.functions import dates, metrics, numbers, text


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def ts(value):
    return F.lit(value).cast("timestamp")


def test_local_time_has_daylight_saving(spark):
    # In December 2015 the shop was two hours behind UTC, in July three.
    assert one(spark, dates.local_date(ts("2015-12-01 01:00:00"))) == dt.date(2015, 11, 30)
    assert one(spark, dates.local_ts(ts("2015-12-01 02:00:00"))) == dt.datetime(2015, 12, 1, 0, 0)
    assert one(spark, dates.local_ts(ts("2015-07-01 02:00:00"))) == dt.datetime(2015, 6, 30, 23, 0)


def test_month_labels_and_buckets(spark):
    day = F.lit(dt.date(2015, 12, 9))
    assert one(spark, dates.month_label(day)) == "2015-12"
    assert one(spark, dates.month_label_reversed(day)) == "12-2015"
    assert one(spark, dates.campaign_month_label(day)) == "Dez-15"
    assert one(spark, dates.campaign_month_label(F.lit(dt.date(2016, 2, 1)))) == "Fev-16"
    assert one(spark, dates.month_start(day)) == dt.date(2015, 12, 1)
    assert one(spark, dates.quarter_start(day)) == dt.date(2015, 10, 1)


def test_month_distance_ignores_the_day(spark):
    distance = dates.calendar_months_between(F.lit(dt.date(2016, 1, 1)), F.lit(dt.date(2015, 12, 31)))
    assert one(spark, distance) == 1


def test_same_month_and_period_edges(spark):
    assert one(spark, dates.same_month(F.lit(dt.date(2015, 12, 31)), dt.date(2015, 12, 1)))
    assert not one(spark, dates.same_month(F.lit(dt.date(2016, 1, 1)), dt.date(2015, 12, 31)))
    first, last = dt.date(2015, 8, 1), dt.date(2015, 8, 31)
    assert not one(spark, dates.local_between(ts("2015-08-01 02:59:59"), first, last))
    assert one(spark, dates.local_between(ts("2015-08-01 03:00:00"), first, last))
    assert one(spark, dates.local_between(ts("2015-09-01 02:59:59"), first, last))
    assert not one(spark, dates.local_between(ts("2015-09-01 03:00:00"), first, last))


def test_day_first_dates(spark):
    assert one(spark, dates.parse_day_first(F.lit("31/12/2015"))) == dt.date(2015, 12, 31)
    assert one(spark, dates.parse_day_first(F.lit("2015-12-31"))) is None


def test_slug_and_kept_characters(spark):
    assert one(spark, text.slug(F.lit("Brand#7 Ção-X"))) == "brand7ox"
    assert one(spark, text.keep_chars(F.lit("a-b.c"), "a-c")) == "abc"


def test_wildcards_ignore_case_and_null_matches_nothing(spark):
    assert one(spark, text.wildcard_any(F.lit("My_EMKT_list"), "*emkt*"))
    assert not one(spark, text.wildcard_any(F.lit("emktx"), "emkt"))
    assert one(spark, text.wildcard_any(F.lit("emktx"), "emkt?"))
    assert not one(spark, text.wildcard_any(F.lit("aXb"), "a_b"))
    assert one(spark, text.wildcard_any(F.lit(None).cast("string"), "*")) is False


def test_differs_is_true_for_null(spark):
    assert one(spark, text.differs(F.lit(None).cast("int"), 1))
    assert not one(spark, text.differs(F.lit(1), 1))


def test_empty_pattern_matches_nothing_and_x_everything(spark):
    assert not one(spark, text.contains_or_any(F.lit("abc"), F.lit("")))
    assert one(spark, text.contains_or_any(F.lit("abc"), F.lit("x")))
    assert one(spark, text.contains_or_any(F.lit("abc"), F.lit("bc")))
    assert one(spark, text.equals_or_any(F.lit("abc"), F.lit("x")))


def test_size_suffix(spark):
    for name, expected in [
        ("Shirt - M", "Shirt"), ("Shirt - GG", "Shirt"), ("Shirt - 100", "Shirt - 100"), (" Shirt ", "Shirt"),
        ("A - B - M", "A - B"),
    ]:
        assert one(spark, text.cut_size_suffix(F.lit(name))) == expected


def test_recode_keeps_null_out_of_the_table(spark):
    assert one(spark, text.recode(F.lit(2), {1: "a", 2: "b"}, "none")) == "b"
    assert one(spark, text.recode(F.lit(9), {1: "a"}, "none")) == "none"
    assert one(spark, text.recode(F.lit(None).cast("int"), {1: "a"}, "none")) == "none"


def test_null_skipping_sums_and_safe_ratio(spark):
    none = F.lit(None).cast("int")
    assert one(spark, numbers.null_sum(none, F.lit(3))) == 3
    assert one(spark, numbers.null_sum(none, none)) == 0
    assert one(spark, numbers.ratio(F.lit(1), F.lit(0))) is None
    assert one(spark, numbers.flag(none == 1)) == 0


def test_empty_sum_is_zero(frame):
    df = frame([(1, 2)], "a int, b int").where("a > 1")
    assert df.agg(numbers.total("b").alias("t")).first()["t"] == 0


def test_sales_metrics(frame):
    df = frame([(10, 1, 2, 5.0, 10.0, 1.5)], "quantity int, cancelled_quantity int, stockout_quantity int, "
               "final_price double, original_price double, shipping_price double")
    row = df.select(
        metrics.liquid_quantity().alias("q"), metrics.basket_value().alias("b"), metrics.sales_value().alias("s"),
        metrics.discount().alias("d"),
    ).first()
    assert tuple(row) == (7, 35.0, 36.5, -0.5)
