from pyspark.sql import functions as F

from clickscope import functions as CF


def one(spark, col):
    return spark.range(1).select(col.alias("v")).collect()[0]["v"]


def test_percent_half_up_exact_ties(spark):
    # 57/800 = 7.125 % exactly: HALF_UP gives 7.13 (a double route gives 7.12)
    assert one(spark, CF.percent_half_up(F.lit(57), F.lit(800))) == 7.13
    assert one(spark, CF.percent_half_up(F.lit(1), F.lit(3))) == 33.33
    assert one(spark, CF.percent_half_up(F.lit(2), F.lit(3))) == 66.67
    assert one(spark, CF.percent_half_up(F.lit(1), F.lit(8))) == 12.5
    assert one(spark, CF.percent_half_up(F.lit(5), F.lit(5))) == 100.0


def test_percent_of_zero_total_is_null(spark):
    assert one(spark, CF.percent_half_up(F.lit(0), F.lit(0))) is None


def test_percent_text_two_decimals(spark):
    assert one(spark, CF.percent_text(F.lit(1), F.lit(8))) == "12.50"
    assert one(spark, CF.percent_text(F.lit(57), F.lit(800))) == "7.13"
    assert one(spark, CF.percent_text(F.lit(3), F.lit(3))) == "100.00"
    assert one(spark, CF.percent_text(F.lit(1), F.lit(1000))) == "0.10"


def test_percent_large_counts_stay_exact(spark):
    # counts far beyond 2^53 / 20000 still round exactly
    n, t = 123_456_789_012_345, 987_654_321_098_765
    expected_hundredths = (n * 20000 + t) // (2 * t)
    assert one(spark, CF.percent_half_up(F.lit(n), F.lit(t))) == expected_hundredths / 100.0


def test_split_ids_drops_empty_items(spark):
    df = spark.createDataFrame([("1,2,",), (",3,,4",), ("",), (None,)], "s string")
    got = [r["v"] for r in df.select(CF.split_ids("s").alias("v")).collect()]
    assert got == [["1", "2"], ["3", "4"], [], []]


def test_hour_key_and_seconds(spark):
    assert one(spark, CF.hour_key(F.lit("2018-11-26 07:05:09"))) == "2018-11-26 07"
    assert one(spark, CF.seconds_between(F.lit("2018-11-26 23:59:50"), F.lit("2018-11-27 00:00:05"))) == 15


def test_classify_operation_precedence(spark):
    df = spark.createDataFrame(
        [("1,2", "3", "kw", 5), (None, "3", "kw", 5), (None, "", "kw", 5), (None, None, None, 5),
         (None, None, "", -1)],
        "pay_product_ids string, order_product_ids string, search_keyword string, click_product_id long")
    kind, obj = CF.classify_operation()
    got = [(r[0], r[1]) for r in df.select(kind, obj).collect()]
    assert got == [("pay", "1,2"), ("order", "3"), ("search", "kw"), ("click", "5"), ("", "")]


def test_city_remark_order_and_top_n(spark):
    cities = F.array(*[F.struct(F.lit(-n).alias("neg_n"), F.lit(c).alias("city"), F.lit(n).alias("n"))
                       for c, n in [("b", 2), ("a", 2), ("c", 4)]])
    assert one(spark, CF.city_remark(cities, F.lit(8))) == "c=50.00%,a=25.00%,b=25.00%"
    assert one(spark, CF.city_remark(cities, F.lit(8), top_n=1)) == "c=50.00%,other=50.00%"
    assert one(spark, CF.city_remark(cities, F.lit(8), top_n=3)) == "c=50.00%,a=25.00%,b=25.00%"
