import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from cellscape.functions.numeric import normal_two_sided_p, r6
from cellscape.functions.windows import count_below_by_value, row_number_by_unique_key, sum_below_int_key


def test_normal_pvalue_matches_math_erfc(spark):
    zs = [i / 7.0 - 9 for i in range(130)]
    df = spark.createDataFrame([(z,) for z in zs], "z double")
    got = {r.z: r.p for r in df.select("z", normal_two_sided_p("z").alias("p")).collect()}
    for z in zs:
        exp = math.erfc(abs(z) / math.sqrt(2))
        assert abs(got[z] / exp - 1) < 1e-12


def test_r6_rounds_half_away_and_drops_negative_zero(spark):
    df = spark.createDataFrame([(0.0000004,), (-0.0000004,), (1.2345675,), (2.5e-6,)], "x double")
    vals = [r[0] for r in df.select(r6("x")).collect()]
    assert vals[0] == 0.0 and math.copysign(1, vals[1]) == 1.0
    assert vals[3] == 3e-6


def test_sum_below_int_key_matches_window(spark):
    rows = [(p, k, w) for p in range(3) for k, w in [(5, 1), (1, 2), (9, 3), (7, 4), (3, 5), (100000, 6)]]
    df = spark.createDataFrame(rows, "p long, k long, w long")
    got = sum_below_int_key(df, ["p"], "k", "w", "below", width=4)
    w = Window.partitionBy("p").orderBy("k").rangeBetween(Window.unboundedPreceding, -1)
    exp = df.withColumn("e", F.coalesce(F.sum("w").over(w), F.lit(0)))
    bad = got.join(exp, ["p", "k", "w"]).where(F.col("below") != F.col("e")).count()
    assert bad == 0 and got.count() == len(rows)


def test_row_number_by_unique_key(spark):
    df = spark.createDataFrame([("a", i * 37 % 101) for i in range(50)] + [("b", 3), ("b", 1)], "n string, k long")
    got = row_number_by_unique_key(df, ["n"], "k", "rn", width=8).collect()
    by = {}
    for r in got:
        by.setdefault(r.n, []).append((r.k, r.rn))
    for n, lst in by.items():
        lst.sort()
        assert [rn for _, rn in lst] == list(range(1, len(lst) + 1))


def test_count_below_hot_and_plain_paths_agree(spark):
    rows = [(1, float(v), 1 + v % 3) for v in range(300)] + [(2, float(v) / 10, 2) for v in range(40)]
    dv = spark.createDataFrame(rows, "g long, value double, n long")
    hot = count_below_by_value(dv, "g", "value", "n", width=10)
    plain = count_below_by_value(dv, "g", "value", "n")
    w = Window.partitionBy("g").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    exp = dv.withColumn("e", F.coalesce(F.sum("n").over(w), F.lit(0)))
    for got in (hot, plain):
        assert got.join(exp, ["g", "value", "n"]).where(F.col("below") != F.col("e")).count() == 0
