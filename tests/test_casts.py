import math

from pyspark.sql import functions as F

from contrail.functions import casts

# (input, f64, i32, u32z, u8z, bool) - FIXTURES.md, lenient casts table.
CASES = [
    ("12", 12.0, 12, 12, 12, None),
    ("-3", -3.0, -3, 0, 0, None),
    ("1.5", 1.5, None, 0, 0, None),
    ("abc", None, None, 0, 0, None),
    ("", None, None, 0, 0, None),
    ("1e2", 100.0, None, 0, 0, None),
    ("4294967296", 4294967296.0, None, 0, 0, None),
    ("true", None, None, 0, 0, True),
    ("false", None, None, 0, 0, False),
    (" 7 ", 7.0, 7, 7, 7, None),
    (None, None, None, None, None, None),
    ("256", 256.0, 256, 256, 0, None),
    ("1d", None, None, 0, 0, None),
]


def test_lenient_cast_table(spark):
    df = spark.createDataFrame([(c[0],) for c in CASES], "x string")
    x = F.col("x")
    got = df.select("x", casts.f64_or_null(x).alias("f64"), casts.i32_or_null(x).alias("i32"),
                    casts.u32_or_zero(x).alias("u32z"), casts.u8_or_zero(x).alias("u8z"),
                    casts.to_bool(x).alias("b")).collect()
    by_input = {r["x"]: tuple(r)[1:] for r in got}
    for inp, *expected in CASES:
        assert by_input[inp] == tuple(expected), inp


def test_uint8_boolean_pitfall(spark):
    df = spark.createDataFrame([("true",), ("1",), ("0",), (None,)], "x string")
    got = [r[0] for r in df.select(casts.to_bool("x", "uint8_or_zero")).collect()]
    assert got == [False, True, False, None]


def test_round_ch_half_even_on_binary_value(spark):
    df = spark.createDataFrame([(0.125,), (0.135,), (2.675,), (-1.005,), (None,)], "x double")
    got = [r[0] for r in df.select(casts.round_ch("x", 2)).collect()]
    expected = [round(0.125 * 100) / 100, 0.14, round(2.675 * 100) / 100, round(-1.005 * 100) / 100, None]
    assert got[:4] == expected[:4] and got[4] is None


def test_exact_avg_is_order_independent(spark):
    vals = [0.1 * i for i in range(1, 2000)] + [1e-7, 123456.789]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    a = df.repartition(1).agg(casts.exact_avg("x")).first()[0]
    b = df.repartition(7).orderBy(F.rand(3)).agg(casts.exact_avg("x")).first()[0]
    assert a == b
    assert math.isclose(a, sum(vals) / len(vals), rel_tol=1e-9)


def test_dense_ids_are_consecutive_in_order(spark):
    from contrail.functions.ids import dense_ids
    df = spark.range(0, 5000).selectExpr("id", "cast(rand(7) * 1000 as int) AS k", "cast(id % 97 as string) AS s")
    got = dense_ids(df, ["k", "s", "id"], 41, partitions=7).collect()
    ordered = sorted(got, key=lambda r: (r["k"], r["s"], r["id"]))
    assert [r["load_id"] for r in ordered] == list(range(42, 42 + 5000))
