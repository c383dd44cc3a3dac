import math
import random

import pytest

from skyledger.functions import sketch


def _single_values(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    return [r[0] for r in df.select(sketch.bin_of("v").alias("b")).select(sketch.bin_value("b")).collect()]


def test_published_values(spark):
    # Published quantiles of whole-minute delays.
    expected = {0: 0.0, 1: 1.01, -1: -1.01, 3: 3.0001207865259647, 4: 3.9628523348246314, 6: 6.0003807881353195,
                7: 7.03964781329143, -9: -8.924561993432542, 10: 10.044983161068599, 11: 11.086028370328492,
                21: 20.897765817592276, 22: 22.17256817980545, 23: 23.06811574166162}
    got = dict(zip(expected, _single_values(spark, expected)))
    for value, want in expected.items():
        assert got[value] == pytest.approx(want, rel=1e-12)


def test_relative_error_and_order(spark):
    rng = random.Random(7)
    values = sorted(rng.choice((-1, 1)) * 10 ** rng.uniform(-6, 9) for _ in range(2000))
    values += [2.0 ** k for k in range(-40, 41)]
    values.sort()
    back = _single_values(spark, values)
    assert all(abs(b - v) <= 0.01 * abs(v) * (1 + 1e-9) for v, b in zip(values, back))
    assert back == sorted(back)


def _quantiles(spark, values, qs, **kw):
    df = spark.createDataFrame([("k", float(v)) for v in values], "k string, v double")
    names = [(f"q{i}", q) for i, q in enumerate(qs)]
    return sketch.quantiles(sketch.bin_counts(df, ["k"], "v"), ["k"], names, **kw).first()


def test_quantiles_against_exact_ranks(spark):
    rng = random.Random(3)
    values = [rng.gauss(5, 40) for _ in range(3001)]
    qs = (0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99, 1.0)
    row = _quantiles(spark, values, qs)
    ordered = sorted(values)
    for i, q in enumerate(qs):
        exact = ordered[math.floor(q * (len(values) - 1))]
        assert abs(row[f"q{i}"] - exact) <= 0.0101 * abs(exact)
    assert (row["count"], row["min"], row["max"]) == (3001, ordered[0], ordered[-1])


def test_not_finite_values_are_ignored(spark):
    row = _quantiles(spark, [float("nan"), float("inf"), float("-inf"), 3.0], (0.5,))
    assert (row["count"], row["min"], row["max"]) == (1, 3.0, 3.0)
    empty = _quantiles(spark, [float("nan")], (0.5,))
    assert tuple(empty)[1:] == (0, 0.0, 0.0, 0.0)


def test_wrong_quantile(spark):
    with pytest.raises(ValueError):
        _quantiles(spark, [1.0], (1.1,))


def test_any_split_merges_to_the_whole(spark):
    rng = random.Random(5)
    rows = [("k", rng.randrange(4), float(rng.randrange(-30, 600))) for _ in range(1000)]
    df = spark.createDataFrame(rows, "k string, part int, v double")
    parts = sketch.merge_bins(sketch.bin_counts(df, ["k", "part"], "v"), ["k"])
    whole = sketch.bin_counts(df, ["k"], "v")
    assert sorted(map(tuple, parts.collect())) == sorted(map(tuple, whole.collect()))


def test_lowest_bins_collapse(spark):
    values = [10.0 ** k for k in range(-3, 4)] + [-(10.0 ** k) for k in range(-3, 4)]
    row = _quantiles(spark, values, (0.0, 0.45, 0.55, 1.0), max_bins=50)
    # The largest magnitude of each sign is kept; everything far below it shares the lowest kept bin.
    assert row["q0"] == pytest.approx(-1000, rel=0.01)
    assert row["q3"] == pytest.approx(1000, rel=0.01)
    assert row["q1"] == pytest.approx(-row["q2"], rel=1e-9)
    assert row["q2"] > 100


def test_weights(spark):
    df = spark.createDataFrame([("k", 1.0, 9), ("k", 100.0, 1)], "k string, v double, w int")
    bins = sketch.bin_counts(df, ["k"], "v", weight="w")
    row = sketch.quantiles(bins, ["k"], [("p50", 0.5), ("p100", 1.0)]).first()
    assert row["count"] == 10
    assert row["p50"] == pytest.approx(1.0, rel=0.0101)
    assert row["p100"] == pytest.approx(100.0, rel=0.01)


def test_quantiles_of_lists_equal_those_of_bins(spark):
    """Both signs, zeros, values without a bin, keys without any value, and folded bins."""
    rows = [(k, v) for k in range(3) for v in [0.0, 1.5, -2.0, float("nan"), *[(-1.7) ** i * (k + 1) for i in range(40)]]]
    rows += [(9, float("nan")), (8, -3.0)]
    bins = sketch.bin_counts(spark.createDataFrame(rows, "k int, v double"), ["k"], "v")
    probabilities = (("low", 0.0), ("p30", 0.3), ("p50", 0.5), ("p90", 0.9), ("high", 1.0))
    for max_bins in (5, 40, 2048):
        want = sketch.quantiles(bins, ["k"], probabilities, max_bins=max_bins).orderBy("k").collect()
        listed = bins.groupBy("k").agg(*sketch.bin_list())
        got = sketch.list_quantiles(listed, ["k"], probabilities, max_bins=max_bins).orderBy("k").collect()
        assert got == want


def test_a_bin_takes_few_logarithms(spark):
    """The formula names its exponent in many places; it is worked out once for a row, a logarithm being a ratio of two."""
    plan = spark.range(1).selectExpr("double(id) AS v").select(sketch.bin_of("v"))._jdf.queryExecution().executedPlan()
    debug = getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$")
    code = getattr(debug, "MODULE$").codegenString(plan)
    assert 0 < code.count("StrictMath.log(") <= 6 and 0 < code.count("pow(") <= 6


def test_odd_values_have_their_own_bins(spark):
    tiny = 5e-324
    rows = [(None,), (math.nan,), (math.inf,), (-math.inf,), (0.0,), (-0.0,), (tiny,), (-tiny,), (1.0,), (-1.0,)]
    got = [r[0] for r in spark.createDataFrame(rows, "v double").select(sketch.bin_of("v")).collect()]
    assert got[:8] == [None] * 4 + [0] * 4 and got[8] == -got[9] > 0
