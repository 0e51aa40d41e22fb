import numpy as np
import pytest
from pyspark.sql import functions as F

import tallyframe as tf
from tallyframe.functions.missing import missing
from tallyframe.operators import radix
from tallyframe.operators.ordering import running_sums
from tallyframe.operators.radix import exact_quantiles
from tallyframe.operators.profiling import per_column

TEXTS = ["1", "NA", "abc", None, "", "99", "BANANA", "NaN", "None of it", "99.0"]


def flags(df, **options):
    test = missing(df.schema["s"], **options)
    return [row[0] for row in df.select(test).collect()]


def test_missing_text(spark):
    df = spark.createDataFrame([(text,) for text in TEXTS], "s string").coalesce(1)
    assert flags(df) == [False, True, False, True, True, True, True, True, True, True]
    assert flags(df, text_match="equals")[6:9] == [False, True, False]
    assert flags(df, codes=())[5] is False
    with pytest.raises(ValueError):
        flags(df, text_match="regex")


def test_missing_texts_are_taken_literally(spark):
    df = spark.createDataFrame([("it's",), ("back\\slash",), ("its",)], "s string")
    assert sorted(flags(df.coalesce(1), texts=("it's", "k\\s"))) == [False, True, True]


def test_missing_by_type(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (1, 99.0D, true, DATE'2020-01-01', 99.00BD), "
        "(99, double('NaN'), NULL, NULL, 1.5BD), (NULL, NULL, false, DATE'2020-01-02', NULL) "
        "AS t(i, d, b, day, dec)"
    )
    rows = {row.feature: (row.n_missing, row.n_present) for row in tf.missing_profile(df).collect()}
    assert rows == {"i": (2, 1), "d": (3, 0), "b": (1, 2), "day": (1, 2), "dec": (2, 1)}


def test_column_codes_replace_the_common_ones(spark):
    df = spark.createDataFrame([(99, 99), (7, 7)], "a int, b int")
    found = tf.missing_profile(df, column_codes={"b": (7, 8)})
    assert {row.feature: row.n_missing for row in found.collect()} == {"a": 1, "b": 1}
    assert {
        row.feature: row.n_missing
        for row in tf.missing_profile(df, column_codes={"b": ()}).collect()
    } == {"a": 1, "b": 0}


@pytest.mark.parametrize(
    "bound, kept", [(0, ["a", "b"]), (6, ["a", "b"]), (7, ["b"]), (11, []), (0.6, ["a", "b"]), (0.61, ["b"])]
)
def test_prune_bounds(spark, bound, kept):
    rows = [(i if i < 6 else None, 1) for i in range(10)]
    df = spark.createDataFrame(rows, "a int, b int")
    assert tf.prune_columns(df, bound).columns == kept


def test_prune_takes_odd_names(spark):
    df = spark.createDataFrame([(1, None)], "`a.b` int, `c d` int")
    assert tf.prune_columns(df, 1).columns == ["a.b"]


def test_wide_table_goes_in_several_passes(spark):
    names = [f"c{i}" for i in range(230)]
    df = spark.range(20).select(*[(F.col("id") % (i + 1)).alias(n) for i, n in enumerate(names)])
    found = per_column(df, names, lambda n: {"top": f"max({n})"}, shared={"n": "count(*)"})
    rows = {row.feature: (row.top, row.n) for row in found.collect()}
    assert len(rows) == 230
    assert rows["c4"] == (4, 20) and rows["c229"] == (19, 20)


def test_null_rows(spark):
    df = spark.createDataFrame([(1.0, "x"), (float("nan"), "y"), (None, "z"), (2.0, None)], "a double, s string")
    assert [row.a for row in tf.drop_null_rows(df).collect()] == [1.0]
    assert tf.drop_null_rows(df, ["s"]).count() == 3


def test_shares_with_labels(spark):
    df = spark.createDataFrame([(1,)] * 3 + [(2,)] + [(9,)], "sex int")
    texts = spark.createDataFrame([(1, "Male"), (2, "Female")], "code int, label string")
    shares = tf.label_codes(tf.group_count(df, "sex", share=True), "sex", texts, "code", "label")
    assert {(r.sex, r.label, r.n, r.share) for r in shares.collect()} == {
        (1, "Male", 3, 0.6),
        (2, "Female", 1, 0.2),
        (9, None, 1, 0.2),
    }


def test_transpose_is_the_inverse_layout(spark):
    df = spark.createDataFrame([("count", "3", "4"), ("mean", "1.5", None)], "summary string, a string, b string")
    rows = {tuple(row) for row in tf.transpose(df, "summary", ["count", "mean"]).collect()}
    assert rows == {("a", "3", "1.5"), ("b", "4", None)}


def test_summary_of_native_layout(spark):
    df = spark.createDataFrame([(float(i), i % 3) for i in range(1, 101)], "x double, k int")
    ours = {row.summary: row.x for row in tf.summary_table(df).collect()}
    native = {row.summary: float(row.x) for row in df.summary().collect()}
    assert set(ours) == set(native)
    for name, value in native.items():
        assert ours[name] == pytest.approx(value)


def test_quantiles_with_a_hot_value(spark):
    rng = np.random.default_rng(1)
    values = np.concatenate([np.full(700, 5.0), rng.exponential(3.0, 1300)]).round(2)
    small = rng.integers(-3, 3, 2000)
    df = spark.createDataFrame(
        [(float(a), int(b)) for a, b in zip(values, small)], "a double, b int"
    ).repartition(7)
    probabilities = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]
    found = exact_quantiles(df, ["a", "b"], probabilities).collect()
    got = {(row.feature, row.p): row.value for row in found}
    assert len(found) == len(got) == 14
    for name, data in (("a", values), ("b", small)):
        for p in probabilities:
            want = np.quantile(data, p, method="inverted_cdf")
            assert got[name, p] == want, (name, p)


def test_keys_are_in_the_order_of_doubles():
    values = [float("-inf"), -1e308, -1.5, -1e-320, -0.0, 0.0, 5e-324, 1.0, 1.0000000000000002, 1e300, float("inf"), float("nan")]
    keys = radix.to_keys(np.array(values))
    assert keys[4] == keys[5] and (np.diff(keys.astype(object)) >= 0).all() and len(set(keys.tolist())) == len(values) - 1
    assert [radix.to_value(int(key)) for key in keys[:-1]] == [0.0 if v == 0 else v for v in values[:-1]]
    assert np.isnan(radix.to_value(int(keys[-1])))


def test_quantiles_of_close_and_special_values(spark):
    """Values that differ in their last bits only, both signs, infinities and NaN."""
    rng = np.random.default_rng(5)
    close = 1.0 + rng.integers(0, 9, 400) * 2.0**-52
    wild = np.concatenate([rng.normal(size=394) * 10.0 ** rng.integers(-300, 300, 394), [np.inf, -np.inf, np.nan, np.nan, 0.0, -0.0]])
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(close, wild)], "a double, b double").repartition(5)
    probabilities = [0.0, 0.1, 0.25, 0.5, 0.9, 0.99, 1.0]
    got = {(row.feature, row.p): row.value for row in exact_quantiles(df, ["a", "b"], probabilities).collect()}
    for name, data in (("a", close), ("b", np.sort(wild))):
        for p in probabilities:
            want = np.sort(data)[max(int(np.ceil(p * len(data))), 1) - 1]
            assert got[name, p] == want or (np.isnan(got[name, p]) and np.isnan(want)), (name, p)


def test_quantiles_shuffle_counts_not_cells(spark):
    df = spark.createDataFrame([(float(i),) for i in range(100)], "wide_cell double")
    asked = [(0, 0.5, 0, -1)]
    numbered = df.select(df.wide_cell.alias("c0"))
    plan = radix._digit_of_each(numbered, 0, {0: [0]}, asked)._jdf.queryExecution().executedPlan().toString()
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert shuffles and all("place#" in line and "c0#" not in line for line in shuffles)


def test_quantiles_leave_nulls_out(spark):
    df = spark.createDataFrame([(None, 1.0), (None, None), (None, 3.0)], "e double, a double")
    found = {(r.feature, r.p): r.value for r in exact_quantiles(df, ["e", "a"], [0.5]).collect()}
    assert found == {("a", 0.5): 1.0}
    stats = {row.feature: row for row in tf.summary_stats(df).collect()}
    assert stats["e"].n == 0 and stats["e"].q2 is None
    assert stats["a"].n == 2 and stats["a"].q2 == 1.0


@pytest.mark.parametrize("buckets", [2, 5, 64])
def test_running_sums_match_a_plain_loop(spark, buckets):
    rng = np.random.default_rng(2)
    rows = [
        (str(g), float(v), int(w))
        for g, v, w in zip(rng.integers(0, 3, 900), rng.integers(0, 40, 900) / 4, rng.integers(0, 5, 900))
    ]
    rows += [("0", 2.5, 1)] * 400 + [("1", float("nan"), 2), ("1", float("inf"), 3), ("2", float("-inf"), 1)]
    df = spark.createDataFrame(rows, "g string, v double, w int").repartition(5)
    found = running_sums(df, ["g"], "v", ["w"], buckets).collect()

    def key(value):
        return (value != value, value if value == value else 0.0)

    for row in found:
        mine = [(v, w) for g, v, w in rows if g == row.g]
        assert row.w == sum(w for v, w in mine if key(v) == key(row.v))
        assert row.cum_w == sum(w for v, w in mine if key(v) >= key(row.v))
        assert row.all_w == sum(w for v, w in mine)
    assert len(found) == len({(g, str(v)) for g, v, w in rows})


@pytest.mark.parametrize("bins", [1, 7, 64])
def test_histogram_is_numpys(spark, bins):
    rng = np.random.default_rng(3)
    values = np.round(rng.gamma(4.0, 7.0, 3000), 1)
    rows = [(float(v),) for v in values] + [(None,), (float("nan"),)]
    found = tf.histogram(spark.createDataFrame(rows, "x double"), "x", bins).orderBy("bin").collect()
    counts, edges = np.histogram(values, bins=bins)
    assert [row.n for row in found] == counts.tolist()
    assert [row.lo for row in found] == pytest.approx(edges[:-1].tolist())
    assert [row.hi for row in found] == pytest.approx(edges[1:].tolist())


def test_histogram_of_one_value_and_of_none(spark):
    one = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    counts, edges = np.histogram([3.0, 3.0], bins=4)
    found = tf.histogram(one, "x", 4).orderBy("bin").collect()
    assert [row.n for row in found] == counts.tolist()
    assert found[0].lo == edges[0] and found[-1].hi == edges[-1]
    assert [row.n for row in tf.histogram(one.where("x > 5"), "x", 4).collect()] == [0] * 4
    with pytest.raises(ValueError):
        tf.histogram(one, "x", 0)


def test_shares_are_exact(spark):
    df = spark.range(100).selectExpr("id", "if(id < 7, id, NULL) AS seven", "if(id < 6, id, NULL) AS six")
    assert tf.prune_columns(df, 0.07).columns == ["id", "seven"]
    # 99 is a missing code unless none is given.
    assert tf.prune_columns(df, 1.0).columns == []
    assert tf.prune_columns(df, 1.0, codes=()).columns == ["id"]


def test_transpose_keeps_or_refuses_clashing_cells(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 3.0)], "k string, x double")
    with pytest.raises(Exception, match="share a value"):
        tf.transpose(df, "k", ["a", "b"]).collect()
    joined = tf.transpose(df, "k", ["a", "b"], joined=" ").first()
    assert (joined["a"], joined["b"]) == ("1.0 2.0", "3.0")
