import numpy as np
import pytest

import tallyframe as tf
from tallyframe.operators import gram

ROWS = [(1.0, 2.0, 7.0), (2.0, 4.0, 7.0), (3.0, 5.0, 7.0)]


def test_known_value_and_constant_column(spark):
    df = spark.createDataFrame(ROWS, "a double, b double, k double")
    found = {row.feature: row.corr for row in tf.target_corr(df, "a").collect()}
    assert found["b"] == pytest.approx(0.9819805060619659)
    assert found["k"] is None and "a" not in found
    picked = tf.select_by_corr(tf.target_corr(df, "a"), 0.1).collect()
    assert [row.feature for row in picked] == ["b"]
    constant = {row.feature: row.corr for row in tf.target_corr(df, "k").collect()}
    assert constant == {"a": None, "b": None}


def test_nan_does_not_pass_the_threshold(spark):
    df = spark.createDataFrame([(1.0, float("nan")), (2.0, float("nan"))], "a double, n double")
    assert tf.select_by_corr(tf.target_corr(df, "a")).count() == 0


def test_pairs_with_gaps(spark):
    rows = [(1.0, 1.0), (2.0, None), (3.0, 2.5), (4.0, 9.0), (5.0, float("nan"))]
    df = spark.createDataFrame(rows, "y double, x double")
    want = np.corrcoef([1.0, 3.0, 4.0], [1.0, 2.5, 9.0])[0, 1]
    assert tf.target_corr(df, "y").first().corr == pytest.approx(want)


def test_complete_rows_give_the_same(spark):
    rng = np.random.default_rng(8)
    data = rng.normal(size=(300, 4)) * [1.0, 50.0, 0.01, 3.0] + [0.0, 1e6, 5.0, 0.0]
    df = spark.createDataFrame([(*map(float, line), 0.1) for line in data], ["y", "a", "b", "c", "k"]).repartition(6)
    want = {name: np.corrcoef(data[:, 0], data[:, at])[0, 1] for at, name in enumerate("abc", 1)}
    for complete in (False, True):
        found = {r.feature: r.corr for r in tf.target_corr(df, "y", complete=complete).collect()}
        assert found.pop("k") is None
        assert found == {name: pytest.approx(value) for name, value in want.items()}


def test_top_breaks_ties_by_name(spark):
    df = spark.createDataFrame([(1.0, 2.0, 2.0, 1.0), (2.0, 4.0, 4.0, 5.0), (3.0, 6.0, 6.0, 1.0)], "y double, c double, b double, z double")
    assert [r.feature for r in tf.top_corr(tf.target_corr(df, "y"), 2).collect()] == ["b", "c"]


@pytest.mark.parametrize("method", ["aggregate", "blocks", "mllib"])
def test_matrix(spark, method):
    rng = np.random.default_rng(4)
    data = rng.normal(size=(200, 3))
    data[:, 2] += data[:, 0]
    rows = [(*map(float, line), 7.0) for line in data] + [(None, 1.0, 1.0, 7.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, k double")
    want = np.corrcoef(data.T)
    found = {(r.feature_i, r.feature_j): r.corr for r in tf.corr_matrix(df, method=method).collect()}
    assert len(found) == 16
    for i, a in enumerate("abc"):
        for j, b in enumerate("abc"):
            assert found[a, b] == pytest.approx(want[i, j])
    assert all(found[pair] is None for pair in found if "k" in pair)
    wide = tf.wide_matrix(tf.corr_matrix(df, ["a", "b"], method), ["a", "b"])
    assert {r.feature: (r.a, r.b) for r in wide.collect()}["a"] == pytest.approx((1.0, want[0, 1]))


def test_methods_meet_at_the_limit(spark):
    rng = np.random.default_rng(5)
    names = [f"c{i}" for i in range(20)]
    df = spark.createDataFrame([tuple(map(float, line)) for line in rng.normal(size=(60, 20))], names)
    one = {(r.feature_i, r.feature_j): r.corr for r in tf.corr_matrix(df, names, "mllib").collect()}
    two = {(r.feature_i, r.feature_j): r.corr for r in tf.corr_matrix(df, names).collect()}
    assert one.keys() == two.keys()
    assert all(one[pair] == pytest.approx(two[pair]) for pair in one)


def test_redundant_features(spark):
    strength = spark.createDataFrame(
        [("a", 0.5), ("b", 0.6), ("c", 0.4), ("d", 0.4), ("flat", None)], "feature string, abs_corr double"
    )
    pairs = [("a", "b", 0.95), ("b", "a", 0.95), ("c", "d", -0.9), ("d", "c", -0.9), ("a", "c", 0.2), ("c", "a", 0.2)]
    matrix = spark.createDataFrame(pairs, "feature_i string, feature_j string, corr double")
    assert tf.prune_redundant(strength, matrix, 0.9) == ["b", "c"]
    assert tf.prune_redundant(strength, matrix, 0.9, prefer=["d", "a"]) == ["d", "a"]
    assert tf.prune_redundant(strength, matrix, 0.99) == ["b", "a", "c", "d"]


def greedy(strength, close, prefer=()):
    """The visit one by one."""
    order = [n for n in prefer if n in strength] + sorted((n for n in strength if n not in prefer), key=lambda n: (-strength[n], n))
    kept = []
    for name in order:
        if not any((name, other) in close or (other, name) in close for other in kept):
            kept.append(name)
    return kept


@pytest.mark.parametrize("many, share", [(1, 0.0), (40, 0.05), (60, 0.3), (30, 1.0)])
def test_rounds_pick_what_the_visit_picks(spark, many, share):
    rng = np.random.default_rng(many)
    names = [f"f{at}" for at in range(many)]
    # Ties in strength go by name.
    strength = {name: float(rng.integers(1, 6)) / 10 for name in names}
    close = {(a, b) for a in names for b in names if a < b and rng.random() < share}
    target = spark.createDataFrame(list(strength.items()), "feature string, abs_corr double")
    pairs = [(a, b, -0.95) for a, b in close] + [(a, a, 1.0) for a in names] + [("f0", "gone", 0.99)]
    matrix = spark.createDataFrame(pairs, "feature_i string, feature_j string, corr double")
    prefer = [names[-1], "unknown"]
    assert tf.prune_redundant(target, matrix, 0.9) == greedy(strength, close)
    assert tf.prune_redundant(target, matrix, 0.9, prefer) == greedy(strength, close, prefer)


def test_a_chain_takes_a_round_for_each_second_feature(spark):
    names = [f"f{at}" for at in range(6)]
    target = spark.createDataFrame([(name, 1.0 - at / 10) for at, name in enumerate(names)], "feature string, abs_corr double")
    matrix = spark.createDataFrame([(a, b, 0.99) for a, b in zip(names, names[1:])], "feature_i string, feature_j string, corr double")
    assert tf.prune_redundant(target, matrix) == ["f0", "f2", "f4"]
    assert tf.prune_redundant(target.limit(0), matrix) == []


def test_select_features(spark):
    rng = np.random.default_rng(6)
    y = rng.integers(0, 2, 400)
    x = y + rng.normal(size=400)
    rows = [
        (int(a), float(b), float(b * 2), float(c), None if i % 3 else 1.0)
        for i, (a, b, c) in enumerate(zip(y, x, rng.normal(size=400) * 0.01))
    ]
    df = spark.createDataFrame(rows, "y int, x double, twice double, noise double, gaps double")
    found = tf.select_features(df, "y", 0.5, threshold=0.3, redundancy=0.95)
    assert found.features == ["twice"] or found.features == ["x"]
    assert found.table.count() == 400
    preferred = tf.select_features(df, "y", 0.5, threshold=0.3, redundancy=0.95, prefer=["x"])
    assert preferred.features == ["x"] and preferred.table.columns == ["x", "y"]


@pytest.mark.parametrize("width", [16, 17, 24])
@pytest.mark.parametrize("source", ["range", "sample", "many"])
def test_matrix_of_any_width(spark, width, source):
    columns = [f"c{at}" for at in range(width)]
    ids = {"range": spark.range(60), "sample": spark.range(200).sample(0.4, seed=3), "many": spark.range(60).repartition(30)}[source]
    df = ids.selectExpr(*[f"double((id * {at + 3}) % {at + 7}) AS c{at}" for at in range(width - 1)], f"7.0D AS c{width - 1}")
    cells = {(r.feature_i, r.feature_j): r.corr for r in tf.corr_matrix(df, columns).collect()}
    assert len(cells) == width * width
    assert all(cells[a, b] == cells[b, a] for a, b in cells)
    assert all((value is None) == (columns[-1] in pair) for pair, value in cells.items())
    wide = {(r.feature_i, r.feature_j): r.corr for r in tf.corr_matrix(df, columns, "mllib").collect()}
    assert all(value is None and wide[pair] is None or abs(value - wide[pair]) < 1e-9 for pair, value in cells.items())
    for method in ("blocks", "mllib"):
        empty = tf.corr_matrix(df.limit(0), columns, method).collect()
        assert len(empty) == width * width and all(row.corr is None for row in empty)


def test_matrix_of_300_columns_in_blocks_and_groups(spark):
    """Blocks and column groups smaller than the table; default settings of generated code."""
    rng = np.random.default_rng(9)
    data = rng.normal(size=(400, 300)) * rng.choice([1e-2, 1.0, 1e8], 300) + rng.choice([0.0, 1e5], 300)
    data[:, 40] = 0.1
    df = spark.createDataFrame([tuple(map(float, line)) for line in data], [f"c{at}" for at in range(300)]).repartition(7)
    columns = df.columns
    with np.errstate(invalid="ignore", divide="ignore"):
        want = np.corrcoef(data.T)
    saved = spark.conf.get("spark.sql.codegen.maxFields")
    spark.conf.set("spark.sql.codegen.maxFields", "100")
    try:
        cells = {(r.feature_i, r.feature_j): r.corr for r in tf.corr_matrix(df, columns).collect()}
        few = df.select(*columns[:50])
        split = {(r.feature_i, r.feature_j): r.corr for r in gram.correlation_rows(few, few.columns, side=20, block=8).collect()}
    finally:
        spark.conf.set("spark.sql.codegen.maxFields", saved)
    assert len(cells) == 90_000 and len(split) == 2_500
    for (a, b), value in cells.items():
        i, j = int(a[1:]), int(b[1:])
        assert (value is None) == (40 in (i, j)) and cells[b, a] == value
        assert value is None or value == pytest.approx(want[i, j], abs=1e-9)
    assert all(value is None and cells[pair] is None or value == pytest.approx(cells[pair], abs=1e-9) for pair, value in split.items())


def test_matrix_shuffles_blocks_not_rows(spark):
    """The exchanges carry packed blocks; no exchange has a column of the table."""
    df = spark.range(1000).selectExpr("double(id) AS a", "double(id % 7) AS b")
    plan = tf.corr_matrix(df, ["a", "b"], "blocks")._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert exchanges and all("hashpartitioning(i#" in line for line in exchanges)


@pytest.mark.parametrize("width", [1, 2, 10, 11])
def test_both_forms_of_the_matrix_agree(spark, width):
    df = spark.range(80).selectExpr(*[f"double((id * {at + 3}) % {at + 11}) AS c{at}" for at in range(width)])
    blocks = {(r.feature_i, r.feature_j): r.corr for r in tf.corr_matrix(df, method="blocks").collect()}
    own = tf.corr_matrix(df)
    assert ("InArrow" in own._jdf.queryExecution().executedPlan().toString()) == (width > 10)
    assert {(r.feature_i, r.feature_j): pytest.approx(r.corr, abs=1e-12) for r in own.collect()} == blocks and len(blocks) == width**2
    if width > 10:
        with pytest.raises(ValueError):
            tf.corr_matrix(df, method="aggregate")
