"""Every registered query: a Spark function and, where SQL can say it, the SQL.

Doubles that come out of sums are rounded to six decimals on both sides, since
engines add in different orders.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import tallyframe as tf
from tallyframe.operators.models import CLASSIFIERS, FINAL_PARAMS, TUNING_GRIDS
from tallyframe.sources import scratch_path, staged
from workload.inputs import (
    CODED,
    FEATURES,
    INTERCEPT,
    NO,
    NUMERIC,
    RULES,
    TABLES,
    WEAK_INTERCEPT,
    WEAK_WEIGHTS,
    WEIGHTS,
    YES,
    hash_unit_sql,
    survey,
    table,
    with_views,
)

Runner = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    """A Spark query and its SQL counterpart (None where SQL has none)."""

    run: Runner
    sql: str | None


QUERIES: dict[str, Query] = {}


def register(name: str, sql: str | None = None, views: tuple[str, ...] = ()):
    """Enter a query in the registry under ``name``."""

    def enter(run: Runner) -> Runner:
        QUERIES[name] = Query(run, None if sql is None else with_views(sql, *views))
        return run

    return enter


def rounded(df: DataFrame, *names: str) -> DataFrame:
    """Round the named columns to six decimals."""
    return df.withColumns({name: F.round(name, 6) for name in names})


def round_sql(expr: str, alias: str) -> str:
    """The same rounding in SQL; adding zero turns -0.0 to 0.0."""
    return f"round({expr}, 6) + 0.0 AS {alias}"


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Survey rows that answered yes or no, with the 1/0 label."""
    return tf.make_label(survey(spark, sf_dir), "diag", YES, NO)


def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled and cleaned rows with the model features."""
    rows = labelled(spark, sf_dir).select("id", "label", *FEATURES)
    return tf.apply_rules(rows, RULES)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prepared rows scored by the known weights."""
    return tf.linear_score(prepared(spark, sf_dir), WEIGHTS, INTERCEPT)


def pair_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prepared rows scored by two sets of weights."""
    rows = prepared(spark, sf_dir)
    cells = []
    for model, weights, intercept in (("strong", WEIGHTS, INTERCEPT), ("weak", WEAK_WEIGHTS, WEAK_INTERCEPT)):
        # Each scorer's columns are renamed, so that both stand beside one another in one scan.
        rows = tf.linear_score(rows, weights, intercept).withColumnsRenamed(
            {"margin": f"{model}_margin", "prediction": f"{model}_prediction"}
        ).drop("score")
        cells.append(
            F.struct(
                F.lit(model).alias("model"),
                F.col(f"{model}_margin").alias("margin"),
                F.col(f"{model}_prediction").alias("prediction"),
            )
        )
    return rows.select("id", "label", F.inline(F.array(*cells)))


# Scans, sinks and sizes


@register(
    "scan_profile",
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, (SELECT count(*) FROM {name}) AS n_rows, "
        f"(SELECT count(*) FROM (DESCRIBE {name})) AS n_cols"
        for name in TABLES
    ),
)
def scan_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tf.table_sizes({name: table(spark, sf_dir, name) for name in TABLES})


@register(
    "csv_roundtrip",
    "SELECT id, label, bmi, alcday, michd, genhlth, checkup FROM prepared",
    ("prepared",),
)
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = prepared(spark, sf_dir).select("id", "label", "bmi", "alcday", "michd", *CODED)
    path = scratch_path(spark, "prepared") + ".csv"
    tf.write_table(rows, path, fmt="csv")
    return tf.read_table(spark, path, T.StructType(rows.schema.fields), fmt="csv")


@register(
    "size_report",
    """
    SELECT 'all' AS step, count(*) AS n_rows, 13::BIGINT AS n_cols FROM survey
    UNION ALL SELECT 'complete', count(*), 11::BIGINT FROM survey WHERE NOT isnan(nanny)
    """,
    ("survey",),
)
def size_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = survey(spark, sf_dir)
    complete = tf.drop_null_rows(tf.prune_columns(rows, 0.4))
    return tf.table_sizes({"all": rows, "complete": complete}, label="step")


# Projections, filters and rules


@register("select_columns", "SELECT id, genhlth, bmi FROM survey", ("survey",))
def select_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survey(spark, sf_dir).select("id", "genhlth", "bmi")


@register(
    "drop_null_rows",
    "SELECT id, sparse, nanny FROM survey "
    "WHERE sparse IS NOT NULL AND nanny IS NOT NULL AND NOT isnan(nanny)",
    ("survey",),
)
def drop_null_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tf.drop_null_rows(survey(spark, sf_dir).select("id", "sparse", "nanny"))


@register("outlier_filter", "SELECT id, bmi FROM survey WHERE bmi < 6000", ("survey",))
def outlier_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tf.apply_rules(survey(spark, sf_dir).select("id", "bmi"), [tf.below("bmi", 6000)])


@register(
    "drop_refusals",
    "SELECT id, genhlth, alcday, checkup FROM survey "
    "WHERE genhlth <> 9 AND alcday <> 999 AND checkup <> 9",
    ("survey",),
)
def drop_refusals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = survey(spark, sf_dir).select("id", "genhlth", "alcday", "checkup")
    return tf.apply_rules(
        rows, [tf.drop("genhlth", 9), tf.drop("alcday", 999), tf.drop("checkup", 9)]
    )


@register(
    "label_binary",
    "SELECT id, CASE WHEN diag = 1 THEN 1 ELSE 0 END AS label FROM survey WHERE diag IN (1, 3)",
    ("survey",),
)
def label_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelled(spark, sf_dir).select("id", "label")


@register(
    "recode_rules",
    "SELECT id, label, bmi, alcday, michd, genhlth, checkup FROM prepared",
    ("prepared",),
)
def recode_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepared(spark, sf_dir)


@register(
    "rule_audit",
    """
    SELECT * FROM (
      SELECT 1 AS rule_no, 'genhlth' AS column_name, 'drop' AS action,
             count(*) AS rows_in, count(*) FILTER (WHERE genhlth <> 9) AS rows_out FROM survey
      UNION ALL SELECT 2, 'alcday', 'drop', count(*), count(*) FILTER (WHERE alcday <> 999)
        FROM survey WHERE genhlth <> 9
      UNION ALL SELECT 3, 'alcday', 'recode', count(*), count(*)
        FROM survey WHERE genhlth <> 9 AND alcday <> 999
      UNION ALL SELECT 4, 'checkup', 'drop', count(*), count(*) FILTER (WHERE checkup <> 9)
        FROM survey WHERE genhlth <> 9 AND alcday <> 999
      UNION ALL SELECT 5, 'checkup', 'recode', count(*), count(*)
        FROM survey WHERE genhlth <> 9 AND alcday <> 999 AND checkup <> 9
      UNION ALL SELECT 6, 'michd', 'recode', count(*), count(*)
        FROM survey WHERE genhlth <> 9 AND alcday <> 999 AND checkup <> 9
      UNION ALL SELECT 7, 'bmi', 'below', count(*), count(*) FILTER (WHERE bmi < 6000)
        FROM survey WHERE genhlth <> 9 AND alcday <> 999 AND checkup <> 9)
    """,
    ("survey",),
)
def rule_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tf.rule_audit(survey(spark, sf_dir), RULES)


# Missing cells


_MISSING = {
    "id": "id = 99",
    "diag": "diag = 99",
    "genhlth": "genhlth = 99",
    "alcday": "alcday = 99",
    "checkup": "checkup = 99",
    "michd": "michd = 99",
    "bmi": "bmi IS NULL OR isnan(bmi) OR bmi = 99",
    "allnull": "allnull IS NULL OR isnan(allnull) OR allnull = 99",
    "sparse": "sparse IS NULL OR isnan(sparse) OR sparse = 99",
    "half99": "half99 IS NULL OR half99 = 99",
    "nanny": "nanny IS NULL OR isnan(nanny) OR nanny = 99",
    "txt": (
        "txt IS NULL OR txt LIKE '%None%' OR txt LIKE '%NULL%' OR txt LIKE '%NA%' "
        "OR txt = '' OR TRY_CAST(txt AS DOUBLE) = 99 OR isnan(TRY_CAST(txt AS DOUBLE))"
    ),
    "konst": "konst = 99",
}


@register(
    "missing_profile",
    " UNION ALL ".join(
        f"SELECT '{name}' AS feature, count(*) FILTER (WHERE {test}) AS n_missing, "
        f"count(*) - count(*) FILTER (WHERE {test}) AS n_present FROM survey"
        for name, test in _MISSING.items()
    ),
    ("survey",),
)
def missing_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tf.missing_profile(survey(spark, sf_dir))


@register(
    "prune_columns",
    "SELECT id, diag, genhlth, alcday, checkup, michd, bmi, half99, nanny, txt, konst FROM survey",
    ("survey",),
)
def prune_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tf.prune_columns(survey(spark, sf_dir), 0.4)


# Codebook


@register(
    "codebook_join",
    """
    SELECT f.feature, f.n, t.n_name AS short_text, b.question, b.responses
    FROM (SELECT c_nationkey::VARCHAR AS feature, count(*) AS n FROM customer GROUP BY 1) f
    LEFT JOIN nation t ON t.n_nationkey::VARCHAR = f.feature
    LEFT JOIN (
      SELECT s_nationkey::VARCHAR AS feature, min(s_name) AS question,
             arg_min('key ' || s_suppkey, s_name) AS responses
      FROM supplier WHERE 2019 + s_suppkey % 2 = 2020 GROUP BY 1) b ON b.feature = f.feature
    """,
)
def codebook_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = (
        table(spark, sf_dir, "customer")
        .groupBy(F.col("c_nationkey").cast("string").alias("feature"))
        .agg(F.count("*").alias("n"))
    )
    texts = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("feature"), F.col("n_name").alias("short_text")
    )
    book = table(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").cast("string").alias("feature"),
        (2019 + F.col("s_suppkey") % 2).alias("year"),
        F.col("s_name").alias("question"),
        F.concat(F.lit("key "), F.col("s_suppkey").cast("string")).alias("responses"),
    )
    return tf.codebook_join(features, texts, book, year=2020)


@register(
    "codebook_counts",
    """
    SELECT c.c_nationkey, c.n, t.n_name
    FROM (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1) c
    LEFT JOIN nation t ON t.n_nationkey = c.c_nationkey
    """,
)
def codebook_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = tf.group_count(table(spark, sf_dir, "customer"), "c_nationkey")
    labels = table(spark, sf_dir, "nation")
    return tf.label_codes(counts, "c_nationkey", labels, "n_nationkey", "n_name")


@register(
    "code_counts",
    " UNION ALL ".join(
        f"SELECT '{name}' AS feature, {name}::VARCHAR AS code, count(*) AS n FROM survey GROUP BY 2"
        for name in ("diag", "genhlth", "alcday", "checkup", "michd")
    ),
    ("survey",),
)
def code_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["diag", "genhlth", "alcday", "checkup", "michd"]
    return tf.code_counts(survey(spark, sf_dir), columns)


# Counts, summaries and histograms


@register("group_count", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def group_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tf.group_count(table(spark, sf_dir, "events"), "event_type")


@register(
    "group_share",
    f"""
    SELECT genhlth, n, {round_sql("n / sum(n) OVER ()", "share")}
    FROM (SELECT genhlth, count(*) AS n FROM survey WHERE genhlth < 9 GROUP BY 1)
    """,
    ("survey",),
)
def group_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tf.apply_rules(survey(spark, sf_dir), [tf.below("genhlth", 9)])
    shares = tf.group_count(rows, "genhlth", share=True)
    return rounded(shares, "share").orderBy("n", "genhlth")


@register(
    "class_balance",
    f"""
    SELECT label, n, {round_sql("min(n) OVER () / n", "fraction")}
    FROM (SELECT label, count(*) AS n FROM prepared GROUP BY 1)
    """,
    ("prepared",),
)
def class_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(tf.class_balance(prepared(spark, sf_dir), "label"), "fraction")


def _summary_sql(source: str, name: str) -> str:
    return f"""
    SELECT '{name}' AS feature, count({name}) AS n, {round_sql(f"avg({name})", "mean")},
           {round_sql(f"stddev_samp({name})", "sd")}, min({name})::DOUBLE + 0.0 AS min,
           quantile_disc({name}, 0.25)::DOUBLE + 0.0 AS q1,
           quantile_disc({name}, 0.5)::DOUBLE + 0.0 AS q2,
           quantile_disc({name}, 0.75)::DOUBLE + 0.0 AS q3,
           max({name})::DOUBLE + 0.0 AS max
    FROM {source}
    """


_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _plus_zero(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.col(f"`{name}`") + 0.0 for name in names})


@register("summary_stats", " UNION ALL ".join(_summary_sql("lineitem", m) for m in _MEASURES))
def summary_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = tf.summary_stats(table(spark, sf_dir, "lineitem"), _MEASURES)
    return _plus_zero(rounded(stats, "mean", "sd"), "min", "q1", "q2", "q3", "max")


@register(
    "summary_transposed",
    """
    SELECT feature, n::DOUBLE AS count, mean, sd AS stddev, min,
           q1 AS "25%", q2 AS "50%", q3 AS "75%", max
    FROM ("""
    + " UNION ALL ".join(_summary_sql("part", m) for m in ("p_size", "p_retailprice"))
    + ")",
)
def summary_transposed(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = tf.summary_table(table(spark, sf_dir, "part"), ["p_size", "p_retailprice"])
    stats = ["count", "mean", "stddev", "min", "25%", "50%", "75%", "max"]
    return rounded(tf.transpose(wide, "summary", stats), "mean", "stddev")


@register(
    "histogram_equal_width",
    """
    SELECT s.bin, round(s.lo, 6) + 0.0 AS lo, round(s.hi, 6) + 0.0 AS hi, count(v.x) AS n
    FROM (
      SELECT r.bin::INT AS bin, lo + r.bin * w AS lo,
             CASE WHEN r.bin = 63 THEN hi ELSE lo + (r.bin + 1) * w END AS hi
      FROM range(64) r(bin),
           (SELECT min(x) AS lo, max(x) AS hi, (max(x) - min(x)) / 64 AS w
            FROM (SELECT l_extendedprice / 100 AS x FROM lineitem WHERE l_extendedprice < 60000))
    ) s
    LEFT JOIN (SELECT l_extendedprice / 100 AS x FROM lineitem WHERE l_extendedprice < 60000) v
      ON v.x >= s.lo AND (v.x < s.hi OR (s.bin = 63 AND v.x <= s.hi))
    GROUP BY ALL
    """,
)
def histogram_equal_width(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").where(F.col("l_extendedprice") < 60000)
    bins = tf.histogram(rows, F.col("l_extendedprice") / 100, 64)
    return rounded(bins, "lo", "hi")


# Correlation


_CORR_COLUMNS = [
    "bmi",
    "genhlth",
    "alcday",
    "checkup",
    "michd",
    "half99",
    "sparse",
    "nanny",
    "allnull",
    "konst",
]


def _corr_sql(name: str) -> str:
    ok = f"{name} IS NOT NULL AND NOT isnan({name}::DOUBLE)"
    x = f"CASE WHEN {ok} THEN {name}::DOUBLE END"
    y = f"CASE WHEN {ok} THEN label::DOUBLE END"
    corr = f"covar_samp({x}, {y}) / nullif(stddev_samp({x}) * stddev_samp({y}), 0)"
    return f"""
    SELECT '{name}' AS feature, {round_sql(corr, "corr")}, {round_sql(f"abs({corr})", "abs_corr")}
    FROM (SELECT *, CASE WHEN diag = 1 THEN 1 ELSE 0 END AS label FROM survey WHERE diag IN (1, 3))
    """


_CORR_SQL = " UNION ALL ".join(_corr_sql(name) for name in _CORR_COLUMNS)


def correlations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tf.target_corr(labelled(spark, sf_dir), "label", _CORR_COLUMNS)


@register("target_corr", _CORR_SQL, ("survey",))
def target_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(correlations(spark, sf_dir), "corr", "abs_corr")


@register("select_by_corr", f"SELECT * FROM ({_CORR_SQL}) WHERE abs_corr > 0.1", ("survey",))
def select_by_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(tf.select_by_corr(correlations(spark, sf_dir), 0.1), "corr", "abs_corr")


@register(
    "top_k_corr",
    f"SELECT * FROM ({_CORR_SQL}) ORDER BY abs_corr DESC NULLS LAST, feature LIMIT 5",
    ("survey",),
)
def top_k_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(tf.top_corr(correlations(spark, sf_dir), 5), "corr", "abs_corr")


_PAIRED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "twice", "total"]
_PAIRED_SQL = (
    "(SELECT l_quantity, l_extendedprice, l_discount, l_tax, l_quantity * 2 + 1 AS twice, "
    "l_extendedprice * (1 + l_tax) AS total FROM lineitem)"
)


def _matrix_sql() -> str:
    parts = []
    for a in _PAIRED:
        for b in _PAIRED:
            value = (
                "1.0::DOUBLE"
                if a == b
                else f"covar_samp({a}, {b}) / nullif(stddev_samp({a}) * stddev_samp({b}), 0)"
            )
            parts.append(
                f"SELECT '{a}' AS feature_i, '{b}' AS feature_j, {round_sql(value, 'corr')} "
                f"FROM {_PAIRED_SQL} HAVING count(*) > 0"
            )
    return " UNION ALL ".join(parts)


def measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_quantity",
        "l_extendedprice",
        "l_discount",
        "l_tax",
        (F.col("l_quantity") * 2 + 1).alias("twice"),
        (F.col("l_extendedprice") * (1 + F.col("l_tax"))).alias("total"),
    )


@register("corr_matrix", _matrix_sql())
def corr_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(tf.corr_matrix(measures(spark, sf_dir), _PAIRED), "corr")


@register("corr_matrix_mllib", _matrix_sql())
def corr_matrix_mllib(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(tf.corr_matrix(measures(spark, sf_dir), _PAIRED, method="mllib"), "corr")


@register(
    "corr_matrix_wide",
    "SELECT feature_i AS feature, "
    + ", ".join(f"max(corr) FILTER (WHERE feature_j = '{b}') AS {b}" for b in _PAIRED)
    + f" FROM ({_matrix_sql()}) GROUP BY 1",
)
def corr_matrix_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    matrix = tf.corr_matrix(measures(spark, sf_dir), _PAIRED)
    return rounded(tf.wide_matrix(matrix, _PAIRED), *_PAIRED)


_STRENGTH_SQL = " UNION ALL ".join(
    f"SELECT '{a}' AS feature, abs(corr({a}, l_quantity)) AS s FROM {_PAIRED_SQL}"
    for a in _PAIRED
    if a != "l_quantity"
)


@register(
    "prune_redundant",
    f"""
    , ranked AS (
      SELECT feature, row_number() OVER (ORDER BY s DESC, feature) AS place FROM ({_STRENGTH_SQL})),
    close AS (SELECT feature_i, feature_j FROM ({_matrix_sql()}) WHERE abs(corr) >= 0.9),
    walk AS (
      SELECT 0::BIGINT AS place, ['']::VARCHAR[] AS kept
      UNION ALL
      SELECT r.place,
             CASE WHEN EXISTS (SELECT 1 FROM close c WHERE c.feature_i = r.feature
                               AND list_contains(w.kept, c.feature_j))
                  THEN w.kept ELSE list_append(w.kept, r.feature) END
      FROM walk w JOIN ranked r ON r.place = w.place + 1)
    SELECT feature FROM (SELECT unnest(kept) AS feature FROM walk
                         WHERE place = (SELECT max(place) FROM walk)) WHERE feature <> ''
    """,
    ("survey",),
)
def prune_redundant(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = measures(spark, sf_dir)
    columns = [name for name in _PAIRED if name != "l_quantity"]
    kept = tf.prune_redundant(
        tf.target_corr(rows, "l_quantity", columns), tf.corr_matrix(rows, columns), 0.9
    )
    return spark.createDataFrame([(name,) for name in kept], "feature string")


@register(
    "select_features",
    """
    SELECT id, nanny, bmi, label FROM (
      SELECT id, nanny, bmi, CASE WHEN diag = 1 THEN 1 ELSE 0 END AS label
      FROM survey WHERE diag IN (1, 3) AND NOT isnan(nanny))
    """,
    ("survey",),
)
def select_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = tf.select_features(labelled(spark, sf_dir), "label", 0.4, exclude=["id"])
    return found.complete.select("id", *found.features, "label")


_CANDIDATES = ["bmi", "nanny", "twice", "almost", "genhlth"]
_CANDIDATES_SQL = """(
  SELECT bmi, nanny, bmi * 2 + 1 AS twice, nanny + id % 7 AS almost, genhlth::DOUBLE AS genhlth,
         CASE WHEN diag = 1 THEN 1 ELSE 0 END AS label
  FROM survey WHERE diag IN (1, 3) AND NOT isnan(nanny))"""


def _greedy_sql(threshold: float, redundancy: float) -> str:
    """The visit of candidates by falling correlation with the label, one after the other."""
    strength = " UNION ALL ".join(f"SELECT '{a}' AS feature, abs(corr({a}, label)) AS s FROM c" for a in _CANDIDATES)
    close = " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b FROM c HAVING abs(corr({a}, {b})) >= {redundancy}" for a in _CANDIDATES for b in _CANDIDATES if a != b
    )
    return f"""
    , c AS {_CANDIDATES_SQL},
    ranked AS (SELECT feature, row_number() OVER (
      ORDER BY CASE feature WHEN 'bmi' THEN 0 WHEN 'nanny' THEN 1 ELSE 2 END, s DESC, feature) AS place FROM ({strength}) WHERE s > {threshold}),
    close AS ({close}),
    walk AS (
      SELECT 0::BIGINT AS place, ['']::VARCHAR[] AS kept
      UNION ALL
      SELECT r.place,
             CASE WHEN EXISTS (SELECT 1 FROM close k WHERE k.a = r.feature AND list_contains(w.kept, k.b))
                  THEN w.kept ELSE list_append(w.kept, r.feature) END
      FROM walk w JOIN ranked r ON r.place = w.place + 1)
    SELECT feature FROM (SELECT unnest(kept) AS feature FROM walk WHERE place = (SELECT max(place) FROM walk)) WHERE feature <> ''
    """


@register("select_features_apart", _greedy_sql(0.1, 0.95), ("survey",))
def select_features_apart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The selection to its end: sparse columns, incomplete rows, weak and then repeating features go.

    ``twice`` and ``almost`` repeat ``bmi`` and ``nanny``, which are preferred.
    """
    rows = labelled(spark, sf_dir).select(
        "id", "bmi", "nanny", (F.col("bmi") * 2 + 1).alias("twice"), (F.col("nanny") + F.col("id") % 7).alias("almost"),
        F.col("genhlth").cast("double").alias("genhlth"), "sparse", "allnull", "label",
    )
    # A column and its double are as strong but for rounding, so preference decides.
    found = tf.select_features(
        rows, "label", 0.4, threshold=0.1, redundancy=0.95, prefer=["bmi", "nanny"], exclude=["id"]
    )
    return spark.createDataFrame([(name,) for name in found.features], "feature string")


# Sampling and splitting


@register(
    "stratified_sample_hash",
    f"""
    SELECT id, label FROM prepared
    WHERE {hash_unit_sql("id", "sample")} < CASE label WHEN 1 THEN 1.0::DOUBLE ELSE 0.3::DOUBLE END
    """,
    ("prepared",),
)
def stratified_sample_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = prepared(spark, sf_dir).select("id", "label")
    return tf.stratified_sample(rows, "label", {1: 1.0, 0: 0.3}, "id")


@register(
    "stratified_sample_native",
    "SELECT label, count(*) AS n_rows, TRUE AS as_expected FROM prepared GROUP BY 1",
    ("prepared",),
)
def stratified_sample_native(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class 1 whole; class 0 within five standard deviations of three tenths."""
    rows = prepared(spark, sf_dir).select("id", "label")
    kept = tf.group_count(tf.stratified_sample_native(rows, "label", {1: 1.0, 0: 0.3}), "label")
    every = tf.group_count(rows, "label").withColumnRenamed("n", "n_rows")
    share = F.when(F.col("label") == 1, 1.0).otherwise(0.3)
    near = F.abs(F.col("n") - F.col("n_rows") * share) <= 5 * F.sqrt(F.col("n_rows") * share * (1 - share))
    return every.join(kept, "label").select("label", "n_rows", near.alias("as_expected"))


@register("split_hash", "SELECT id, label, part FROM parted", ("parted",))
def split_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tf.split_column(prepared(spark, sf_dir).select("id", "label"), "id")


@register(
    "kfold_hash",
    f"SELECT id, label, floor({hash_unit_sql('id', 'fold')} * 10)::INT AS fold FROM prepared",
    ("prepared",),
)
def kfold_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tf.fold_column(prepared(spark, sf_dir).select("id", "label"), "id", 10)


@register(
    "folds_roundtrip",
    f"""
    SELECT fold, 'held' AS side, id FROM (SELECT id, part, floor({hash_unit_sql('id', 'fold')} * 10)::INT AS fold FROM parted)
    WHERE part = 'train' AND fold = 3
    UNION ALL
    SELECT fold, 'others', count(*) FROM (SELECT id, part, floor({hash_unit_sql('id', 'fold')} * 10)::INT AS fold FROM parted)
    WHERE part = 'train' AND fold <> 3 GROUP BY fold
    """,
    ("parted",),
)
def folds_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prepared table written by part and fold; a fold's rows and the sizes of the others, read back."""
    rows = tf.fold_column(tf.split_column(prepared(spark, sf_dir).select("id", "label"), "id"), "id", 10)
    path = scratch_path(spark, "folds")
    tf.write_folds(rows, path)
    held = tf.read_folds(spark, path, "train", 3).select("fold", F.lit("held").alias("side"), "id")
    others = tf.read_folds(spark, path, "train", 3, others=True).groupBy("fold").agg(F.count(F.lit(1)).alias("id"))
    return held.unionAll(others.select("fold", F.lit("others").alias("side"), "id"))


@register(
    "prepare_training_set",
    f"""
    SELECT id, label, bmi, alcday, michd, genhlth, checkup FROM prepared
    JOIN (SELECT label, min(count(*)) OVER () / count(*) AS fraction FROM prepared GROUP BY 1)
      USING (label)
    WHERE {hash_unit_sql("id", "sample")} < fraction
    """,
    ("prepared",),
)
def prepare_training_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tf.prepare_training_set(
        survey(spark, sf_dir), "id", "diag", YES, NO, FEATURES, RULES
    )


# Features


@register(
    "one_hot",
    "SELECT id, label, "
    + ", ".join(f"(genhlth = {code})::INT::DOUBLE AS genhlth_{code}" for code in range(4))
    + ", "
    + ", ".join(f"(checkup = {code})::INT::DOUBLE AS checkup_{code}" for code in range(3))
    + " FROM prepared",
    ("prepared",),
)
def one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = tf.one_hot(prepared(spark, sf_dir).select("id", "label", *CODED), CODED)
    vectors = tf.assemble(coded, ["genhlth_OH", "checkup_OH"])
    names = [f"genhlth_{code}" for code in range(4)] + [f"checkup_{code}" for code in range(3)]
    return tf.vector_columns(vectors, "features", names, ["id", "label"])


@register(
    "assemble_vector",
    "SELECT id, bmi, alcday::DOUBLE AS alcday, michd::DOUBLE AS michd, "
    "genhlth::DOUBLE AS genhlth, checkup::DOUBLE AS checkup FROM prepared",
    ("prepared",),
)
def assemble_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = tf.assemble(prepared(spark, sf_dir), FEATURES)
    return tf.vector_columns(vectors, "features", FEATURES, ["id"])


def _standard_sql(name: str) -> str:
    return (
        f"coalesce(({name} - (SELECT avg({name}) FROM parted WHERE part = 'train')) / "
        f"nullif((SELECT stddev_samp({name}) FROM parted WHERE part = 'train'), 0), 0)"
    )


def scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tf.split_column(
        prepared(spark, sf_dir).withColumn("konst", F.lit(7.0)), "id"
    )
    train = rows.where(F.col("part") == "train")
    pipeline = tf.linear_features([*FEATURES, "konst"], [])
    return tf.fit_features(pipeline, rows, train)[1]


@register(
    "standardize",
    "SELECT id, "
    + ", ".join(round_sql(_standard_sql(name), name) for name in FEATURES)
    + ", 0.0::DOUBLE AS konst FROM parted",
    ("parted",),
)
def standardize(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = [*FEATURES, "konst"]
    wide = tf.vector_columns(scaled(spark, sf_dir), "features_scaled", names, ["id"])
    return rounded(wide, *names)


@register(
    "l2_normalize",
    "SELECT id, "
    + ", ".join(
        round_sql(
            f"{name} / sqrt(" + " + ".join(f"{other} * {other}" for other in FEATURES) + ")", name
        )
        for name in FEATURES
    )
    + ", 0.0::DOUBLE AS konst FROM (SELECT id, "
    + ", ".join(f"{_standard_sql(name)} AS {name}" for name in FEATURES)
    + " FROM parted)",
    ("parted",),
)
def l2_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = [*FEATURES, "konst"]
    wide = tf.vector_columns(scaled(spark, sf_dir), "features", names, ["id"])
    return rounded(wide, *names)


@register(
    "category_index",
    "SELECT id, bmi, "
    + ", ".join(
        f"(dense_rank() OVER (ORDER BY {name}) - 1)::DOUBLE AS {name}"
        for name in ("alcday", "michd", "genhlth", "checkup")
    )
    + " FROM prepared",
    ("prepared",),
)
def category_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = prepared(spark, sf_dir)
    indexed = tf.fit_features(tf.tree_features(FEATURES, keep_unseen=False), rows)[1]
    return tf.vector_columns(indexed, "indexedFeatures", FEATURES, ["id"])


# Scoring and evaluation


@register(
    "linear_score",
    f"SELECT id, label, {round_sql('score', 'score')}, prediction FROM scored",
    ("scored",),
)
def linear_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(scored(spark, sf_dir).select("id", "label", "score", "prediction"), "score")


_CELLS_SQL = """
    SELECT a.label::INT AS label, p.prediction::INT AS prediction,
           count(s.id) AS n
    FROM range(2) a(label) CROSS JOIN range(2) p(prediction)
    LEFT JOIN scored s ON s.label = a.label AND s.prediction = p.prediction
    GROUP BY ALL
"""


@register("confusion_matrix", _CELLS_SQL, ("scored",))
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tf.confusion_matrix(scored(spark, sf_dir))


def _metric_sql(source: str, keys: str = "") -> str:
    """Metrics per group as one wide row, from plain counts."""
    by = f"{keys}, " if keys else ""
    group = f"GROUP BY {keys}" if keys else ""
    return f"""
    SELECT {by}
      (n00 + n11) / n AS accuracy, (n01 + n10) / n AS error,
      CASE WHEN n00 + n10 = 0 THEN 0 ELSE n00 / (n00 + n10) END AS precision_0,
      n00 / nullif(n00 + n01, 0) AS recall_0,
      CASE WHEN 2 * n00 + n10 + n01 = 0 THEN 0 ELSE 2 * n00 / (2 * n00 + n10 + n01) END AS f_measure_0,
      CASE WHEN n11 + n01 = 0 THEN 0 ELSE n11 / (n11 + n01) END AS precision_1,
      n11 / nullif(n11 + n10, 0) AS recall_1,
      CASE WHEN 2 * n11 + n10 + n01 = 0 THEN 0 ELSE 2 * n11 / (2 * n11 + n10 + n01) END AS f_measure_1,
      (n00 + n01) / n AS share_0, (n10 + n11) / n AS share_1
    FROM (SELECT {by} count(*)::DOUBLE AS n,
            count(*) FILTER (WHERE label = 0 AND prediction = 0)::DOUBLE AS n00,
            count(*) FILTER (WHERE label = 0 AND prediction = 1)::DOUBLE AS n01,
            count(*) FILTER (WHERE label = 1 AND prediction = 0)::DOUBLE AS n10,
            count(*) FILTER (WHERE label = 1 AND prediction = 1)::DOUBLE AS n11
          FROM {source} {group})
    """


_METRICS = [
    ("accuracy", None),
    ("error", None),
    *[(m, side) for side in (0, 1) for m in ("precision", "recall", "f_measure")],
]


@register(
    "classification_metrics",
    " UNION ALL ".join(
        f"SELECT '{m}' AS metric, {'NULL' if side is None else side}::INT AS class, "
        + round_sql(m if side is None else f"{m}_{side}", "value")
        + f" FROM ({_metric_sql('scored')})"
        for m, side in _METRICS
    ),
    ("scored",),
)
def classification_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(tf.classification_metrics(scored(spark, sf_dir)), "value")


@register(
    "weighted_f1",
    f"SELECT {round_sql('f_measure_0 * share_0 + f_measure_1 * share_1', 'weighted_f1')} "
    f"FROM ({_metric_sql('scored')})",
    ("scored",),
)
def weighted_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(tf.weighted_f1(scored(spark, sf_dir)), "weighted_f1")


_COMPARED = ["accuracy", "error"] + [
    f"{m}_{side}" for side in (0, 1) for m in ("precision", "recall", "f_measure")
]


@register(
    "model_compare",
    "SELECT model, part, "
    + ", ".join(round_sql(name, name) for name in _COMPARED)
    + ", "
    + round_sql("f_measure_0 * share_0 + f_measure_1 * share_1", "weighted_f")
    + " FROM ("
    + _metric_sql(
        f"(SELECT *, CASE WHEN {hash_unit_sql('id')} < 0.8::DOUBLE THEN 'train' ELSE 'test' END AS part "
        "FROM pair)",
        "model, part",
    )
    + ")",
    ("pair",),
)
def model_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tf.split_column(pair_scored(spark, sf_dir), "id")
    return rounded(tf.compare_models(rows, ["model", "part"]), *_COMPARED, "weighted_f")


def _curve_sql(source: str, keys: str = "") -> str:
    """Running counts at each threshold by a plain window."""
    by = f"{keys}, " if keys else ""
    part = f"PARTITION BY {keys}" if keys else ""
    return f"""
    SELECT {by} threshold, tp, fp,
           fp / sum(alarms) OVER ({part}) AS fpr, tp / sum(hits) OVER ({part}) AS tpr,
           tp / (tp + fp) AS precision, hits, alarms,
           row_number() OVER ({part} ORDER BY threshold DESC) AS place
    FROM (SELECT {by} threshold, hits, alarms,
            sum(hits) OVER ({part} ORDER BY threshold DESC) AS tp,
            sum(alarms) OVER ({part} ORDER BY threshold DESC) AS fp
          FROM (SELECT {by} margin AS threshold, sum(label)::DOUBLE AS hits,
                       sum(1 - label)::DOUBLE AS alarms
                FROM {source} GROUP BY {by} margin))
    """


@register(
    "roc_curve",
    f"""
    SELECT {round_sql("threshold", "threshold")}, {round_sql("fpr", "fpr")}, {round_sql("tpr", "tpr")}
    FROM (SELECT threshold, fpr, tpr FROM ({_curve_sql("scored")})
          UNION ALL SELECT NULL::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE)
    """,
    ("scored",),
)
def roc_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    curve = tf.roc_curve(scored(spark, sf_dir), score="margin")
    return rounded(curve, "threshold", "fpr", "tpr")


@register(
    "pr_curve",
    f"""
    SELECT {round_sql("threshold", "threshold")}, {round_sql("recall", "recall")},
           {round_sql("precision", "precision")}
    FROM (SELECT threshold, tpr AS recall, precision FROM ({_curve_sql("scored")})
          UNION ALL
          SELECT NULL::DOUBLE, 0.0::DOUBLE, precision FROM ({_curve_sql("scored")}) WHERE place = 1)
    """,
    ("scored",),
)
def pr_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    curve = tf.pr_curve(scored(spark, sf_dir), score="margin")
    return rounded(curve, "threshold", "recall", "precision")


@register(
    "f_measure_by_threshold",
    f"""
    SELECT {round_sql("threshold", "threshold")},
           {round_sql("2 * tp / (2 * tp + fp + tp / tpr - tp)", "f_measure")}
    FROM ({_curve_sql("scored")}) WHERE tp > 0
    UNION ALL
    SELECT {round_sql("threshold", "threshold")}, 0.0::DOUBLE FROM ({_curve_sql("scored")}) WHERE tp = 0
    """,
    ("scored",),
)
def f_measure_by_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    curve = tf.f_measure_by_threshold(scored(spark, sf_dir), score="margin")
    return rounded(curve, "threshold", "f_measure")


@register(
    "auc_roc",
    f"""
    SELECT {round_sql("sum(alarms * (tp - hits / 2)) / (sum(hits) * sum(alarms))", "auc")}
    FROM ({_curve_sql("scored")})
    """,
    ("scored",),
)
def auc_roc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(tf.auc_roc(scored(spark, sf_dir), score="margin"), "auc")


@register(
    "roc_compare",
    f"""
    SELECT model, {round_sql("threshold", "threshold")}, {round_sql("fpr", "fpr")},
           {round_sql("tpr", "tpr")}
    FROM (SELECT model, threshold, fpr, tpr FROM ({_curve_sql("pair", "model")})
          UNION ALL SELECT DISTINCT model, NULL::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE FROM pair)
    """,
    ("pair",),
)
def roc_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    curve = tf.roc_curve(pair_scored(spark, sf_dir), score="margin", by=["model"])
    return rounded(curve, "threshold", "fpr", "tpr")


@register(
    "auc_compare",
    f"""
    SELECT model, {round_sql("sum(alarms * (tp - hits / 2)) / (sum(hits) * sum(alarms))", "auc")}
    FROM ({_curve_sql("pair", "model")}) GROUP BY 1
    """,
    ("pair",),
)
def auc_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(tf.auc_roc(pair_scored(spark, sf_dir), score="margin", by=["model"]), "auc")


# Model fits: SQL cannot repeat them, but states facts that every right fit has


def facts(predictions: DataFrame, by: list[str], floor: DataFrame, bounded: bool = True) -> DataFrame:
    """What SQL can say of predictions: rows, positives, wrong values, and an area not below the floor's.

    Below means by more than three standard errors of an area over so many rows of the rarer class.
    """
    score = F.col("score")
    outside = score.isNull() | F.isnan(score) | (F.lit(bounded) & ((score < 0) | (score > 1)))
    counted = predictions.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("id").alias("n_keys"),
        F.sum("label").cast("bigint").alias("positives"),
        F.count_if(F.coalesce(~F.col("prediction").isin(0.0, 1.0), F.lit(True))).alias("wrong_predictions"),
        F.count_if(outside).alias("wrong_scores"),
    )
    areas = tf.auc_roc(predictions, by=by)
    least = floor.withColumnRenamed("auc", "least")
    fewer = F.least(F.col("positives"), F.col("n_rows") - F.col("positives"))
    error = F.sqrt(F.col("least") * (1 - F.col("least")) / fewer)
    return counted.join(areas, by).join(least, by).select(
        *counted.columns, (F.col("auc") >= F.col("least") - 3 * error).alias("good_auc")
    )


def split_area(rows: DataFrame, kind: str) -> DataFrame:
    """``part, auc`` of one split of the rows, at the median of ``bmi`` in training.

    It is the floor of every fit, by one rule at all sizes: a model that the settings of
    ``kind`` allow a split at all must rank at least as well as this split. Where leaves have to
    hold more than half of the training rows there is none, and all rows score alike.
    """
    leaf = FINAL_PARAMS[kind].get("minInstancesPerNode", 1)
    train = rows.where(F.col("part") == "train").agg(
        F.count(F.lit(1)).alias("n"), F.percentile(F.col("bmi").cast("double"), F.lit(0.5)).alias("middle")
    ).first()
    allowed = F.lit(train["n"] >= 2 * leaf)
    return tf.auc_roc(
        rows.withColumn("score", (allowed & (F.col("bmi") > F.lit(train["middle"]))).cast("double")), by=["part"]
    )


FACTS_SQL = """
    count(*) AS n_rows, count(DISTINCT id) AS n_keys, sum(label)::BIGINT AS positives,
    0::BIGINT AS wrong_predictions, 0::BIGINT AS wrong_scores, TRUE AS good_auc
"""
PARTS_SQL = f"SELECT part, {FACTS_SQL} FROM parted GROUP BY 1"

_kept: dict[tuple, object] = {}


def once(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], object]):
    """What ``make`` gives, made once per application and input: fitted models and search tables.

    Queries that state facts of the same fit share it.
    """
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _kept:
        _kept[key] = make()
    return _kept[key]


def chosen_model(spark: SparkSession, sf_dir: str, kind: str) -> tf.Modelling:
    """One classifier, fitted as chosen."""
    return once(
        spark, sf_dir, f"fit_{kind}",
        lambda: tf.run_models(prepared(spark, sf_dir), "id", NUMERIC, CODED, [kind], spread=True),
    )


def all_chosen(spark: SparkSession, sf_dir: str) -> tf.Modelling:
    """All five, each fitted as chosen, scored in one scan.

    Boosted trees are many short jobs over few cells, so they are fitted beside the others.
    """
    with ThreadPoolExecutor(1) as pool:
        boosted = pool.submit(chosen_model, spark, sf_dir, "gbt")
        runs = {kind: chosen_model(spark, sf_dir, kind) for kind in CLASSIFIERS if kind != "gbt"}
        runs["gbt"] = boosted.result()
    return tf.join_models(prepared(spark, sf_dir), "id", [runs[kind] for kind in CLASSIFIERS])


def fitted(kind: str) -> Runner:
    """A query that fits one classifier as chosen, scores all rows and states facts."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        floor = split_area(tf.split_column(prepared(spark, sf_dir), "id"), kind)
        return facts(chosen_model(spark, sf_dir, kind).predictions, ["part"], floor, kind != "linear_svc")

    return run


for _kind in CLASSIFIERS:
    register({"logistic": "fit_logistic"}.get(_kind, f"fit_{_kind}"), PARTS_SQL, ("parted",))(fitted(_kind))


@register("pipeline_predict", PARTS_SQL, ("parted",))
def pipeline_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = prepared(spark, sf_dir)
    modelling = tf.run_models(rows, "id", NUMERIC, CODED, ["logistic"], fit_scope="all")
    return facts(modelling.predictions, ["part"], split_area(tf.split_column(rows, "id"), "logistic"))


@register(
    "fitted_compare",
    f"""
    SELECT model, part, n_rows, positives, TRUE AS good_accuracy, TRUE AS good_f1
    FROM (SELECT part, {FACTS_SQL} FROM parted GROUP BY 1),
         (SELECT unnest([{", ".join(f"'{kind}'" for kind in CLASSIFIERS)}]) AS model)
    """,
    ("parted",),
)
def fitted_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All five chosen models on the training and the test rows, none worse than a guess of one class."""
    modelling = all_chosen(spark, sf_dir)
    compared = modelling.comparison()
    counted = tf.confusion_matrix(modelling.predictions, by=["model", "part"]).groupBy("model", "part").agg(
        F.sum("n").alias("n_rows"), F.sum(F.when(F.col("label") == 1, F.col("n"))).alias("positives")
    )
    share = F.greatest(F.col("positives"), F.col("n_rows") - F.col("positives")) / F.col("n_rows")
    guess_f1 = share * 2 * share / (1 + share)
    return compared.join(counted, ["model", "part"]).select(
        "model", "part", "n_rows", "positives",
        # A guess of one class recalls all of it and none of the other.
        (F.col("recall_0") + F.col("recall_1") >= 1 - 1e-12).alias("good_accuracy"), (F.col("weighted_f") >= guess_f1 - 1e-12).alias("good_f1"),
    )


@register(
    "fitted_roc",
    f"""
    SELECT model, part, 1::BIGINT AS starts, 1::BIGINT AS ends, 0::BIGINT AS falls, TRUE AS good_area
    FROM (SELECT DISTINCT part FROM parted), (SELECT unnest([{", ".join(f"'{kind}'" for kind in CLASSIFIERS)}]) AS model)
    """,
    ("parted",),
)
def fitted_roc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ROC curves of all five models: each starts and ends in its corner, never falls and has its own area.

    No window spans a curve. Neighbouring points differ by the rows of one score, so each
    point is compared with the one that those rows lead from, within its bucket. The rows are scored
    once and the scores counted once, for all that is read from them.
    """
    modelling = all_chosen(spark, sf_dir)
    by = ["model", "part"]
    scores = staged(modelling.predictions.select(*by, "label", "score"), "scores")
    # Neither model nor part is ever NULL. Files do not say so, and a join that has to rule it out shares no shuffle.
    modelling = replace(modelling, predictions=scores.na.fill("", by))
    steps = staged(tf.threshold_counts(modelling.predictions, by=by), "steps")
    # What one score adds is the point's own counts; what was there before is the rest.
    before = F.col("tp") - F.col("hits")
    area = F.col("alarms") * (F.col("tp") + before) / 2
    shapes = steps.groupBy(*by).agg(
        F.count_if((before == 0) & (F.col("fp") == F.col("alarms"))).alias("starts"),
        F.count_if((F.col("tp") == F.col("positives")) & (F.col("fp") == F.col("negatives"))).alias("ends"),
        F.count_if((before < 0) | (F.col("fp") < F.col("alarms"))).alias("wrong"),
        (F.sum(area) / F.max(F.col("positives") * F.col("negatives"))).alias("area"),
    )
    curve = modelling.roc(steps).groupBy(*by).agg(
        F.count_if(F.col("threshold").isNull() & (F.col("fpr") == 0) & (F.col("tpr") == 0)).alias("corner"),
        F.count_if((F.col("fpr") == 1) & (F.col("tpr") == 1)).alias("top"),
    )
    exact = tf.auc_roc(modelling.predictions, by=by, counts=steps)
    return shapes.join(curve, by).join(exact, by).select(
        *by,
        F.least("starts", "corner").alias("starts"),
        F.least("ends", "top").alias("ends"),
        F.col("wrong").alias("falls"),
        (F.abs(F.col("area") - F.col("auc")) < 1e-9).alias("good_area"),
    )


# Grid searches: SQL states the points, and what every right search has


def parted_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training rows with their folds."""
    rows = tf.fold_column(tf.split_column(prepared(spark, sf_dir), "id"), "id", 10)
    return rows.where(F.col("part") == "train")


def searched(spark: SparkSession, sf_dir: str, kind: str = "decision_tree") -> DataFrame:
    """The table of the full grid of one kind over ten folds of the training rows."""

    def make() -> DataFrame:
        train = parted_folds(spark, sf_dir)
        if kind == "logistic":
            return tf.search_logistic(train, NUMERIC, CODED)[0]
        # Indexing sees which values a column has, nothing of the label or of how many rows hold them.
        ready = tf.fit_features(tf.tree_features(FEATURES), train)[1]
        if kind in ("gbt", "random_forest"):
            return tf.search_ensemble(kind, ready, features="indexedFeatures")[0]
        return tf.tune(kind, ready, None, "indexedFeatures", fold="fold", folds=10)[1]

    def rows() -> list:
        table_ = make()
        return [table_.schema, table_.collect()]

    schema, found = once(spark, sf_dir, f"search_{kind}", rows)
    return spark.createDataFrame(found, schema)


def grid_sql(kind: str, names: dict[str, str], extra: str) -> str:
    """All points of a kind's grid, the last setting changing fastest, with the columns of ``extra``."""
    grid = TUNING_GRIDS[kind]
    tables = ", ".join(
        "(VALUES " + ", ".join(f"('{json.dumps(value)}', {at})" for at, value in enumerate(values)) + f") t{no}({names[name]}, p{no})"
        for no, (name, values) in enumerate(grid.items())
    )
    order = ", ".join(f"p{no}" for no in range(len(grid)))
    return f"""
        SELECT (row_number() OVER (ORDER BY {order}) - 1)::INT AS grid_id, {", ".join(names[name] for name in grid)}, {extra}
        FROM {tables}
    """


def named_params(names: dict[str, str]) -> list:
    return [F.col("params")[name].alias(column) for name, column in names.items()]


def sound_area(leaf: Column, train: DataFrame) -> Column:
    """Whether a point's mean area is what its leaf size allows: above one half where any split is, else one half."""
    rows = F.lit(train.count())
    allowed = rows * 0.9 >= 2 * leaf
    return F.when(allowed, (F.col("avg_metric") > 0.5) & (F.col("avg_metric") <= 1)).otherwise(F.abs(F.col("avg_metric") - 0.5) < 1e-9)


_TREE_NAMES = {"maxBins": "max_bins", "minInstancesPerNode": "min_instances"}


@register("cv_grid", grid_sql("decision_tree", _TREE_NAMES, "'areaUnderROC' AS metric, TRUE AS in_range"))
def cv_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The decision tree's 16 points over ten folds."""
    good = sound_area(F.col("params")["minInstancesPerNode"].cast("int"), parted_folds(spark, sf_dir))
    return searched(spark, sf_dir).select(
        "grid_id", *named_params(_TREE_NAMES), "metric", (good & (F.col("fitted_as") == F.col("grid_id"))).alias("in_range")
    )


_LOGISTIC_NAMES = {
    "elasticNetParam": "elastic_net", "fitIntercept": "intercept", "maxIter": "max_iter", "family": "family", "regParam": "reg"
}


@register(
    "cv_grid_logistic",
    "SELECT grid_id, elastic_net, intercept, max_iter, family, reg, metric, in_range, solved, "
    "min(grid_id) OVER (PARTITION BY elastic_net, intercept, reg) AS fitted_as FROM ("
    + grid_sql("logistic", _LOGISTIC_NAMES, "'areaUnderROC' AS metric, TRUE AS in_range, TRUE AS solved")
    + ")",
)
def cv_grid_logistic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The logistic model's 120 points over ten folds, solved together.

    A penalty may leave no coefficient, so an area of one half is in range.
    """
    return searched(spark, sf_dir, "logistic").select(
        "grid_id", *named_params(_LOGISTIC_NAMES), "metric",
        ((F.col("avg_metric") >= 0.5) & (F.col("avg_metric") <= 1)).alias("in_range"),
        (F.col("violation") <= 1e-8).alias("solved"),
        "fitted_as",
    )


_FOREST_NAMES = {"maxDepth": "max_depth", "maxBins": "max_bins", "numTrees": "num_trees", "minInstancesPerNode": "min_instances"}


@register("cv_grid_forest", grid_sql("random_forest", _FOREST_NAMES, "'f1' AS metric, TRUE AS in_range"))
def cv_grid_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The forest's 54 points over ten folds; none worse than the commoner class as a guess."""
    share = parted_folds(spark, sf_dir).agg(F.avg("label").alias("share")).first()["share"]
    share = max(share, 1 - share)
    # Folds are not of equal balance: a tenth is left for that.
    least = 0.9 * share * 2 * share / (1 + share)
    return searched(spark, sf_dir, "random_forest").select(
        "grid_id", *named_params(_FOREST_NAMES), "metric", ((F.col("avg_metric") >= least) & (F.col("avg_metric") <= 1)).alias("in_range")
    )


@register("cv_best", "SELECT 'areaUnderROC' AS metric, TRUE AS is_largest, TRUE AS is_listed")
def cv_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best point of the search that ``cv_grid`` made, or of its own where that has not run."""
    table_ = searched(spark, sf_dir)
    best = tf.best_point(table_).select("metric", F.col("avg_metric").alias("best"), F.col("params").alias("chosen"))
    return table_.join(best, "metric").groupBy("metric").agg(
        (F.max("avg_metric") == F.max("best")).alias("is_largest"),
        F.bool_or(F.to_json("params") == F.to_json("chosen")).alias("is_listed"),
    )


# More of the operators above


@register(
    "schema_rows",
    """
    SELECT (row_number() OVER (ORDER BY ordinal_position) - 1)::INT AS position, column_name AS name
    FROM (SELECT column_name, ordinal_position FROM information_schema.columns WHERE table_name = 'lineitem')
    """,
)
def schema_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tf.schema_rows(table(spark, sf_dir, "lineitem")).select("position", "name")


@register(
    "precision_by_threshold",
    f"""
    SELECT {round_sql("threshold", "threshold")}, {round_sql("tp / (tp + fp)", "precision")}
    FROM ({_curve_sql("scored")})
    """,
    ("scored",),
)
def precision_by_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(tf.precision_by_threshold(scored(spark, sf_dir), score="margin"), "threshold", "precision")


@register(
    "recall_by_threshold",
    f"""
    SELECT {round_sql("threshold", "threshold")}, {round_sql("tpr", "recall")}
    FROM ({_curve_sql("scored")})
    """,
    ("scored",),
)
def recall_by_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(tf.recall_by_threshold(scored(spark, sf_dir), score="margin"), "threshold", "recall")


@register(
    "summary_texts",
    " UNION ALL ".join(
        f"SELECT '{name}' AS feature, count({name}) AS n, min({name}) AS min, max({name}) AS max FROM part"
        for name in ("p_name", "p_brand", "p_type")
    ),
)
def summary_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tf.summary_texts(table(spark, sf_dir, "part"), ["p_name", "p_brand", "p_type"])


@register(
    "transpose_joined",
    """
    SELECT 'n_name' AS feature, {cells} FROM nation
    """.format(
        cells=", ".join(
            f"coalesce(string_agg(n_name, ',' ORDER BY n_name) FILTER (WHERE n_regionkey = {k}), '') AS \"{k}\""
            for k in range(5)
        )
    ),
)
def transpose_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several rows share a pivot value: their cells are joined."""
    rows = table(spark, sf_dir, "nation").select("n_regionkey", "n_name")
    return tf.transpose(rows, "n_regionkey", list(range(5)), joined=",")


@register(
    "unmatched_codes",
    """
    SELECT feature, code, n FROM (
      SELECT 'genhlth' AS feature, genhlth::VARCHAR AS code, count(*) AS n FROM survey GROUP BY 2
      UNION ALL SELECT 'checkup', checkup::VARCHAR, count(*) FROM survey GROUP BY 2)
    WHERE code NOT IN ('1', '2', '9') AND NOT (feature = 'checkup' AND code = '8')
    """,
    ("survey",),
)
def unmatched_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = spark.createDataFrame(
        [(name, code) for name in ("genhlth", "checkup") for code in ("1", "2")], "feature string, code string"
    )
    rules = [tf.drop("genhlth", 9), tf.drop("checkup", 9), tf.recode("checkup", 8, 0)]
    return tf.unmatched_codes(survey(spark, sf_dir), ["genhlth", "checkup"], listed, rules)


@register(
    "one_hot_observed",
    "SELECT id, "
    + ", ".join(f"(genhlth = {code})::INT AS genhlth_{code}" for code in (1, 2, 3, 4, 9))
    + ", "
    + ", ".join(f"(michd = {code})::INT AS michd_{code}" for code in (1, 2))
    + " FROM survey",
    ("survey",),
)
def one_hot_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tf.one_hot_observed(survey(spark, sf_dir).select("id", "genhlth", "michd"), ["genhlth", "michd"])


@register(
    "feature_details",
    """
    SELECT c.feature, c.code, c.n, f.feature_no, t.short_text, b.question, b.responses FROM (
      SELECT 'diag' AS feature, diag::VARCHAR AS code, count(*) AS n FROM survey GROUP BY 2
      UNION ALL SELECT 'michd', michd::VARCHAR, count(*) FROM survey GROUP BY 2) c
    JOIN (VALUES ('diag', 0), ('michd', 1)) f(feature, feature_no) USING (feature)
    LEFT JOIN (SELECT CASE n_nationkey WHEN 0 THEN 'diag' WHEN 1 THEN 'michd' END AS feature, n_name AS short_text
               FROM nation WHERE n_nationkey < 2) t USING (feature)
    LEFT JOIN (SELECT CASE n_regionkey WHEN 0 THEN 'diag' WHEN 1 THEN 'michd' END AS feature,
                      min(n_name) AS question, arg_min('key ' || n_nationkey, n_name) AS responses
               FROM nation WHERE n_regionkey < 2 GROUP BY 1) b USING (feature)
    """,
    ("survey",),
)
def feature_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Question, responses and code counts of two columns; the nations stand for the codebook."""
    nation = table(spark, sf_dir, "nation")

    def named_by(key: str):
        return F.when(F.col(key) == 0, "diag").when(F.col(key) == 1, "michd").alias("feature")

    texts = nation.where("n_nationkey < 2").select(named_by("n_nationkey"), F.col("n_name").alias("short_text"))
    book = nation.where("n_regionkey < 2").select(
        named_by("n_regionkey"),
        F.lit(2020).alias("year"),
        F.col("n_name").alias("question"),
        F.concat(F.lit("key "), F.col("n_nationkey").cast("string")).alias("responses"),
    )
    return tf.feature_details(survey(spark, sf_dir), ["diag", "michd"], texts, book, 2020)
