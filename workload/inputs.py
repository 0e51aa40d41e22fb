"""The given tables, and the coded survey table derived from ``orders``.

The table has what the operators have to cope with: refusal codes, sentinels, an
all-NULL, a sparse, a NaN-holding, a text and a constant column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyframe import Rule, below, drop, read_table, recode

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# One expression per column, in SQL that Spark and DuckDB both read.
SURVEY_COLUMNS = {
    "id": "o_orderkey",
    "diag": (
        "CASE WHEN o_orderstatus = 'P' AND o_orderkey % 3 = 0 THEN 7 "
        "WHEN o_totalprice + (o_orderkey * 7919) % 200000 > 480000 THEN 1 ELSE 3 END"
    ),
    "genhlth": (
        "CASE WHEN o_orderpriority = '5-LOW' THEN 9 "
        "ELSE CAST(substr(o_orderpriority, 1, 1) AS INT) END"
    ),
    "alcday": (
        "CAST(CASE WHEN o_orderkey % 10 = 0 THEN 888 WHEN o_orderkey % 10 = 1 THEN 999 "
        "ELSE 100 + o_custkey % 7 END AS INT)"
    ),
    "checkup": (
        "CAST(CASE WHEN o_orderkey % 9 = 0 THEN 8 WHEN o_orderkey % 9 = 1 THEN 9 "
        "ELSE 1 + o_orderkey % 3 END AS INT)"
    ),
    "michd": "CAST(1 + o_custkey % 2 AS INT)",
    "bmi": (
        "CASE WHEN o_orderkey % 40 = 0 THEN 6000 + o_totalprice / 100 "
        "ELSE o_totalprice / 100 END"
    ),
    "allnull": "CAST(NULL AS DOUBLE)",
    "sparse": "CASE WHEN o_orderkey % 10 < 3 THEN o_totalprice END",
    "half99": "CAST(CASE WHEN o_orderkey % 2 = 0 THEN 99 ELSE o_orderkey % 5 END AS INT)",
    "nanny": "CASE WHEN o_orderkey % 50 = 0 THEN CAST('NaN' AS DOUBLE) ELSE o_totalprice END",
    "txt": (
        "CASE o_orderkey % 8 WHEN 0 THEN 'NA' WHEN 1 THEN '' WHEN 2 THEN 'None' "
        "WHEN 3 THEN 'BANANA' ELSE 'ok' END"
    ),
    "konst": "CAST(7.0 AS DOUBLE)",
}

SURVEY_SQL = "SELECT {} FROM orders".format(
    ", ".join(f"{expr} AS {name}" for name, expr in SURVEY_COLUMNS.items())
)

# The codes that mean yes and no in ``diag``.
YES, NO = 1, 3

RULES: list[Rule] = [
    drop("genhlth", 9),
    drop("alcday", 999),
    recode("alcday", 888, 0),
    drop("checkup", 9),
    recode("checkup", 8, 0),
    recode("michd", 2, 0),
    below("bmi", 6000),
]

NUMERIC = ["bmi", "alcday", "michd"]
CODED = ["genhlth", "checkup"]
FEATURES = [*NUMERIC, *CODED]

PREPARED_SQL = """
    SELECT id, CASE WHEN diag = 1 THEN 1 ELSE 0 END AS label, bmi,
           CASE WHEN alcday = 888 THEN 0 ELSE alcday END AS alcday,
           CASE WHEN michd = 2 THEN 0 ELSE michd END AS michd,
           genhlth,
           CASE WHEN checkup = 8 THEN 0 ELSE checkup END AS checkup
    FROM survey
    WHERE diag IN (1, 3) AND genhlth <> 9 AND alcday <> 999 AND checkup <> 9 AND bmi < 6000
"""


def hash_unit_sql(key: str, stream: str = "", seed: int = 42) -> str:
    """The unit number of a key, in DuckDB's SQL."""
    prefix = f"{seed}:{stream}:" if stream else f"{seed}:"
    return (
        f"(('0x' || substr(md5('{prefix}' || {key}::VARCHAR), 1, 8))::BIGINT / 4294967296.0::DOUBLE)"
    )


PART_SQL = f"CASE WHEN {hash_unit_sql('id')} < 0.8::DOUBLE THEN 'train' ELSE 'test' END"

# Known weights of a logistic model over the prepared columns, and of a weaker one.
WEIGHTS = {"bmi": 0.002, "genhlth": -0.05, "checkup": 0.03, "michd": -0.1}
INTERCEPT = -7.0
WEAK_WEIGHTS = {"bmi": 0.0004, "genhlth": 0.4, "checkup": -0.2}
WEAK_INTERCEPT = -1.5


def margin_sql(weights: dict[str, float], intercept: float) -> str:
    """The linear score in SQL, terms added in the order of the weights."""
    margin = f"{intercept}::DOUBLE"
    for name, weight in weights.items():
        margin = f"({margin} + {name} * {weight}::DOUBLE)"
    return margin


def _scored_sql(weights: dict[str, float], intercept: float) -> str:
    return f"""
        SELECT *, CASE WHEN score > 0.5::DOUBLE THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction
        FROM (SELECT *, 1.0::DOUBLE / (1.0::DOUBLE + exp(-margin)) AS score
              FROM (SELECT *, {margin_sql(weights, intercept)} AS margin FROM prepared))
    """


SCORED_SQL = _scored_sql(WEIGHTS, INTERCEPT)
WEAK_SQL = _scored_sql(WEAK_WEIGHTS, WEAK_INTERCEPT)


def with_views(sql: str, *views: str) -> str:
    """Put the definitions of the derived tables before a query that names them."""
    texts = {
        "survey": SURVEY_SQL,
        "prepared": PREPARED_SQL,
        "scored": SCORED_SQL,
        "weak": WEAK_SQL,
        "parted": f"SELECT *, {PART_SQL} AS part FROM prepared",
        "pair": (
            "SELECT id, label, 'strong' AS model, margin, prediction FROM scored "
            "UNION ALL SELECT id, label, 'weak' AS model, margin, prediction FROM weak"
        ),
    }
    needs = {
        "prepared": ["survey"],
        "scored": ["survey", "prepared"],
        "weak": ["survey", "prepared"],
        "parted": ["survey", "prepared"],
        "pair": ["survey", "prepared", "scored", "weak"],
    }
    wanted: list[str] = []
    for view in views:
        for name in [*needs.get(view, []), view]:
            if name not in wanted:
                wanted.append(name)
    parts = ", ".join(f"{name} AS ({texts[name].strip()})" for name in wanted)
    return f"WITH RECURSIVE {parts} {sql.strip()}" if parts else sql.strip()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return read_table(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The coded survey table."""
    return table(spark, sf_dir, "orders").selectExpr(
        *[f"{expr} AS {name}" for name, expr in SURVEY_COLUMNS.items()]
    )
