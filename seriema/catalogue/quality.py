"""Data-quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality as q
from .inputs import events, observations, table
from .registry import query


def _checked(spark, path):
    """Orders with missing and out-of-range values and repeated keys."""
    n = F.col("t")
    return observations(spark, path).select(
        F.when(n % 10 != 0, F.col("date")).alias("date"),
        F.when(n % 25 != 0, F.col("value")).alias("value"), "k",
        (n % 4000).alias("id"),
    )


_CHECKED = """
chk AS (SELECT CASE WHEN o_orderkey % 10 <> 0 THEN o_orderdate END AS date,
               CASE WHEN o_orderkey % 25 <> 0 THEN o_totalprice END AS value,
               o_orderpriority AS k, o_orderkey % 4000 AS id FROM orders)"""


def _line(check: str, column: str | None, metric: str, passed: str) -> str:
    # A constant still needs an aggregate, for one line per check.
    metric = f"max({metric})" if metric.isdigit() else metric
    name = f"'{column}'" if column else "CAST(NULL AS VARCHAR)"
    return (f"SELECT '{check}' AS \"check\", {name} AS \"column\", "
            f"CAST({metric} AS DOUBLE) AS metric, {passed} AS passed FROM chk")


def _rows(df):
    return df.withColumn("metric", F.round("metric", 6))


_PRESENCE = (_line("presence", "date", "least(count(*), 1)", "count(*) > 0"),
             _line("presence", "value", "least(count(*), 1)", "count(*) > 0"),
             _line("presence", "indicator", "0", "false"))
_TYPES = (_line("type", "date", "1", "true"), _line("type", "value", "1", "true"),
          _line("type", "k", "0", "false"), _line("type", "id", "1", "true"))
_OUTSIDE = "count(*) FILTER (WHERE value < 10000 OR value > 400000)"
_RANGES = (_line("range", "value", _OUTSIDE, f"{_OUTSIDE} = 0"),
           _line("range", "id", "0", "true"))
_NULLS = tuple(
    _line("null_share", c, f"round(100.0 * (count(*) - count({c})) / count(*), 6)",
          f"100.0 * (count(*) - count({c})) / count(*) <= 5")
    for c in ("date", "value", "k", "id")
)
_ROWS = (_line("rows", None, "count(*)", "count(*) > 0"),)
_EXTRA = "count(*) - count(DISTINCT (id, k))"
_DUPLICATES = (_line("duplicates", None, _EXTRA, f"{_EXTRA} = 0"),)

_TYPE_MAP = {"date": "datetime", "value": "numeric", "k": "boolean", "id": "bigint", "gone": "string"}
_RANGE_MAP = {"value": (10000.0, 400000.0), "id": (0, 3999), "k": (0, 1)}


def _union(*lines: str) -> str:
    return f"WITH {_CHECKED} " + " UNION ALL ".join(lines)


@query("j01_column_presence", _union(*_PRESENCE))
def presence(spark, path):
    return _rows(q.check_columns(_checked(spark, path), ["date", "value", "indicator"]))


@query("j02_types", _union(*_TYPES))
def types(spark, path):
    return _rows(q.check_types(_checked(spark, path), _TYPE_MAP))


@query("j03_value_ranges", _union(*_RANGES))
def ranges(spark, path):
    return _rows(q.check_ranges(_checked(spark, path), _RANGE_MAP))


@query("j04_null_share", _union(*_NULLS))
def nulls(spark, path):
    return _rows(q.check_nulls(_checked(spark, path)))


@query("j05_duplicates", _union(*_DUPLICATES))
def duplicates(spark, path):
    return _rows(q.check_duplicates(_checked(spark, path), ["id", "k"]))


_ALL = (*_PRESENCE, *_TYPES, *_RANGES, *_NULLS, *_ROWS, *_DUPLICATES)


@query("j06_validate", f"""
WITH {_CHECKED}, checks AS ({" UNION ALL ".join(_ALL)})
SELECT * FROM checks UNION ALL
SELECT 'dataset', NULL, count(*) FILTER (WHERE NOT passed), count(*) FILTER (WHERE NOT passed) = 0
FROM checks""")
def validate(spark, path):
    return _rows(q.validate(
        _checked(spark, path), ["date", "value", "indicator"], _TYPE_MAP, _RANGE_MAP,
        subset=["id", "k"],
    ))


@query("j07_layer_contract", f"""
WITH {_CHECKED}, m AS (SELECT k AS indicator, max(value) AS last_value, max(date) AS last_date
                       FROM chk GROUP BY k)
SELECT 'presence' AS "check", c AS "column", CAST(1 AS DOUBLE) AS metric, true AS passed,
       'error' AS severity FROM (VALUES ('indicator'), ('last_value'), ('last_date')) v(c)
UNION ALL SELECT 'null_share', c, 0, true, 'warn'
       FROM (VALUES ('indicator'), ('last_value'), ('last_date')) v(c)
UNION ALL SELECT 'rows', NULL, count(*), count(*) >= 3, 'warn' FROM m
UNION ALL SELECT 'expected_indicator', c, 0, false, 'warn'
       FROM (VALUES ('ipca'), ('selic'), ('cambio'), ('desemprego'), ('economic_health')) v(c)""")
def contract(spark, path):
    """Priorities are none of the indicators that the dashboard must list."""
    table_like = _checked(spark, path).groupBy(F.col("k").alias("indicator")).agg(
        F.max("value").alias("last_value"), F.max("date").alias("last_date")
    )
    return _rows(q.check_contract(table_like, "macro_dashboard"))


@query("j08_profile", f"""
WITH {_CHECKED},
p AS (SELECT count(*) AS r, count(*) - count(date) AS d, count(*) - count(value) AS v FROM chk)
SELECT 'date' AS "column", 'date' AS dtype, r AS rows, d AS nulls, round(100.0 * d / r, 6) AS null_pct
FROM p
UNION ALL SELECT 'value', 'double', r, v, round(100.0 * v / r, 6) FROM p
UNION ALL SELECT 'k', 'string', r, 0, 0 FROM p
UNION ALL SELECT 'id', 'bigint', r, 0, 0 FROM p
UNION ALL SELECT '*', NULL, r, d + v, NULL FROM p""")
def profile(spark, path):
    return q.profile(_checked(spark, path)).withColumn("null_pct", F.round("null_pct", 6))


@query("j09_not_empty", """
SELECT 'rows' AS "check", CAST(NULL AS VARCHAR) AS "column", CAST(count(*) AS DOUBLE) AS metric,
       count(*) > 0 AS passed FROM events
UNION ALL SELECT 'rows', NULL, 0, false""")
def not_empty(spark, path):
    """The whole table, and a filter that leaves nothing."""
    df = events(spark, path)
    none = table(spark, path, "events").filter(F.col("value") < 0)
    return q.check_not_empty(df).unionByName(q.check_not_empty(none))
