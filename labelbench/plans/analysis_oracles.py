"""SQL with the same results as the analysis queries."""

from __future__ import annotations

from itertools import combinations

from labelbench.operators.sensitivity import LEVELS
from labelbench.plans.analysis_queries import RANKED
from labelbench.plans.oracles import (
    _ITEM_KEY,
    _SEPARABLE_TEST,
    _URGENT,
    NB_MODEL,
    SAMPLES,
    _is_train,
    _report,
)
from labelbench.sources.tables import TEXT_FEATURES

# --- sensitivity -------------------------------------------------------------------------------

_STATS = ", ".join(f"{f}({c}) AS {f}_{c}" for c in TEXT_FEATURES for f in ("min", "max", "avg"))


def _probe(moved: str) -> str:
    values = ", ".join(
        f"min_{c} + (max_{c} - min_{c}) * level / {LEVELS - 1} AS {c}" if c == moved else f"avg_{c} AS {c}"
        for c in TEXT_FEATURES
    )
    return f"SELECT '{moved}' AS input, level, {values} FROM stats, (SELECT unnest(range({LEVELS})) AS level)"


_MARGIN = "m1.log_prior - m0.log_prior + " + " + ".join(f"(m1.{f} - m0.{f}) * p.{f}" for f in TEXT_FEATURES)
NB_SENSITIVITY = f"""
WITH {NB_MODEL},
stats AS (SELECT {_STATS} FROM train),
probes AS ({' UNION ALL '.join(_probe(f) for f in TEXT_FEATURES)}),
scored AS (
  SELECT input, level, {_MARGIN} AS value FROM probes p
  JOIN model m0 ON m0.label = 0 JOIN model m1 ON m1.label = 1
),
steps AS (
  SELECT *, abs(value - lag(value) OVER (PARTITION BY input ORDER BY level)) AS step FROM scored
),
ranges AS (
  SELECT input, min(value) AS low, max(value) AS high, max(value) - min(value) AS range,
         avg(step) AS gradient, var_samp(value) AS variance
  FROM steps GROUP BY input
)
SELECT input, round(low, 6) AS low, round(high, 6) AS high, round(range, 6) AS range,
       round(gradient, 6) AS gradient, round(variance, 6) AS variance,
       round(range / sum(range) OVER (), 6) AS importance
FROM ranges"""

# --- trees, subgradients -----------------------------------------------------------------------

_URGENT_SCORED = f"""
scored AS (
  SELECT CAST(CASE WHEN {_URGENT} THEN 1 ELSE 0 END AS DOUBLE) AS label, label AS prediction
  FROM orders WHERE NOT ({_is_train('o_orderkey')})
)"""


def _staged(trees: int) -> str:
    return f"""
SELECT CAST(n_trees AS INTEGER) AS n_trees, n, CAST(0 AS BIGINT) AS n_errors, CAST(0 AS DOUBLE) AS test_error
FROM (SELECT count(*) AS n FROM orders WHERE NOT ({_is_train('o_orderkey')})),
     unnest(range(1, {trees} + 1)) t(n_trees)"""


# A tree needs a leaf for each run of one label along the priorities: the least depth with so many is best.
_BANDS = """
runs AS (
  SELECT 1 + count(*) FILTER (good <> before) AS n FROM (
    SELECT good, lag(good) OVER (ORDER BY priority) AS before FROM (
      SELECT DISTINCT CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority,
             priority BETWEEN 2 AND 3 AS good
      FROM orders))
),
points AS (SELECT depth, depth >= ceil(log2(n)) AS separates FROM runs, unnest([1, 2, 3]) t(depth)),
found AS (
  SELECT 'numTrees=5, maxDepth=' || depth AS model,
         separates AND depth = min(depth) FILTER (separates) OVER () AS best, separates
  FROM points
)"""

# --- features ----------------------------------------------------------------------------------


def _fences(source: str, by: str, features: list[str]) -> str:
    """Quartiles are the values at the ranks that the first and third quarter of the rows end with."""
    long = " UNION ALL ".join(
        f"SELECT {by}, '{f}' AS feature, CAST({f} AS DOUBLE) AS value FROM {source} WHERE {f} IS NOT NULL"
        for f in features
    )
    return f"""
long AS ({long}),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY {by}, feature ORDER BY value) AS place,
         count(*) OVER (PARTITION BY {by}, feature) AS n
  FROM long
),
quartiles AS (
  SELECT {by}, feature, max(n) AS n, max(value) FILTER (place = ceil(0.25 * n)) AS lower_quartile,
         max(value) FILTER (place = ceil(0.75 * n)) AS upper_quartile
  FROM ranked GROUP BY {by}, feature
),
fences AS (
  SELECT *, lower_quartile - 1.5 * (upper_quartile - lower_quartile) AS low,
         upper_quartile + 1.5 * (upper_quartile - lower_quartile) AS high
  FROM quartiles
)"""


def _ranks(source: str, columns: list[str]) -> str:
    ranked = ", ".join(
        f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2 AS {c}" for c in columns
    )
    pairs = " UNION ALL ".join(
        f"SELECT '{a}' AS \"left\", '{b}' AS \"right\", round(corr({a}, {b}), 6) AS corr FROM ranked"
        for a, b in combinations(columns, 2)
    )
    return f"ranked AS (SELECT {ranked} FROM {source}) {pairs}"


# --- splits ------------------------------------------------------------------------------------

_CLASS_SPLIT = """
placed AS (
  SELECT o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY o_orderpriority
           ORDER BY ('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 15))::BIGINT) AS place,
         count(*) OVER (PARTITION BY o_orderpriority) AS n
  FROM orders
),
tagged AS (
  SELECT o_orderkey, o_orderpriority,
         CASE WHEN place <= (n * 80 + 50) // 100 THEN 'train' ELSE 'test' END AS split
  FROM placed
)"""

ORACLES: dict[str, str] = {
    "nb_sensitivity": NB_SENSITIVITY,
    **{
        f"{short}_expression_orders": f"WITH {_URGENT_SCORED}, {_report('scored', model=f'{name}, columns')}"
        for short, name in (("dt", "decision_tree"), ("rf", "random_forest"), ("gbt", "boosted_trees"))
    },
    "rf_staged_orders": _staged(40),
    "gbt_staged_orders": _staged(40),
    "depth_cross_validation_orders": f"""
WITH {_BANDS}
SELECT model, best, separates, CASE WHEN best THEN CAST(0 AS BIGINT) END AS n_wrong FROM found""",
    "depth_holdout_search_orders": f"WITH {_BANDS} SELECT model, best, separates FROM found",
    "svm_subgradient_items": f"WITH {_SEPARABLE_TEST}, {_report('scored', model='linear_svm, subgradients')}",
    "svr_items": f"SELECT count(*) AS n, count(*) AS n_within, true AS in_tube FROM lineitem WHERE NOT ({_is_train(_ITEM_KEY)})",
    "fence_outliers": f"""
WITH {SAMPLES}, {_fences('samples', 'label', TEXT_FEATURES)}
SELECT doc_id, label, feature, value, low, high
FROM ({' UNION ALL '.join(
        f"SELECT doc_id, label, '{f}' AS feature, {f} AS value FROM samples" for f in TEXT_FEATURES
    )}) JOIN fences USING (label, feature)
WHERE value < low OR value > high""",
    "class_fences": f"""
WITH {_fences('lineitem', 'l_returnflag', ['l_quantity', 'l_discount'])}
SELECT l_returnflag, feature, n, round(lower_quartile, 6) AS lower_quartile,
       round(upper_quartile, 6) AS upper_quartile, round(low, 6) AS low, round(high, 6) AS high
FROM fences""",
    "rank_correlation": f"WITH {SAMPLES}, {_ranks('samples', ['label', *TEXT_FEATURES])}",
    "rank_correlation_items": f"""
WITH items AS (SELECT greatest(l_quantity, 17) AS quantity, * FROM lineitem), {_ranks('items', RANKED)}""",
    "stepwise_items": """
WITH items AS (SELECT 3 * l_discount + l_tax AS target, * FROM lineitem)
SELECT CAST(1 AS INTEGER) AS step, 'in' AS action, 'l_discount' AS feature,
       round(regr_r2(target, l_discount), 6) AS explained FROM items
UNION ALL SELECT 2, 'in', 'l_tax', CAST(1 AS DOUBLE)""",
    "class_split_orders": f"WITH {_CLASS_SPLIT} SELECT * FROM tagged",
    "class_split_counts": f"""
WITH {_CLASS_SPLIT} SELECT o_orderpriority, split, count(*) AS n FROM tagged GROUP BY ALL""",
    "csv_scan_typed": """
SELECT CAST(o_orderkey AS INTEGER) AS whole, o_orderkey * 10000000000 AS large, o_totalprice AS price,
       strftime(o_orderdate, '%Y-%m-%d') AS day, strftime(o_orderdate, '%Y-%m-%d 10:20:30') AS time,
       'date timestamp' AS types,
       o_orderkey % 2 = 0 AS even,
       CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'x' END || o_orderkey AS mixed, CAST(NULL AS VARCHAR) AS nothing,
       CASE WHEN o_orderkey % 5 = 0 THEN CAST(o_orderkey % 100 AS INTEGER) END AS gaps
FROM orders""",
    "malformed_by_file": """
SELECT CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS n_lines,
       count(*) FILTER (l_orderkey % 10 IN (3, 7) OR l_quantity IS NULL OR l_extendedprice IS NULL
         OR l_discount IS NULL OR l_tax IS NULL) AS n_malformed
FROM lineitem GROUP BY 1""",
    "roc_state_items": """
WITH binned AS (
  SELECT l_linestatus, least(31, floor(l_quantity / 51 * 32)) AS bin,
         CAST(count(*) FILTER (l_returnflag = 'R') AS DOUBLE) AS pos,
         CAST(count(*) FILTER (l_returnflag <> 'R') AS DOUBLE) AS neg
  FROM lineitem WHERE l_quantity IS NOT NULL GROUP BY 1, 2
), cumulated AS (
  SELECT *, sum(neg) OVER (PARTITION BY l_linestatus ORDER BY bin) - neg AS below FROM binned
)
SELECT l_linestatus, CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg,
       CASE WHEN sum(pos) * sum(neg) > 0 THEN round(sum(pos * (below + neg / 2)) / sum(pos) / sum(neg), 6) END AS roc,
       CASE WHEN sum(pos) * sum(neg) > 0 THEN round(sum(pos * neg / 2) / sum(pos) / sum(neg), 6) END AS bound
FROM cumulated GROUP BY 1""",
}
