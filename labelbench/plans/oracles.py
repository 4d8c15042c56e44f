"""SQL with the same results as the queries, for engines that read the same tables."""

from __future__ import annotations

from itertools import combinations

from labelbench.operators.tuning import DEPTHS, TREES
from labelbench.plans.queries import GOOD_SIZE_FROM, ITEM_FEATURES
from labelbench.sources.tables import TEXT_FEATURES


def _digest(key: str, start: int) -> str:
    return f"(('0x' || substr(md5(CAST({key} AS VARCHAR)), {start}, 8))::BIGINT)"


def _is_train(key: str) -> str:
    return f"{_digest(key, 1)} % 100 < 80"


def _fold(key: str) -> str:
    return f"CAST({_digest(key, 9)} % 3 AS INTEGER)"


def _good(quality: str, good_from: float = GOOD_SIZE_FROM) -> str:
    return (
        f"CASE WHEN {quality} < {good_from} THEN CAST(0 AS DOUBLE) "
        f"WHEN {quality} >= {good_from} THEN CAST(1 AS DOUBLE) END"
    )


def _without(pattern: str) -> str:
    return f"CAST(length(text) - length(regexp_replace(text, '{pattern}', '', 'g')) AS DOUBLE)"


QUANTITY = "CAST(floor(l_quantity) AS INTEGER)"
SAMPLES = f"""
samples AS (
  SELECT d.doc_id, CAST(l.quality AS DOUBLE) AS label,
         CAST(d.n_chars AS DOUBLE) AS f_chars,
         CAST(length(text) - length(replace(text, ' ', '')) AS DOUBLE) AS f_spaces,
         CAST(length(text) - length(replace(text, chr(10), '')) AS DOUBLE) AS f_newlines,
         {_without('[A-Z]')} AS f_upper,
         {_without('[.,;:!?]')} AS f_punct
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id
  WHERE d.text IS NOT NULL AND d.n_chars IS NOT NULL AND l.quality IS NOT NULL
)"""
TRAIN_TEST = f"""{SAMPLES},
train AS (SELECT * FROM samples WHERE {_is_train('doc_id')}),
test AS (SELECT * FROM samples WHERE NOT ({_is_train('doc_id')}))"""
ITEMS = f"""
items AS (
  SELECT *, {_good(QUANTITY)} AS label FROM lineitem WHERE l_quantity IS NOT NULL
)"""

# --- Naive Bayes -------------------------------------------------------------------------------

_MASS = " + ".join(TEXT_FEATURES)
NB_MODEL = f"""{TRAIN_TEST},
sums AS (
  SELECT label, count(*) AS n, {', '.join(f'sum({f}) AS {f}' for f in TEXT_FEATURES)}
  FROM train GROUP BY label
),
model AS (
  SELECT label, ln(n + 1) - ln(sum(n) OVER () + count(*) OVER ()) AS log_prior,
         {', '.join(f'ln({f} + 1) - ln({_MASS} + {len(TEXT_FEATURES)}) AS {f}' for f in TEXT_FEATURES)}
  FROM sums
)"""


def _score(model: str) -> str:
    return f"{model}.log_prior + " + " + ".join(f"{model}.{f} * test.{f}" for f in TEXT_FEATURES)


NB_SCORED = f"""{NB_MODEL},
scores AS (
  SELECT test.doc_id, test.label, {_score('m0')} AS score_0, {_score('m1')} AS score_1
  FROM test
  JOIN model m0 ON m0.label = 0
  JOIN model m1 ON m1.label = 1
),
scored AS (
  SELECT doc_id, label, score_1 - score_0 AS margin,
         CAST(CASE WHEN score_1 > score_0 THEN 1 ELSE 0 END AS DOUBLE) AS prediction
  FROM scores
)"""


def _cv_score(c: int) -> str:
    mass = " + ".join(f"m.{f}_{c}" for f in TEXT_FEATURES)
    weighted = " + ".join(
        f"(ln(m.{f}_{c} + s) - ln({mass} + {len(TEXT_FEATURES)} * s)) * r.{f}"
        for f in TEXT_FEATURES
    )
    return f"ln(m.n_{c} + s) - ln(m.n_0 + m.n_1 + 2 * s) + {weighted}"


_FOLD_SUMS = ", ".join(
    [f"count(*) FILTER (label = {c}) AS n_{c}" for c in (0, 1)]
    + [
        f"coalesce(sum({f}) FILTER (label = {c}), 0) AS {f}_{c}"
        for f in TEXT_FEATURES
        for c in (0, 1)
    ]
)
_FOLD_COLUMNS = [f"n_{c}" for c in (0, 1)] + [f"{f}_{c}" for f in TEXT_FEATURES for c in (0, 1)]
NB_SEARCH = f"""
WITH {TRAIN_TEST},
folded AS (SELECT *, {_fold('doc_id')} AS fold FROM train),
sums AS (SELECT fold, {_FOLD_SUMS} FROM folded GROUP BY fold),
others AS (
  SELECT fold, {', '.join(f'sum({c}) OVER () - {c} AS {c}' for c in _FOLD_COLUMNS)} FROM sums
),
errors AS (
  SELECT s AS smoothing, r.fold AS fold, count(*) AS n,
         count(*) FILTER (
           CASE WHEN {_cv_score(1)} > {_cv_score(0)} THEN 1 ELSE 0 END <> r.label
         ) AS n_errors
  FROM folded r JOIN others m ON r.fold = m.fold,
       (SELECT unnest([0.5, 1.0, 2.0])::DOUBLE AS s)
  GROUP BY ALL
),
means AS (
  SELECT *, n_errors / n AS test_error,
         round(avg(n_errors / n) OVER (PARTITION BY smoothing), 9) AS mean_error
  FROM errors
)
SELECT smoothing, fold, n, n_errors, round(test_error, 6) AS test_error,
       round(mean_error, 6) AS mean_error,
       smoothing = (SELECT smoothing FROM means ORDER BY mean_error, smoothing LIMIT 1) AS best
FROM means"""

# --- metrics -----------------------------------------------------------------------------------


def _report(source: str, model: str | None = None, by: str | None = None) -> str:
    """Counts, error rate and both areas over (prediction, label) rows of ``source``."""
    name = f"'{model}' AS model, " if model else ""
    group = f"{by}, " if by else ""
    return f"""
counted AS (
  SELECT {group}count(*) AS n, count(*) FILTER (label = 1) AS n_pos,
         count(*) FILTER (label = 0) AS n_neg,
         count(*) FILTER (prediction <> label) AS n_errors,
         count(*) FILTER (prediction = 1 AND label = 1) AS tp,
         count(*) FILTER (prediction = 1 AND label = 0) AS fp
  FROM {source} WHERE prediction IS NOT NULL AND label IS NOT NULL
  {f'GROUP BY {by}' if by else ''}
),
rates AS (
  SELECT *, tp / n_pos AS recall, fp / n_neg AS fall_out, n_pos / (n_pos + n_neg) AS base_rate,
         CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE n_pos / (n_pos + n_neg) END AS prec
  FROM counted
)
SELECT {name}{group}n, n_pos, n_neg, n_errors, round(n_errors / n, 6) AS test_error,
       CASE WHEN n_pos > 0 AND n_neg > 0
            THEN round((1 + recall - fall_out) / 2, 6) END AS roc,
       CASE WHEN n_pos > 0 AND n_neg > 0
            THEN round(recall * prec + (1 - recall) * (prec + base_rate) / 2, 6) END AS pr
FROM rates"""


def _rank_sum(source: str, by: str | None = None) -> str:
    """Area under ROC from average ranks; ``source`` has score and label."""
    group = f"{by}, " if by else ""
    partition = f"PARTITION BY {by} " if by else ""
    return f"""
ranked AS (
  SELECT {group}label,
         rank() OVER ({partition}ORDER BY score)
           + (count(*) OVER (PARTITION BY {group}score) - 1) / 2 AS avg_rank
  FROM {source} WHERE score IS NOT NULL AND label IS NOT NULL
),
totals AS (
  SELECT {group}count(*) FILTER (label = 1) AS n_pos, count(*) FILTER (label = 0) AS n_neg,
         sum(avg_rank) FILTER (label = 1) AS rank_sum
  FROM ranked {f'GROUP BY {by}' if by else ''}
)
SELECT {group}n_pos, n_neg,
       CASE WHEN n_pos > 0 AND n_neg > 0 THEN
         round((rank_sum - n_pos * (n_pos + 1) / 2) / n_pos / n_neg, 6) END AS roc
FROM totals"""


def _gini(source: str, features: list[str], round_threshold: bool) -> str:
    threshold = "round(threshold, 6)" if round_threshold else "threshold"
    long = " UNION ALL ".join(
        f"SELECT '{f}' AS feature, {f} AS value, label FROM {source} WHERE {f} IS NOT NULL"
        for f in features
    )
    return f"""
long AS ({long}),
counts AS (
  SELECT feature, value, CAST(count(*) FILTER (label = 0) AS DOUBLE) AS zeros,
         CAST(count(*) FILTER (label = 1) AS DOUBLE) AS ones
  FROM long GROUP BY feature, value
),
sides AS (
  SELECT feature, (value + lead(value) OVER w) / 2 AS threshold,
         sum(zeros) OVER w AS zl, sum(ones) OVER w AS ol,
         sum(zeros) OVER f - sum(zeros) OVER w AS zr, sum(ones) OVER f - sum(ones) OVER w AS rr
  FROM counts
  WINDOW w AS (PARTITION BY feature ORDER BY value), f AS (PARTITION BY feature)
),
gains AS (
  SELECT *, round(
    (1 - power((zl + zr) / (zl + zr + ol + rr), 2) - power((ol + rr) / (zl + zr + ol + rr), 2))
    - (zl + ol) / (zl + zr + ol + rr)
      * (1 - power(zl / (zl + ol), 2) - power(ol / (zl + ol), 2))
    - (zr + rr) / (zl + zr + ol + rr)
      * (1 - power(zr / (zr + rr), 2) - power(rr / (zr + rr), 2)), 12) AS gain
  FROM sides WHERE threshold IS NOT NULL
)
SELECT feature, {threshold} AS threshold, round(gain, 6) AS gain,
       CAST(zl + ol AS BIGINT) AS n_left, CAST(zr + rr AS BIGINT) AS n_right
FROM gains
QUALIFY row_number() OVER (PARTITION BY feature ORDER BY gain DESC, gains.threshold) = 1"""


# --- regression and features -------------------------------------------------------------------

REGRESSION = f"""
rows_used AS (
  SELECT l_orderkey, l_quantity AS y, l_extendedprice AS x FROM lineitem
  WHERE l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL
),
line AS (
  SELECT regr_intercept(y, x) AS intercept, regr_slope(y, x) AS slope
  FROM rows_used WHERE {_is_train('l_orderkey')}
),
scored AS (
  SELECT y AS label, intercept + slope * x AS prediction
  FROM rows_used, line WHERE NOT ({_is_train('l_orderkey')})
)"""

# --- samples that can be told apart without an error -------------------------------------------

_ITEM_KEY = "(l_orderkey * 8 + l_linenumber)"
_SEPARABLE_TEST = f"""
scored AS (
  SELECT CAST(CASE WHEN l_discount >= 0.045 THEN 1 ELSE 0 END AS DOUBLE) AS label,
         label AS prediction
  FROM lineitem WHERE NOT ({_is_train(_ITEM_KEY)})
)"""
_URGENT = "CAST(substr(o_orderpriority, 1, 1) AS INTEGER) <= 2"
# The pipeline's index gives 0 to the more frequent class, here of the train rows.
_URGENT_TEST = f"""
more AS (
  SELECT count(*) FILTER ({_URGENT}) > count(*) / 2 AS urgent
  FROM orders WHERE {_is_train('o_orderkey')}
),
scored AS (
  SELECT CAST(CASE WHEN ({_URGENT}) = urgent THEN 0 ELSE 1 END AS DOUBLE) AS label,
         label AS prediction
  FROM orders, more WHERE NOT ({_is_train('o_orderkey')})
)"""
_POINTS = [f"numTrees={t}, maxDepth={d}" for t in TREES for d in DEPTHS]
_GRID = "points AS (SELECT unnest([" + ", ".join(f"'{p}'" for p in _POINTS) + "]) AS model)"


def _urgent_report(name: str) -> str:
    return f"WITH {_URGENT_TEST}, {_report('scored', model=name)}"


def _separable_report(name: str) -> str:
    return f"WITH {_SEPARABLE_TEST}, {_report('scored', model=name)}"


# All points rank without an error, so the first one is the best.
_SEARCH = f"SELECT model, CAST(1 AS DOUBLE) AS metric, model = '{_POINTS[0]}' AS best FROM points"

_CORRELATED = list(combinations(["label", *TEXT_FEATURES], 2))


ORACLES: dict[str, str] = {
    "threshold_label": f"""
SELECT l_orderkey, l_linenumber, {QUANTITY} AS quality, {_good(QUANTITY)} AS good FROM lineitem""",
    "threshold_label_udf": f"SELECT p_partkey, p_size, {_good('p_size')} AS good FROM part",
    "parse_delimited": f"""
SELECT l_orderkey, l_linenumber, {_good(QUANTITY)} AS label, {', '.join(ITEM_FEATURES)}
FROM lineitem
WHERE l_quantity IS NOT NULL AND {' AND '.join(f'{f} IS NOT NULL' for f in ITEM_FEATURES)}""",
    "parse_any_width": " UNION ALL ".join(
        f"SELECT l_orderkey, l_linenumber, {_good(QUANTITY)} AS label, "
        f"CAST({i} AS INTEGER) AS position, {f} AS value FROM lineitem "
        f"WHERE l_quantity IS NOT NULL AND {' AND '.join(f'{g} IS NOT NULL' for g in ITEM_FEATURES)}"
        for i, f in enumerate(ITEM_FEATURES)
    ),
    "header_removed": """
SELECT concat_ws(';', o_orderkey, o_custkey, o_orderstatus, o_orderpriority) AS line FROM orders""",
    "csv_scan": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders",
    "csv_scan_inferred": f"""
SELECT p_partkey, p_size, p_retailprice, {_good('p_size')} AS good FROM part""",
    "assembled_features": f"WITH {SAMPLES} "
    + " UNION ALL ".join(
        f"SELECT doc_id, CAST({i} AS INTEGER) AS position, {f} AS value FROM samples"
        for i, f in enumerate(TEXT_FEATURES)
    ),
    "label_index": f"""
WITH {ITEMS},
ranks AS (
  SELECT label, CAST(
    row_number() OVER (ORDER BY count(*) DESC, CAST(label AS VARCHAR)) - 1 AS DOUBLE) AS rank
  FROM items GROUP BY label
)
SELECT l_orderkey, l_linenumber, items.label AS good, rank AS label
FROM items JOIN ranks ON items.label = ranks.label""",
    "split_counts": f"""
SELECT CASE WHEN {_is_train('o_orderkey')} THEN 'train' ELSE 'test' END AS split, count(*) AS n
FROM orders GROUP BY 1""",
    "split_rows": f"""
SELECT o_orderkey, CASE WHEN {_is_train('o_orderkey')} THEN 'train' ELSE 'test' END AS split
FROM orders""",
    "random_split_cover": """
SELECT seeded, count(*) AS total, CAST(0 AS BIGINT) AS in_both, CAST(0 AS BIGINT) AS in_neither
FROM orders, (SELECT unnest([true, false]) AS seeded) GROUP BY seeded""",
    "held_rows": f"""
WITH {ITEMS}
SELECT held, count(*) AS n, count(*) FILTER (label = 1) AS n_pos
FROM items, (SELECT unnest([true, false]) AS held) WHERE {_is_train('l_orderkey')} GROUP BY held""",
    "malformed_lines": f"""
SELECT form, l_orderkey % 10 IN (3, 7) OR l_quantity IS NULL
         OR {' OR '.join(f'{f} IS NULL' for f in ITEM_FEATURES)} AS malformed, count(*) AS n
FROM lineitem, (SELECT unnest(['line', 'row']) AS form) GROUP BY 1, 2""",
    "lr_items": _separable_report("logistic_regression"),
    "dt_items": _separable_report("decision_tree"),
    "rf_items": _separable_report("random_forest"),
    "rf_vote_items": _separable_report("random_forest, majority"),
    "svm_items": _separable_report("linear_svm"),
    "gbt_items": _separable_report("boosted_trees"),
    "tree_importance_items": """
SELECT unnest(['f_discount', 'l_tax', 'f_quantity']) AS feature,
       unnest([1, 0, 0])::DOUBLE AS importance""",
    "rf_pipeline_orders": _urgent_report("forest pipeline"),
    "rf_pipeline_override_orders": _urgent_report("forest pipeline"),
    "rf_sweep_orders": f"""
WITH {_GRID},
scored AS (
  SELECT CAST(CASE WHEN {_URGENT} THEN 1 ELSE 0 END AS DOUBLE) AS label, label AS prediction, model
  FROM orders, points WHERE NOT ({_is_train('o_orderkey')})
),
{_report('scored', by='model')}""",
    "rf_cross_validation_orders": f"""
WITH {_GRID}, found AS ({_SEARCH}),
report AS ({_urgent_report(_POINTS[0])})
SELECT found.*, report.* EXCLUDE (model) FROM found LEFT JOIN report USING (model)""",
    "holdout_search_orders": f"WITH {_GRID} {_SEARCH}",
    "gini_split_binned": f"WITH {ITEMS}, {_gini('items', ['l_discount', 'l_tax'], True)}",
    "preview_rows": f"""
SELECT p_partkey, p_size, p_retailprice, {_good('p_size')} AS good
FROM part ORDER BY p_partkey LIMIT 3""",
    "preview_samples": f"""
WITH firsts AS (
  SELECT p_partkey, {_good('p_size')} AS label, CAST(p_size AS DOUBLE) AS v0, p_retailprice AS v1
  FROM part WHERE p_size IS NOT NULL AND p_retailprice IS NOT NULL ORDER BY p_partkey LIMIT 3
)
SELECT p_partkey, label, CAST(0 AS INTEGER) AS position, v0 AS value FROM firsts
UNION ALL
SELECT p_partkey, label, CAST(1 AS INTEGER) AS position, v1 AS value FROM firsts""",
    "fold_counts": f"SELECT {_fold('o_orderkey')} AS fold, count(*) AS n FROM orders GROUP BY 1",
    "param_grid": f"""
WITH train AS (SELECT * FROM labels WHERE quality IS NOT NULL AND {_is_train('doc_id')}),
sizes AS (SELECT {_fold('doc_id')} AS fold, count(*) AS n_valid FROM train GROUP BY 1)
SELECT fold, n_valid, (SELECT count(*) FROM train) - n_valid AS n_train,
       CAST(num_trees AS INTEGER) AS num_trees, CAST(max_depth AS INTEGER) AS max_depth
FROM sizes, unnest({list(TREES)}) t(num_trees), unnest({list(DEPTHS)}) d(max_depth)""",
    "nb_model": f"WITH {NB_MODEL} "
    + " UNION ALL ".join(
        f"SELECT label, '{f}' AS feature, round(log_prior, 6) AS log_prior, "
        f"round({f}, 6) AS log_weight FROM model"
        for f in TEXT_FEATURES
    ),
    "nb_predict": f"""
WITH {NB_SCORED} SELECT doc_id, label, prediction, round(margin, 6) AS margin FROM scored""",
    "nb_cross_validation": NB_SEARCH,
    "gini_split": f"WITH {SAMPLES}, {_gini('samples', TEXT_FEATURES, False)}",
    "gini_split_items": f"WITH {ITEMS}, {_gini('items', ITEM_FEATURES, True)}",
    "mispredictions": f"""
WITH {NB_SCORED} SELECT doc_id, prediction, label FROM scored WHERE prediction <> label""",
    "error_rate": f"""
WITH {NB_SCORED}
SELECT count(*) AS n, count(*) FILTER (prediction <> label) AS n_errors,
       round(avg(CASE WHEN prediction <> label THEN 1.0 ELSE 0.0 END), 6) AS test_error
FROM scored""",
    "hard_roc_pr": f"WITH {NB_SCORED}, {_report('scored', model='naive_bayes')}",
    "hard_roc_pr_items": f"""
WITH {ITEMS},
scored AS (SELECT l_returnflag, label, {_good('l_extendedprice', 50000)} AS prediction FROM items),
{_report('scored', by='l_returnflag')}""",
    "ranked_roc": f"""
WITH {SAMPLES},
scores AS (SELECT label, f_punct / nullif(f_chars, 0) AS score FROM samples),
{_rank_sum('scores')}""",
    "ranked_roc_items": f"""
WITH {ITEMS},
scores AS (SELECT l_returnflag, label, l_extendedprice AS score FROM items),
{_rank_sum('scores', by='l_returnflag')}""",
    "confusion_matrix": f"""
WITH {NB_SCORED} SELECT label, prediction, count(*) AS n FROM scored GROUP BY 1, 2""",
    "nb_holdout": f"WITH {NB_SCORED}, {_report('scored', model='naive_bayes')}",
    "feature_selection": f"WITH {SAMPLES}, long AS ("
    + " UNION ALL ".join(
        f"SELECT '{f}' AS feature, {f} AS value, label FROM samples" for f in TEXT_FEATURES
    )
    + """),
classes AS (
  SELECT feature, label, count(value) AS n, avg(value) AS mean, var_pop(value) AS var
  FROM long GROUP BY feature, label
),
overall AS (
  SELECT *, sum(n * mean) OVER w / sum(n) OVER w AS all_mean
  FROM classes WINDOW w AS (PARTITION BY feature)
),
f AS (
  SELECT feature, sum(n * power(mean - all_mean, 2)) / (count(*) - 1)
                  / (sum(n * var) / (sum(n) - count(*))) AS f_value
  FROM overall GROUP BY feature
)
SELECT feature, round(f_value, 6) AS f_value,
       row_number() OVER (ORDER BY f_value DESC, feature) <= 3 AS selected
FROM f""",
    "feature_correlation": f"WITH {SAMPLES} "
    + " UNION ALL ".join(
        f"SELECT '{a}' AS \"left\", '{b}' AS \"right\", round(corr({a}, {b}), 6) AS corr FROM samples"
        for a, b in _CORRELATED
    ),
    "outlier_rows": f"WITH {SAMPLES}, z AS ("
    + " UNION ALL ".join(
        f"SELECT doc_id, '{f}' AS feature, {f} AS value, "
        f"({f} - avg({f}) OVER ()) / nullif(stddev_samp({f}) OVER (), 0) AS z FROM samples"
        for f in TEXT_FEATURES
    )
    + ") SELECT doc_id, feature, value, round(z, 6) AS z FROM z WHERE abs(z) > 3",
    "group_mean": """
SELECT l_returnflag, l_linestatus, count(l_quantity) AS n, round(avg(l_quantity), 6) AS mean
FROM lineitem GROUP BY 1, 2""",
    "quality_regression": f"""
WITH {REGRESSION}
SELECT round(max(intercept), 6) AS intercept, round(max(slope), 9) AS slope,
       (SELECT count(*) FROM scored) AS n,
       (SELECT round(avg(abs(prediction - label)), 6) FROM scored) AS mad
FROM line""",
    "mad": f"""
WITH {REGRESSION} SELECT count(*) AS n, round(avg(abs(prediction - label)), 6) AS mad FROM scored""",
    "confusion_tolerance": f"""
WITH {REGRESSION}
SELECT label, count(*) AS n, count(*) FILTER (abs(prediction - label) <= 5) AS n_within,
       round(avg(abs(prediction - label)), 6) AS mad
FROM scored GROUP BY label""",
}
