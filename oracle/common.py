"""Shared SQL for the checks: the log, its clean form and the customer tables as CTEs."""

from __future__ import annotations

CUTOFF = "TIMESTAMP '2001-05-04 00:00:00'"
END = "TIMESTAMP '2001-08-02 00:00:00'"
OBSERVATION_DAYS = 2315
MIN_COUNTRY_CUSTOMERS = 66
CODES = "('POST', 'gift_0001_10')"
VOCAB = ["NATION_0", "NATION_10", "NATION_11", "NATION_13", "NATION_19", "NATION_2",
         "NATION_3", "NATION_7", "Other"]
VOCAB_SQL = "(" + ", ".join(f"'{v}'" for v in VOCAB) + ")"

#: The columns of the customer table and their order.
NUMERIC = [
    "recency_days", "frequency", "monetary_total", "monetary_avg_per_order",
    "tenure_days", "avg_days_between_orders", "recency_over_avg_gap",
    "is_single_order_customer",
    "total_quantity", "distinct_products", "avg_items_per_order", "avg_unit_price",
    "avg_distinct_products_per_order", "distinct_active_months",
    "cancel_order_count", "cancel_order_rate", "return_value_ratio",
    "orders_last_30d", "orders_last_90d", "orders_last_180d",
    "spend_last_90d", "spend_last_365d", "spend_momentum",
]
DOUBLES = {
    "monetary_total", "monetary_avg_per_order", "avg_days_between_orders",
    "recency_over_avg_gap", "avg_items_per_order", "avg_unit_price",
    "avg_distinct_products_per_order", "cancel_order_rate", "return_value_ratio",
    "spend_last_90d", "spend_last_365d", "spend_momentum",
}
COUNTRY_COLUMNS = [f"country_{v}" for v in VOCAB]
CONTINUOUS = [c for c in NUMERIC if c != "is_single_order_customer"]


def r(expression: str, name: str) -> str:
    """A double at six digits, without negative zero."""
    return f"(round(CAST({expression} AS DOUBLE), 6) + 0.0) AS {name}"


def day_gap(start: str, end: str) -> str:
    """Whole elapsed days."""
    return f"date_sub('day', {start}, {end})"


_CANCELLED = "((o_orderkey % 7 = 0 OR o_custkey % 89 = 0) AND o_orderkey % 997 <> 0)"
SOURCE = f"""
source AS (
  SELECT CASE WHEN o_orderkey % 997 = 0 THEN 'A' WHEN {_CANCELLED} THEN 'C' ELSE '' END
           || CAST(o_orderkey AS VARCHAR) AS invoice,
         CASE WHEN l_partkey % 101 = 0 THEN 'POST'
              WHEN l_partkey % 103 = 0 THEN 'gift_0001_10'
              WHEN l_partkey % 107 = 0 THEN 'DCGS0001'
              ELSE repeat('0', greatest(0, 5 - length(CAST(l_partkey AS VARCHAR))))
                   || CAST(l_partkey AS VARCHAR)
                   || CASE WHEN l_partkey % 67 = 0 AND o_orderkey % 2 = 0 THEN ' ' ELSE '' END
              END AS stock_code,
         CASE WHEN l_partkey % 97 = 0 THEN NULL WHEN l_partkey % 89 = 0 THEN '?'
              WHEN l_partkey % 79 = 0 THEN '   '
              WHEN l_partkey % 83 = 0 THEN '  ' || p_name ELSE p_name END AS description,
         CASE WHEN CASE WHEN {_CANCELLED} THEN l_partkey % 101 <> 0
                        ELSE l_partkey % 106 = 0 OR l_partkey % 109 = 0 END
              THEN -CAST(l_quantity AS BIGINT) ELSE CAST(l_quantity AS BIGINT) END AS quantity,
         CASE WHEN o_custkey % 97 = 0 THEN TIMESTAMP '1997-03-03 00:00:00'
              WHEN o_custkey % 2 = 1 AND o_orderdate >= TIMESTAMP '1999-12-21 00:00:00'
              THEN o_orderdate - to_days(900)
              WHEN o_custkey % 2 = 0 AND o_orderkey % 2 = 0
               AND o_orderdate >= TIMESTAMP '1996-01-01 00:00:00' AND o_orderdate < {CUTOFF}
              THEN {CUTOFF} + to_days(CAST(o_orderkey % 80 AS INTEGER))
              WHEN o_custkey % 2 = 0 AND o_orderkey % 4 = 1
               AND o_orderdate >= TIMESTAMP '1996-01-01 00:00:00' AND o_orderdate < {CUTOFF}
              THEN {CUTOFF} - to_days(CAST(o_orderkey % 89 AS INTEGER) + 1)
              ELSE o_orderdate END + to_hours(o_orderkey % 24) AS invoice_date,
         CASE WHEN (l_partkey % 53 = 0 OR o_custkey % 61 = 0) AND NOT {_CANCELLED}
              THEN CAST(0 AS DOUBLE)
              WHEN l_partkey % 59 = 0 AND o_orderkey % 3 = 0 AND NOT {_CANCELLED}
              THEN CAST(-1.25 AS DOUBLE)
              ELSE floor(l_extendedprice / l_quantity)
                   + CAST(l_partkey % 4 AS DOUBLE) / CAST(4 AS DOUBLE) END AS price,
         CASE WHEN o_orderkey % 5 <> 0 AND NOT (o_orderkey % 41 = 0 AND l_partkey % 2 = 0)
              THEN o_custkey END AS customer_id,
         CASE WHEN o_orderkey % 11 = 0 THEN 'NATION_0'
              WHEN o_orderkey % 13 = 0 THEN n_name || ' ' ELSE n_name END AS country,
         l_partkey
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN part ON l_partkey = p_partkey
),
raw AS (
  SELECT * EXCLUDE (l_partkey),
         CASE WHEN year(invoice_date) < 1998 THEN 'Year 1995-1997' ELSE 'Year 1998-2001' END
           AS source_sheet
  FROM (SELECT * FROM source UNION ALL SELECT * FROM source WHERE l_partkey % 211 = 0)
)"""

TRIMMED = r"""
trimmed AS (
  SELECT regexp_replace(invoice, '^\s+|\s+$', '', 'g') AS invoice,
         regexp_replace(stock_code, '^\s+|\s+$', '', 'g') AS stock_code,
         regexp_replace(description, '^\s+|\s+$', '', 'g') AS description,
         quantity, invoice_date, price, customer_id,
         regexp_replace(country, '^\s+|\s+$', '', 'g') AS country, source_sheet,
         starts_with(regexp_replace(invoice, '^\s+|\s+$', '', 'g'), 'C') AS is_cancellation
  FROM raw
)"""

CLEAN = f"""
clean AS (
  SELECT invoice, stock_code, quantity, invoice_date, price, customer_id, country,
         is_cancellation, quantity * price AS line_revenue
  FROM trimmed
  WHERE NOT starts_with(invoice, 'A') AND stock_code NOT IN {CODES}
    AND price > 0 AND (quantity > 0 OR is_cancellation)
)"""

BOUGHT = f"""
bought AS (
  SELECT * FROM clean
  WHERE NOT is_cancellation AND customer_id IS NOT NULL AND invoice_date < {CUTOFF}
)"""

LABELS = f"""
labels_y AS (
  SELECT p.customer_id, CAST(CASE WHEN s.customer_id IS NULL THEN 0 ELSE 1 END AS TINYINT) AS y
  FROM (SELECT DISTINCT customer_id FROM bought) p
  LEFT JOIN (SELECT DISTINCT customer_id FROM clean
             WHERE NOT is_cancellation AND customer_id IS NOT NULL
               AND invoice_date >= {CUTOFF} AND invoice_date < {END}) s
    ON p.customer_id = s.customer_id
)"""

_MAPPED = f"CASE WHEN country IN {VOCAB_SQL} THEN country ELSE 'Other' END"

# One block per feature group, joined on the customer: another route than the Spark plan's.
FEATURES = f"""
f_rfm AS (
  SELECT customer_id,
         {day_gap('max(invoice_date)', CUTOFF)} AS recency_days,
         {day_gap('min(invoice_date)', CUTOFF)} AS tenure_days,
         {day_gap('min(invoice_date)', 'max(invoice_date)')} AS span_days,
         count(DISTINCT invoice) AS frequency,
         sum(line_revenue) AS monetary_total,
         CAST(sum(quantity) AS BIGINT) AS total_quantity,
         count(DISTINCT stock_code) AS distinct_products,
         avg(price) AS avg_unit_price,
         count(DISTINCT strftime(invoice_date, '%Y-%m')) AS distinct_active_months
  FROM bought GROUP BY customer_id
),
f_products AS (
  SELECT customer_id, avg(n) AS avg_distinct_products_per_order
  FROM (SELECT customer_id, invoice, count(DISTINCT stock_code) AS n
        FROM bought GROUP BY customer_id, invoice)
  GROUP BY customer_id
),
f_returns AS (
  SELECT customer_id, count(DISTINCT invoice) AS cancel_order_count,
         abs(sum(line_revenue)) AS cancel_value
  FROM clean
  WHERE is_cancellation AND customer_id IS NOT NULL AND invoice_date < {CUTOFF}
  GROUP BY customer_id
),
f_momentum AS (
  SELECT customer_id,
    count(DISTINCT CASE WHEN invoice_date >= {CUTOFF} - INTERVAL 30 DAY THEN invoice END) AS orders_last_30d,
    count(DISTINCT CASE WHEN invoice_date >= {CUTOFF} - INTERVAL 90 DAY THEN invoice END) AS orders_last_90d,
    count(DISTINCT CASE WHEN invoice_date >= {CUTOFF} - INTERVAL 180 DAY THEN invoice END) AS orders_last_180d,
    coalesce(sum(CASE WHEN invoice_date >= {CUTOFF} - INTERVAL 90 DAY THEN line_revenue END), 0) AS spend_last_90d,
    coalesce(sum(CASE WHEN invoice_date >= {CUTOFF} - INTERVAL 365 DAY THEN line_revenue END), 0) AS spend_last_365d
  FROM bought GROUP BY customer_id
),
f_country AS (
  SELECT customer_id, country FROM (
    SELECT customer_id, {_MAPPED} AS country,
           row_number() OVER (PARTITION BY customer_id
                              ORDER BY invoice_date DESC, {_MAPPED} DESC) AS place
    FROM bought)
  WHERE place = 1
),
feats AS (
  SELECT f_rfm.*, avg_distinct_products_per_order,
         monetary_total / frequency AS monetary_avg_per_order,
         frequency = 1 AS is_single_order_customer,
         CASE WHEN frequency > 1
              THEN greatest(CAST(span_days AS DOUBLE) / (frequency - 1), CAST(1 AS DOUBLE))
              ELSE CAST({OBSERVATION_DAYS} AS DOUBLE) END AS avg_days_between_orders,
         CAST(recency_days AS DOUBLE) /
           CASE WHEN frequency > 1
                THEN greatest(CAST(span_days AS DOUBLE) / (frequency - 1), CAST(1 AS DOUBLE))
                ELSE CAST({OBSERVATION_DAYS} AS DOUBLE) END AS recency_over_avg_gap,
         CAST(total_quantity AS DOUBLE) / frequency AS avg_items_per_order,
         coalesce(cancel_order_count, 0) AS cancel_order_count,
         CAST(coalesce(cancel_order_count, 0) AS DOUBLE) / frequency AS cancel_order_rate,
         coalesce(cancel_value, 0) / monetary_total AS return_value_ratio,
         orders_last_30d, orders_last_90d, orders_last_180d, spend_last_90d, spend_last_365d,
         spend_last_90d / (spend_last_365d / 4 + CAST(0.000001 AS DOUBLE)) AS spend_momentum,
         country
  FROM f_rfm
  LEFT JOIN f_products USING (customer_id)
  LEFT JOIN f_returns USING (customer_id)
  LEFT JOIN f_momentum USING (customer_id)
  LEFT JOIN f_country USING (customer_id)
)"""

MATRIX = """
matrix AS (
  SELECT customer_id, y, {numeric}, {countries}
  FROM labels_y JOIN feats USING (customer_id)
)""".format(
    numeric=", ".join(
        f"CAST({c} AS TINYINT) AS {c}" if c == "is_single_order_customer" else c for c in NUMERIC),
    countries=", ".join(
        f"CAST(country = '{v}' AS TINYINT) AS country_{v}" for v in VOCAB))

# Ranks of the seeded hash inside a class, then exact quotas by largest remainder.
SPLIT = """
ranked AS (
  SELECT customer_id, y,
         row_number() OVER (PARTITION BY y
           ORDER BY md5('42:' || CAST(customer_id AS VARCHAR)), customer_id) AS place
  FROM labels_y
),
quotas AS (
  SELECT y, base + CASE WHEN row_number() OVER (ORDER BY remainder DESC, y)
                             <= n_test - sum(base) OVER () THEN 1 ELSE 0 END AS quota
  FROM (SELECT y, n_test, (n_test * n_class) // n AS base, (n_test * n_class) % n AS remainder
        FROM (SELECT y, count(*) AS n_class,
                     CAST(sum(count(*)) OVER () AS BIGINT) AS n,
                     CAST(ceil(CAST(0.2 AS DOUBLE) * sum(count(*)) OVER ()) AS BIGINT) AS n_test
              FROM labels_y GROUP BY y))
),
split AS (
  SELECT customer_id, ranked.y, CASE WHEN place <= quota THEN 'test' ELSE 'train' END AS split
  FROM ranked JOIN quotas USING (y)
),
folds AS (
  SELECT customer_id, y,
         CAST((row_number() OVER (PARTITION BY y
           ORDER BY md5('42:' || CAST(customer_id AS VARCHAR)), customer_id) - 1) % 5 AS INTEGER)
           AS fold
  FROM split WHERE split = 'train'
),
train AS (SELECT m.*, fold FROM matrix m JOIN folds USING (customer_id)),
test AS (SELECT m.* FROM matrix m JOIN split s USING (customer_id) WHERE s.split = 'test')"""

_PROBS = "[0.0, 0.2, 0.4, 0.6, 0.8, 1.0]"


def _edge_row(column: str, fold: str, where: str) -> str:
    return (f"SELECT '{column}' AS col, {fold} AS fold, list_sort(list_distinct("
            f"quantile_cont(CAST({column} AS DOUBLE), {_PROBS}))) AS edges FROM train {where}")


_RULE = ["recency_days", "frequency", "monetary_total"]
EDGES = "edges AS (\n  " + "\n  UNION ALL ".join(
    [_edge_row(c, "-1", "") for c in _RULE]
    + [_edge_row(c, str(k), f"WHERE fold <> {k}") for c in _RULE for k in range(5)]) + "\n)"


def _score(column: str, inner: str, reverse: bool) -> str:
    above = f"len(list_filter({inner}, lambda e: CAST(t.{column} AS DOUBLE) > e))"
    return (f"len({inner}) + 1 - {above}" if reverse else f"1 + {above}")


def _scored(name: str, source: str, fold: str) -> str:
    picks = ", ".join(
        f"max(CASE WHEN col = '{c}' THEN edges[2:len(edges) - 1] END) AS b{i}"
        for i, c in enumerate(_RULE))
    scores = ", ".join(
        f"CAST({_score(c, f'b{i}', c == 'recency_days')} AS INTEGER) AS {c}_score"
        for i, c in enumerate(_RULE))
    return f"""
{name} AS (
  SELECT *, recency_days_score + frequency_score + monetary_total_score AS rfm_total
  FROM (SELECT t.*, {scores}
        FROM {source} t JOIN (SELECT fold AS fit, {picks} FROM edges GROUP BY fold) e
          ON e.fit = {fold}))"""


RULE_SCORES = ",".join([
    _scored("rule_train", "train", "-1"), _scored("rule_test", "test", "-1"),
    _scored("rule_oof", "train", "t.fold")])

RAW_RFM = f"""
raw_rfm AS (
  SELECT o.customer_id, recency_days, frequency, monetary, tenure_days,
         CASE WHEN s.customer_id IS NULL THEN 0 ELSE 1 END AS y
  FROM (SELECT customer_id,
               {day_gap('max(invoice_date)', CUTOFF)} AS recency_days,
               count(DISTINCT invoice) AS frequency,
               sum(quantity * price) AS monetary,
               {day_gap('min(invoice_date)', CUTOFF)} AS tenure_days
        FROM raw WHERE customer_id IS NOT NULL AND NOT starts_with(invoice, 'C')
          AND invoice_date < {CUTOFF} GROUP BY customer_id) o
  LEFT JOIN (SELECT DISTINCT customer_id FROM raw
             WHERE customer_id IS NOT NULL AND NOT starts_with(invoice, 'C')
               AND invoice_date >= {CUTOFF} AND invoice_date < {END}) s
    ON o.customer_id = s.customer_id
)"""

PLAIN_SCORES = """
train_scores AS (
  SELECT 'RFM heuristic' AS candidate, customer_id, fold, y, CAST(rfm_total AS DOUBLE) AS score FROM rule_oof
  UNION ALL SELECT 'Frequency', customer_id, fold, y, CAST(frequency AS DOUBLE) FROM train
  UNION ALL SELECT 'Monetary', customer_id, fold, y, monetary_total FROM train
  UNION ALL SELECT 'Recency', customer_id, fold, y, -CAST(recency_days AS DOUBLE) FROM train
),
test_scores AS (
  SELECT 'RFM heuristic' AS candidate, customer_id, y, CAST(rfm_total AS DOUBLE) AS score FROM rule_test
  UNION ALL SELECT 'Frequency', customer_id, y, CAST(frequency AS DOUBLE) FROM test
  UNION ALL SELECT 'Monetary', customer_id, y, monetary_total FROM test
  UNION ALL SELECT 'Recency', customer_id, y, -CAST(recency_days AS DOUBLE) FROM test
)"""

RAW = "WITH" + SOURCE
TRIM = ",".join([RAW, TRIMMED])
TX = ",".join([TRIM, CLEAN])
OBS = ",".join([TX, BOUGHT])
LAB = ",".join([OBS, LABELS])
FEAT = ",".join([OBS, FEATURES])
MAT = ",".join([LAB, FEATURES, MATRIX])
SPL = ",".join([MAT, SPLIT])
RUL = ",".join([SPL, EDGES, RULE_SCORES])
SCO = ",".join([RUL, PLAIN_SCORES])
RRF = ",".join([RAW, RAW_RFM])


def auc(source: str, keys: str) -> str:
    """ROC-AUC by comparing ranks: average rank over ties, Mann-Whitney form."""
    return f"""
  SELECT {keys}, n_rows, n_pos,
         (rank_sum - n_pos * (n_pos + 1) / CAST(2 AS DOUBLE)) / (n_pos * (n_rows - n_pos)) AS roc_auc
  FROM (SELECT {keys}, count(*) AS n_rows, CAST(sum(y) AS DOUBLE) AS n_pos,
               sum(CASE WHEN y = 1 THEN low + (ties - 1) / CAST(2 AS DOUBLE) END) AS rank_sum
        FROM (SELECT {keys}, y, rank() OVER (PARTITION BY {keys} ORDER BY score) AS low,
                     count(*) OVER (PARTITION BY {keys}, score) AS ties
              FROM {source})
        GROUP BY {keys})"""


COST = "CAST(1.0 AS DOUBLE) * {missed} + CAST({wasted_cost} AS DOUBLE) * {wasted}"


def curve(source: str, wasted_cost: str = "0.15") -> str:
    """Cost at every observed score by comparing it with every row."""
    missed = "count(*) FILTER (WHERE s.score >= t.threshold AND s.y = 0)"
    wasted = "count(*) FILTER (WHERE s.score < t.threshold AND s.y = 1)"
    cost = COST.format(missed=missed, wasted=wasted, wasted_cost=wasted_cost)
    return f"""
  SELECT t.candidate, t.threshold, {cost} AS cost, count(*) AS n_rows
  FROM (SELECT DISTINCT candidate, score AS threshold FROM {source}) t
  JOIN {source} s ON s.candidate = t.candidate
  GROUP BY t.candidate, t.threshold"""


def best(curve_name: str, keys: str = "candidate") -> str:
    return f"""
  SELECT {keys}, threshold, cost, cost / n_rows AS cost_per_customer
  FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY cost, threshold) AS place
        FROM {curve_name})
  WHERE place = 1"""


THR = SCO + ",\ncurve AS (" + curve("train_scores") + "),\nbest AS (" + best("curve") + ")"

ON_TEST = """
test_costs AS (
  SELECT s.candidate, count(*) AS n_rows,
         count(*) FILTER (WHERE s.y = 0) AS churners,
         count(*) FILTER (WHERE s.y = 1) AS repeaters,
         count(*) FILTER (WHERE s.score >= b.threshold AND s.y = 0) AS missed,
         count(*) FILTER (WHERE s.score < b.threshold AND s.y = 1) AS wasted,
         count(*) FILTER (WHERE s.score < b.threshold) AS offers,
         count(*) FILTER (WHERE s.score < b.threshold AND s.y = 0) AS caught,
         any_value(b.threshold) AS threshold
  FROM test_scores s JOIN best b ON s.candidate = b.candidate GROUP BY s.candidate
),
policies AS (
  SELECT policy, cost, cost / n_rows AS cost_per_customer,
         row_number() OVER (ORDER BY cost, place) = 1 AS is_best
  FROM (
    SELECT 1 AS place, 'Contact nobody' AS policy, CAST(1.0 AS DOUBLE) * churners AS cost, n_rows
    FROM test_costs WHERE candidate = 'RFM heuristic'
    UNION ALL SELECT 2, 'Contact everybody', CAST(0.15 AS DOUBLE) * repeaters, n_rows
    FROM test_costs WHERE candidate = 'RFM heuristic'
    UNION ALL SELECT 3, candidate,
      CAST(1.0 AS DOUBLE) * missed + CAST(0.15 AS DOUBLE) * wasted, n_rows
    FROM test_costs WHERE candidate = 'RFM heuristic')
),
reduction AS (
  SELECT c.candidate, CAST(1.0 AS DOUBLE) * missed + CAST(0.15 AS DOUBLE) * wasted AS cost,
         p.policy AS best_trivial_policy, p.cost AS best_trivial_cost,
         1 - (CAST(1.0 AS DOUBLE) * missed + CAST(0.15 AS DOUBLE) * wasted) / p.cost
           AS cost_reduction
  FROM test_costs c JOIN policies p ON p.is_best WHERE c.candidate = 'Recency'
)"""
TST = THR + "," + ON_TEST
