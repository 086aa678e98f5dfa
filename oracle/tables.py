"""Checks of sources, contracts, cleaning, audit, features, encoding and splits."""

from __future__ import annotations

from oracle.common import (
    CODES, CONTINUOUS, COUNTRY_COLUMNS, CUTOFF, DOUBLES, END, FEAT, LAB, MAT,
    MIN_COUNTRY_CUSTOMERS, NUMERIC, OBS, RAW, RRF, RUL, SPL, TRIM, TX, VOCAB, r,
)

SQL: dict[str, str] = {}

RAW_COLUMNS = "invoice, stock_code, description, quantity, invoice_date, price, customer_id, country"
TICKET = "invoice, stock_code, quantity, price"


def numeric(prefix: str = "") -> str:
    return ", ".join(r(c, c) if c in DOUBLES else c for c in NUMERIC)


# Sources
SQL["s3_rename_columns"] = f"{RAW} SELECT {RAW_COLUMNS} FROM raw"
SQL["s4_tag_part"] = f"{RAW} SELECT * FROM raw"
SQL["s5_concat_parts"] = f"{RAW} SELECT * FROM raw"
SQL["s7_parquet_scan"] = "SELECT * REPLACE ({}) FROM lineitem".format(
    ", ".join(r(c, c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")))

# Contracts
SQL["v1_raw_contract"] = f"""{RAW}
SELECT count(*) AS n_rows, count(*) - count(invoice) AS null_invoices,
       count(*) FILTER (WHERE invoice LIKE 'C%') AS cancellation_rows FROM raw"""
SQL["v2_clean_contract"] = f"""{TX}
SELECT count(*) FILTER (WHERE invoice LIKE 'A%') AS adjustment_rows,
       count(*) FILTER (WHERE price <= 0) AS unpriced_rows,
       count(*) FILTER (WHERE (quantity < 0) <> is_cancellation) AS sign_disagreements,
       count(*) - count(invoice) AS null_invoice, count(*) - count(stock_code) AS null_stock_code,
       count(*) - count(quantity) AS null_quantity, count(*) - count(price) AS null_price,
       count(*) - count(line_revenue) AS null_line_revenue FROM clean"""
SQL["v3_feature_nulls"] = FEAT + "\n" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS n_null FROM feats"
    for c in ["customer_id", *NUMERIC, "country"])
SQL["v4_feature_infinities"] = FEAT + "\n" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE isinf(CAST({c} AS DOUBLE))) AS n_infinite FROM feats"
    for c in ["customer_id", *[n for n in NUMERIC if n != "is_single_order_customer"]])
SQL["v5_temporal_guard"] = f"""{TX}
SELECT *, last_observation < {CUTOFF} AND first_prediction >= {CUTOFF}
          AND rows_beyond_horizon = 0 AS holds
FROM (SELECT max(invoice_date) FILTER (WHERE invoice_date < {CUTOFF}) AS last_observation,
             min(invoice_date) FILTER (WHERE invoice_date >= {CUTOFF}) AS first_prediction,
             count(*) FILTER (WHERE invoice_date >= {END}) AS rows_beyond_horizon
      FROM clean WHERE NOT is_cancellation AND customer_id IS NOT NULL AND invoice_date < {END})"""
SQL["v8_key_overlap"] = f"""{SPL}
SELECT (SELECT count(DISTINCT customer_id) FROM train) AS train_keys,
       (SELECT count(DISTINCT customer_id) FROM test) AS test_keys,
       (SELECT count(*) FROM (SELECT customer_id FROM train INTERSECT SELECT customer_id FROM test))
         AS shared_keys"""
SQL["v9_join_row_counts"] = f"""{MAT}
SELECT (SELECT count(*) FROM labels_y) AS left_rows, (SELECT count(*) FROM feats) AS right_rows,
       (SELECT count(*) FROM labels_y JOIN feats USING (customer_id)) AS joined_rows"""
SQL["v10_price_filter_losses"] = f"""{TRIM}
SELECT count(*) AS rows_removed,
       count(*) FILTER (WHERE is_cancellation) AS cancellations_removed,
       count(*) FILTER (WHERE customer_id IS NULL) AS unattributed_removed
FROM trimmed WHERE invoice NOT LIKE 'A%' AND stock_code NOT IN {CODES} AND price <= 0"""
SQL["v11_prediction_alignment"] = f"""{RUL}
SELECT count(s.customer_id) AS scored_rows, count(t.customer_id) AS expected_rows,
       count(*) FILTER (WHERE s.customer_id IS NULL OR t.customer_id IS NULL) AS unmatched_rows
FROM rule_oof s FULL OUTER JOIN train t ON s.customer_id = t.customer_id"""
KIND = r"""CASE WHEN regexp_matches(invoice, '^\d+$') THEN 'numeric'
            WHEN invoice LIKE 'C%' THEN 'C prefix' ELSE 'UNCLASSIFIED' END"""
SQL["v12_invoice_kinds_left"] = f"""{TRIM}
SELECT {KIND} AS kind, count(*) AS n_rows FROM trimmed WHERE invoice NOT LIKE 'A%' GROUP BY 1"""

# Cleaning
SQL["c0_clean_transactions"] = f"{TX} SELECT * FROM clean"
SQL["c1_trim_text"] = f"{TRIM} SELECT {TICKET}, description, country FROM trimmed"
SQL["c2_cancellation_flag"] = (
    f"{RAW} SELECT {TICKET}, substr(invoice, 1, 1) = 'C' AS is_cancellation FROM raw")
SQL["c3_drop_adjustments"] = f"{RAW} SELECT {TICKET} FROM raw WHERE invoice NOT LIKE 'A%'"
SQL["c4_drop_non_products"] = f"{TRIM} SELECT {TICKET} FROM trimmed WHERE stock_code NOT IN {CODES}"
SQL["c5_keep_priced"] = f"{RAW} SELECT {TICKET} FROM raw WHERE price > 0"
SQL["c6_sign_backstop"] = (
    f"{TRIM} SELECT {TICKET}, is_cancellation FROM trimmed WHERE quantity > 0 OR is_cancellation")
SQL["c7_cast_customer"] = f"{RAW} SELECT {TICKET}, CAST(customer_id AS BIGINT) AS customer_id FROM raw"
SQL["c8_line_revenue"] = f"{TRIM} SELECT {TICKET}, {r('quantity * price', 'line_revenue')} FROM trimmed"
SQL["c9_tolerant_drop"] = f"{RAW} SELECT * EXCLUDE (description, source_sheet) FROM raw"
SQL["c10_cleaning_summary"] = f"""{TX}
SELECT rows_in, rows_out, {r('CAST(100 * (rows_in - rows_out) AS DOUBLE) / rows_in', 'pct_removed')}
FROM (SELECT (SELECT count(*) FROM raw) AS rows_in, (SELECT count(*) FROM clean) AS rows_out)"""

# Audit: every step as its own filtered table
_STEPS = f""",
s0 AS (SELECT * FROM trimmed),
s1 AS (SELECT * FROM s0 WHERE invoice NOT LIKE 'A%'),
s2 AS (SELECT * FROM s1 WHERE stock_code NOT IN {CODES}),
s3 AS (SELECT * FROM s2 WHERE price > 0),
s4 AS (SELECT * FROM s3 WHERE quantity > 0 OR is_cancellation),
sizes AS (
  {' UNION ALL '.join(f'SELECT {i} AS i, count(*) AS n, sum(abs(quantity * price)) AS g FROM s{i}' for i in range(5))}
)"""
_STEP_NAMES = ("CASE a.i WHEN 1 THEN 'drop A-prefix invoices' WHEN 2 THEN 'drop non-product codes' "
               "WHEN 3 THEN 'drop price <= 0' ELSE 'drop non-cancellation negatives' END")
SQL["a1_filter_audit"] = f"""{TRIM}{_STEPS}
SELECT a.i AS step_no, {_STEP_NAMES} AS step, b.n AS rows_before, b.n - a.n AS rows_removed,
       {r('CAST(100 * (b.n - a.n) AS DOUBLE) / z.n', 'pct_rows')},
       {r('100 * (b.g - a.g) / z.g', 'pct_gross_revenue')}
FROM sizes a JOIN sizes b ON b.i = a.i - 1 JOIN sizes z ON z.i = 0"""
SQL["a2_audit_totals"] = f"""{TRIM}{_STEPS}
SELECT z.n AS rows_before, a.n AS rows_after, z.n - a.n AS rows_removed,
       {r('CAST(100 * (z.n - a.n) AS DOUBLE) / z.n', 'pct_rows')},
       {r('100 * (z.g - a.g) / z.g', 'pct_gross_revenue')}
FROM sizes z JOIN sizes a ON z.i = 0 AND a.i = 4"""
_TRIM = r"regexp_replace({c}, '^\s+|\s+$', '', 'g')"
_TEXT = ("invoice", "stock_code", "description", "country")
SQL["a3_trim_changes"] = RAW + "\n" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} <> {_TRIM.format(c=c)}) AS rows_changed FROM raw"
    for c in _TEXT)
_PAIRS = " UNION ".join(
    f"SELECT '{c}' AS \"column\", {c} AS before, {_TRIM.format(c=c)} AS after FROM raw "
    f"WHERE {c} <> {_TRIM.format(c=c)}" for c in _TEXT)
SQL["a3_trim_samples"] = f"""{RAW}
SELECT * FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY "column" ORDER BY before) AS INTEGER) AS position
  FROM ({_PAIRS})) WHERE position <= 5"""
SQL["a4_code_identity"] = f"""{RAW},
codes AS (SELECT DISTINCT stock_code AS code, {_TRIM.format(c='stock_code')} AS trimmed FROM raw)
SELECT count(*) AS codes_before, count(DISTINCT trimmed) AS codes_after,
       count(*) FILTER (WHERE code <> trimmed) AS codes_trimmed,
       count(*) FILTER (WHERE code <> trimmed AND trimmed IN (SELECT code FROM codes))
         AS trimmed_already_present
FROM codes"""
SQL["a5_drop_list_coverage"] = f"""{TRIM}
SELECT count(DISTINCT stock_code) AS codes_present, CAST(2 AS INTEGER) AS codes_listed
FROM trimmed WHERE stock_code IN {CODES}"""
SQL["a6_odd_survivors"] = rf"""{TRIM}
SELECT stock_code, count(*) AS n_rows, min(description) AS example_description FROM trimmed
WHERE invoice NOT LIKE 'A%' AND stock_code NOT IN {CODES}
  AND NOT regexp_matches(stock_code, '^\d{{5}}\w*$') GROUP BY stock_code"""
SQL["a7_clean_profile"] = f"""{TX}
SELECT count(*) AS n_rows, count(*) - count(customer_id) AS null_customer_rows,
       count(DISTINCT customer_id) AS distinct_customers,
       count(DISTINCT invoice) AS distinct_invoices,
       {r('min(line_revenue)', 'min_revenue')}, {r('max(line_revenue)', 'max_revenue')},
       {r('sum(line_revenue)', 'sum_revenue')},
       count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM clean)) AS duplicate_rows
FROM clean"""

# Population and label
SQL["l1_real_purchases"] = f"""{TX}
SELECT * FROM clean WHERE NOT is_cancellation AND customer_id IS NOT NULL
  AND invoice_date >= {CUTOFF} AND invoice_date < {END}"""
SQL["l2_population"] = f"{OBS} SELECT DISTINCT customer_id FROM bought"
SQL["l3_labels"] = f"{LAB} SELECT * FROM labels_y"

# Features
_GROUPS = {
    "f1_recency_days": ["recency_days"], "f2_tenure_days": ["tenure_days"],
    "f3_frequency": ["frequency"], "f4_monetary_total": ["monetary_total"],
    "f5_monetary_avg_per_order": ["monetary_avg_per_order"],
    "f6_is_single_order_customer": ["is_single_order_customer"],
    "f7_avg_days_between_orders": ["avg_days_between_orders"],
    "f8_recency_over_avg_gap": ["recency_over_avg_gap"],
    "f9_total_quantity": ["total_quantity"], "f10_distinct_products": ["distinct_products"],
    "f11_avg_items_per_order": ["avg_items_per_order"], "f12_avg_unit_price": ["avg_unit_price"],
    "f13_distinct_active_months": ["distinct_active_months"],
    "f14_avg_distinct_products_per_order": ["avg_distinct_products_per_order"],
    "f15_cancel_order_count": ["cancel_order_count"],
    "f16_cancel_order_rate": ["cancel_order_rate"],
    "f17_return_value_ratio": ["return_value_ratio"],
    "f18_orders_last_n_days": ["orders_last_30d", "orders_last_90d", "orders_last_180d"],
    "f19_spend_last_n_days": ["spend_last_90d", "spend_last_365d"],
    "f20_spend_momentum": ["spend_momentum"], "f21_latest_country": ["country"],
}
for _key, _columns in _GROUPS.items():
    _list = ", ".join(r(c, c) if c in DOUBLES else c for c in _columns)
    SQL[_key] = f"{FEAT} SELECT customer_id, {_list} FROM feats"
SQL["f22_customer_features"] = f"{FEAT} SELECT customer_id, {numeric()}, country FROM feats"
_PER_COUNTRY = """
per_country AS (
  SELECT country, count(DISTINCT customer_id) AS customers FROM bought GROUP BY country)"""
SQL["f23_country_vocabulary"] = f"""{OBS},{_PER_COUNTRY}
SELECT country, customers, customers >= {MIN_COUNTRY_CUSTOMERS} AS in_vocabulary FROM per_country"""
SQL["f23_vocabulary_coverage"] = f"""{OBS},{_PER_COUNTRY}
SELECT count(*) FILTER (WHERE customers >= {MIN_COUNTRY_CUSTOMERS}) AS countries_kept,
       {r(f'100 * CAST(coalesce(sum(customers) FILTER (WHERE customers >= {MIN_COUNTRY_CUSTOMERS}), 0) AS DOUBLE) / sum(customers)', 'pct_covered')}
FROM per_country"""
SQL["f24_raw_rfm"] = f"""{RRF}
SELECT customer_id, recency_days, frequency, {r('monetary', 'monetary')}, tenure_days, y
FROM raw_rfm"""

# Encoding
_HOT = ", ".join(f"CAST(country = '{v}' AS TINYINT) AS country_{v}" for v in VOCAB)
SQL["e1_one_hot_country"] = f"{FEAT} SELECT customer_id, {_HOT} FROM feats"
_ENCODED = ", ".join(
    f"CAST({c} AS TINYINT) AS {c}" if c == "is_single_order_customer"
    else f"CAST(0 AS TINYINT) AS {c}" if c == "distinct_products"
    else r(c, c) if c in DOUBLES else c for c in NUMERIC)
SQL["e2_encode_features"] = f"{FEAT} SELECT customer_id, {_ENCODED}, {_HOT} FROM feats"
SQL["e3_labelled_matrix"] = f"""{MAT}
SELECT customer_id, y, {numeric()}, {', '.join(COUNTRY_COLUMNS)} FROM matrix"""
_SCALED = ", ".join(
    r(f"(t.{c} - s.m_{c}) / CASE WHEN s.d_{c} = 0 THEN 1 ELSE s.d_{c} END", c) for c in CONTINUOUS)
_STATS = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS d_{c}" for c in CONTINUOUS)
SQL["e4_standardise"] = f"""{SPL}
SELECT customer_id, y, {_SCALED}, is_single_order_customer, {', '.join(COUNTRY_COLUMNS)}
FROM test t, (SELECT {_STATS} FROM train) s"""

# Splits
SQL["k1_stratified_split"] = f"{SPL} SELECT customer_id, y, split FROM split"
SQL["k2_stratified_folds"] = f"{SPL} SELECT customer_id, y, fold FROM folds"
SQL["k3_fold_summary"] = f"""{SPL}
SELECT fold, count(*) AS n_rows, {r('avg(y)', 'base_rate')} FROM folds GROUP BY fold"""

# Sources and sinks that give back what they were given
for _key in ("s1_read_parts", "s2_required_columns", "s6_build_raw_parquet"):
    SQL[_key] = SQL["s5_concat_parts"]
SQL["s8_checked_sink"] = SQL["e3_labelled_matrix"]
SQL["s9_prediction_sink"] = f"""{SPL}
SELECT customer_id, CAST(y AS INTEGER) AS y, {r('-recency_days', 'oof_proba')} FROM train"""
SQL["s10_reloaded_model"] = f"""{SPL}
SELECT split, count(*) AS n_rows, CAST(0 AS BIGINT) AS changed FROM split GROUP BY split"""
SQL["c11_cleaning_job"] = SQL["c0_clean_transactions"]
SQL["v6_frame_difference"] = f"""{LAB}
SELECT customer_id, CAST(y AS INTEGER) AS y,
       CAST(CASE customer_id % 10 WHEN 3 THEN 1 ELSE -1 END AS BIGINT) AS surplus
FROM labels_y WHERE customer_id % 10 IN (3, 4)"""
SQL["v7_single_rows_encode_alike"] = f"""{FEAT}
SELECT count(*) AS customers, CAST(0 AS BIGINT) AS different FROM feats"""
_VOLUME = ("frequency", "monetary_total", "spend_last_365d", "distinct_active_months",
           "total_quantity", "avg_items_per_order")
_SCALED_FEW = ", ".join(
    r(f"(t.{c} - s.m_{c}) / CASE WHEN s.d_{c} = 0 THEN 1 ELSE s.d_{c} END", c) for c in _VOLUME)
SQL["e5_standardise_subset"] = f"""{SPL}
SELECT customer_id, y, {_SCALED_FEW} FROM test t, (SELECT {_STATS} FROM train) s"""

# Fitted models: the slope vanishes for every feature, and every customer is scored once
_BINARY = ["is_single_order_customer", *COUNTRY_COLUMNS]


def _vanishing(columns) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS feature, TRUE AS vanishes" for c in columns)


SQL["d2_optimum"] = _vanishing([*CONTINUOUS, *_BINARY])
SQL["d4_optimum"] = _vanishing(_VOLUME)
_MODELS = ("(VALUES ('Logistic Regression'), ('Boosted trees, depth-bound'), "
           "('Boosted trees, leaf-bound')) m(candidate)")
SQL["d8_out_of_fold_coverage"] = f"""{SPL}
SELECT candidate, fold, count(*) AS n_rows, count(DISTINCT customer_id) AS customers,
       CAST(0 AS BIGINT) AS outside FROM folds, {_MODELS} GROUP BY candidate, fold"""
SQL["d9_test_coverage"] = f"""{SPL}
SELECT candidate, count(*) AS n_rows, count(DISTINCT customer_id) AS customers,
       CAST(0 AS BIGINT) AS outside FROM test, {_MODELS} GROUP BY candidate"""
