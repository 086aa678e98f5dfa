"""Checks of the exploratory profiles."""

from __future__ import annotations

from oracle.common import CUTOFF, END, FEAT, LAB, MAT, MIN_COUNTRY_CUSTOMERS, OBS, RAW, RRF, SPL, TX, r
from oracle.tables import KIND

SQL: dict[str, str] = {}

_ALL = ("invoice", "stock_code", "description", "quantity", "invoice_date", "price",
        "customer_id", "country", "source_sheet")
_TEXT = ("invoice", "stock_code", "description", "country")
_TRIM = r"regexp_replace({c}, '^\s+|\s+$', '', 'g')"
_RFM = ("recency_days", "frequency", "monetary", "tenure_days")


def pct(part: str, whole: str, name: str) -> str:
    return r(f"CASE WHEN {whole} <> 0 THEN 100 * CAST({part} AS DOUBLE) / {whole} END", name)


SQL["p1_shape_by_part"] = f"""{RAW}
SELECT source_sheet, count(*) AS n_rows, min(invoice_date) AS first_date,
       max(invoice_date) AS last_date FROM raw GROUP BY source_sheet"""
SQL["p1_head"] = f"""{RAW}
SELECT * FROM raw ORDER BY invoice_date, invoice, stock_code, quantity, price LIMIT 3"""
SQL["p2_null_profile"] = RAW + "\n" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS n_null, "
    f"{pct(f'(count(*) - count({c}))', 'count(*)', 'pct')} FROM raw" for c in _ALL)
SQL["p3_blank_counts"] = RAW + "\n" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE length({_TRIM.format(c=c)}) = 0) AS n_blank FROM raw"
    for c in _TEXT)
SQL["p4_short_descriptions"] = f"""{RAW}
SELECT description, count(*) AS n_rows FROM raw
WHERE length({_TRIM.format(c='description')}) <= 3 GROUP BY description"""
SQL["p5_unattributed_share"] = f"""{RAW}
SELECT count(*) FILTER (WHERE customer_id IS NULL) AS null_rows,
       {pct('count(*) FILTER (WHERE customer_id IS NULL)', 'count(*)', 'pct_rows')},
       {pct('coalesce(sum(quantity * price) FILTER (WHERE customer_id IS NULL), 0)', 'sum(quantity * price)', 'pct_revenue')},
       count(DISTINCT invoice) FILTER (WHERE customer_id IS NULL) AS null_invoices,
       count(DISTINCT invoice) AS all_invoices FROM raw"""
SQL["p6_mixed_invoices"] = f"""{RAW}
SELECT invoice, count(*) FILTER (WHERE customer_id IS NULL) AS n_null, count(*) AS n_rows
FROM raw GROUP BY invoice
HAVING count(*) FILTER (WHERE customer_id IS NULL) > 0 AND count(customer_id) > 0"""
SQL["p7_distinct_customers"] = f"""{RAW}
SELECT count(DISTINCT customer_id) AS without_null,
       (SELECT count(*) FROM (SELECT DISTINCT customer_id FROM raw)) AS null_as_value FROM raw"""
SQL["p8_sign_crosstab"] = f"""{RAW}
SELECT count(*) FILTER (WHERE invoice LIKE 'C%') AS c_prefix,
       count(*) FILTER (WHERE quantity < 0) AS negative,
       count(*) FILTER (WHERE invoice LIKE 'C%' AND quantity < 0) AS both,
       count(*) FILTER (WHERE invoice LIKE 'C%' AND quantity >= 0) AS c_not_negative,
       count(*) FILTER (WHERE invoice NOT LIKE 'C%' AND quantity < 0) AS negative_not_c FROM raw"""
_GAP = f"{RAW}, gap AS (SELECT * FROM raw WHERE quantity < 0 AND invoice NOT LIKE 'C%')"
SQL["p9_gap_profile"] = f"""{_GAP}
SELECT count(*) AS n_rows, {r('min(price)', 'min_price')}, {r('max(price)', 'max_price')},
       {pct('(count(*) - count(customer_id))', 'count(*)', 'pct_unattributed')} FROM gap"""
SQL["p9_gap_descriptions"] = f"""{_GAP}
SELECT description, count(*) AS n_rows FROM gap GROUP BY description
ORDER BY n_rows DESC, description ASC NULLS FIRST LIMIT 12"""
SQL["p10_invoice_kinds"] = f"""{RAW}
SELECT {KIND} AS kind, count(*) AS n_rows, count(DISTINCT invoice) AS invoices,
       {r('sum(quantity * price)', 'revenue')} FROM raw GROUP BY 1"""
_STD = r"regexp_matches(stock_code, '^\d{5}\w*$')"
SQL["p11_code_shapes"] = f"""{RAW}
SELECT count(*) FILTER (WHERE {_STD}) AS standard_rows,
       {pct(f'count(*) FILTER (WHERE {_STD})', 'count(*)', 'pct_standard')},
       count(*) FILTER (WHERE NOT {_STD}) AS other_rows,
       count(DISTINCT stock_code) FILTER (WHERE NOT {_STD}) AS other_codes FROM raw"""
SQL["p12_code_taxonomy"] = f"""{RAW}
SELECT stock_code, count(*) AS n_rows, min(description) AS example_description
FROM raw WHERE NOT {_STD} GROUP BY stock_code"""
SQL["p13_price_anomalies"] = f"""{RAW}
SELECT count(*) FILTER (WHERE price = 0) AS zero_price_rows,
       {pct('count(*) FILTER (WHERE price = 0 AND customer_id IS NULL)', 'count(*) FILTER (WHERE price = 0)', 'pct_zero_unattributed')},
       count(*) FILTER (WHERE price < 0) AS negative_price_rows FROM raw"""
SQL["p14_quantity_summary"] = f"""{RAW}
SELECT {r('median(quantity)', 'median_quantity')},
       {r('''(SELECT quantity FROM (SELECT quantity, row_number() OVER (ORDER BY quantity) - 1 AS place,
                count(*) OVER () AS n FROM raw)
         WHERE place = floor(CAST(0.99 AS DOUBLE) * (n - 1) + 0.5))''', 'p99_quantity')},
       min(quantity) AS min_quantity, max(quantity) AS max_quantity FROM raw"""
SQL["p15_extreme_quantities"] = f"""{RAW}
SELECT invoice, stock_code, description, quantity, price, customer_id, invoice_date
FROM raw WHERE abs(quantity) > 49"""
SQL["p16_duplicate_rows"] = f"""{RAW}
SELECT n - u AS duplicate_rows, {pct('(n - u)', 'n', 'pct')}
FROM (SELECT (SELECT count(*) FROM raw) AS n, (SELECT count(*) FROM (SELECT DISTINCT * FROM raw)) AS u)"""
SQL["p17_most_repeated"] = f"""{RAW}
SELECT invoice, stock_code, description, quantity, price, copies
FROM (SELECT {', '.join(_ALL)}, count(*) AS copies FROM raw GROUP BY ALL HAVING count(*) > 1)
ORDER BY copies DESC, invoice, stock_code, quantity, price, description NULLS FIRST LIMIT 5"""
_COUNTRY = f"""{RAW}, per_country AS (
  SELECT country, count(DISTINCT customer_id) AS customers FROM raw
  WHERE customer_id IS NOT NULL GROUP BY country)"""
SQL["p18_customers_per_country"] = f"{_COUNTRY} SELECT * FROM per_country"
SQL["p19_top_country_coverage"] = _COUNTRY + "\n" + "\nUNION ALL ".join(
    f"SELECT CAST({n} AS INTEGER) AS top_n, "
    + pct(f"(SELECT sum(customers) FROM (SELECT customers FROM per_country ORDER BY customers DESC, country LIMIT {n}))",
          "(SELECT sum(customers) FROM per_country)", "pct")
    for n in (1, 5, 10, 15))
SQL["p20_rare_countries"] = f"""{_COUNTRY}
SELECT count(*) AS countries,
       count(*) FILTER (WHERE customers < {MIN_COUNTRY_CUSTOMERS}) AS rare_countries FROM per_country"""
SQL["p21_multi_country_customers"] = f"""{RAW}
SELECT customer_id, count(DISTINCT country) AS n_countries FROM raw
WHERE customer_id IS NOT NULL GROUP BY customer_id HAVING count(DISTINCT country) > 1"""
SQL["p22_population_funnel"] = f"""{RAW}, seen AS (
  SELECT * FROM raw WHERE customer_id IS NOT NULL AND invoice_date < {CUTOFF})
SELECT any_activity, real_buyers, any_activity - real_buyers AS cancel_only
FROM (SELECT count(DISTINCT customer_id) AS any_activity,
             count(DISTINCT customer_id) FILTER (WHERE invoice NOT LIKE 'C%') AS real_buyers FROM seen)"""
SQL["p23_base_rate"] = f"""{LAB}
SELECT count(*) AS customers, CAST(sum(y) AS BIGINT) AS repeaters,
       count(*) FILTER (WHERE y = 0) AS non_repeaters, {r('avg(y)', 'base_rate')} FROM labels_y"""
SQL["p24_medians_by_label"] = f"""{RRF}
SELECT y, {', '.join(r(f'median({c})', c) for c in _RFM)} FROM raw_rfm GROUP BY y"""
SQL["p25_label_correlations"] = RRF + "\n" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS feature, {r(f'corr({c}, y)', 'correlation')} FROM raw_rfm" for c in _RFM)
_VOLUME = ("frequency", "monetary_total", "spend_last_365d", "distinct_active_months",
           "total_quantity", "avg_items_per_order")
SQL["p26_correlation_matrix"] = SPL + "\n" + "\nUNION ALL ".join(
    f"SELECT '{a}' AS feature, {', '.join(r(f'corr({a}, {b})', b) for b in _VOLUME)} FROM train"
    for a in _VOLUME)
_LIFECYCLE = ("recency_days", "avg_days_between_orders", "recency_over_avg_gap")
SQL["p26_recency_correlations"] = SPL + "\n" + "\nUNION ALL ".join(
    f"SELECT '{a}' AS feature, {', '.join(r(f'corr({a}, {b})', b) for b in _LIFECYCLE)} FROM train"
    for a in _LIFECYCLE)
SQL["p27_skewness"] = RRF + "\n" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS feature, "
    + r(f"avg(pow({c} - m, 3)) / pow(avg(pow({c} - m, 2)), CAST(1.5 AS DOUBLE))", "skewness")
    + f" FROM raw_rfm, (SELECT avg({c}) AS m FROM raw_rfm)" for c in _RFM[:3])
_CAPS = {"recency_days": 730, "frequency": 30, "monetary": 10000}
SQL["p28_label_histograms"] = RRF + ", clipped AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, y, least(CAST({c} AS DOUBLE), {cap}) AS v FROM raw_rfm"
    for c, cap in _CAPS.items()) + """),
ranges AS (SELECT feature, y, min(v) AS low, max(v) AS high FROM clipped GROUP BY feature, y)
SELECT feature, y,
       CAST(CASE WHEN high = low THEN 20 ELSE least(floor((v - low) * 40 / (high - low)), 39) END
            AS INTEGER) AS bin,
       count(*) AS customers
FROM clipped JOIN ranges USING (feature, y) GROUP BY 1, 2, 3"""
_MOMENTUM = ("orders_last_30d", "orders_last_90d", "orders_last_180d", "spend_last_90d",
             "spend_last_365d", "spend_momentum")
SQL["p29_summary_statistics"] = MAT + "\n" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS n, {r(f'avg({c})', 'mean')}, "
    f"{r(f'stddev_samp({c})', 'std')}, {r(f'min({c})', 'min')}, {r(f'max({c})', 'max')}, "
    f"{r(f'quantile_cont({c}, 0.25)', 'p25')}, {r(f'quantile_cont({c}, 0.5)', 'p50')}, "
    f"{r(f'quantile_cont({c}, 0.75)', 'p75')} FROM matrix" for c in _MOMENTUM)
SQL["p30_single_order_cohorts"] = f"""{RRF}
SELECT frequency = 1 AS single_order, count(*) AS customers, {r('avg(y)', 'repeat_rate')},
       {r('100 * CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM raw_rfm)', 'pct')}
FROM raw_rfm GROUP BY 1"""
SQL["p31_cancellation_cohorts"] = f"""{RRF}
SELECT customer_id IN (SELECT customer_id FROM raw WHERE customer_id IS NOT NULL
         AND invoice LIKE 'C%' AND invoice_date < {CUTOFF}) AS has_cancelled,
       count(*) AS customers, {r('avg(y)', 'repeat_rate')},
       {r('100 * CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM raw_rfm)', 'pct')},
       {r('median(frequency)', 'frequency_median')} FROM raw_rfm GROUP BY 1"""
SQL["p32_rows_per_weekday"] = f"""{RAW}
SELECT CAST(isodow(invoice_date) AS INTEGER) AS weekday_no, dayname(invoice_date) AS weekday,
       count(*) AS n_rows FROM raw GROUP BY 1, 2"""
SQL["p33_rows_on_day"] = f"""{RAW}
SELECT count(*) AS n_rows FROM raw WHERE CAST(invoice_date AS DATE) = DATE '2001-05-03'"""
SQL["p34_anchor_shift"] = f"""{RAW}
SELECT max(invoice_date) AS last_date, date_sub('day', {CUTOFF}, max(invoice_date)) AS shift_days
FROM raw"""
SQL["p35_window_sizes"] = f"""{TX}
SELECT CASE WHEN invoice_date < {CUTOFF} THEN 'observation' WHEN invoice_date < {END}
            THEN 'prediction' ELSE 'after horizon' END AS "window", count(*) AS n_rows,
       {r('100 * CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM clean)', 'pct')}
FROM clean GROUP BY 1"""
SQL["p36_lost_customers"] = f"""{TX}, seen AS (
  SELECT * FROM raw WHERE customer_id IS NOT NULL AND invoice_date < {CUTOFF}),
lost AS (
  SELECT customer_id FROM seen WHERE invoice NOT LIKE 'C%'
  EXCEPT SELECT customer_id FROM clean
         WHERE customer_id IS NOT NULL AND NOT is_cancellation AND invoice_date < {CUTOFF}),
theirs AS (SELECT * FROM seen WHERE customer_id IN (SELECT customer_id FROM lost))
SELECT stock_code, count(*) AS n_rows, (SELECT count(*) FROM lost) AS lost_customers,
       (SELECT count(*) FROM theirs) AS lost_rows FROM theirs GROUP BY stock_code"""
SQL["p37_same_day_repeaters"] = f"""{OBS}
SELECT count(*) FILTER (WHERE span = 0 AND n > 1) AS same_day_repeaters, count(*) AS customers
FROM (SELECT customer_id, date_sub('day', min(invoice_date), max(invoice_date)) AS span,
             count(DISTINCT invoice) AS n FROM bought GROUP BY customer_id)"""
SQL["p38_return_ratio_range"] = f"""{FEAT}
SELECT {r('min(return_value_ratio)', 'min_return_value')},
       {r('max(return_value_ratio)', 'max_return_value')},
       count(*) FILTER (WHERE return_value_ratio > 1) AS above_one,
       {r('min(cancel_order_rate)', 'min_cancel_rate')},
       {r('max(cancel_order_rate)', 'max_cancel_rate')} FROM feats"""
SQL["p39_customer_history"] = f"""{TX}
SELECT invoice, is_cancellation, quantity, price, line_revenue, invoice_date
FROM clean WHERE customer_id = 37 AND invoice_date < {CUTOFF}"""
