"""Checks of the quintile rule, the ranking metrics and the decision layer."""

from __future__ import annotations

from oracle.common import COST, RRF, RUL, SCO, SPL, THR, TST, auc, best, curve, r

SQL: dict[str, str] = {}

_BREAKS = ", ".join(
    f"list_sort(list_distinct(quantile_cont(CAST({c} AS DOUBLE), [0.2, 0.4, 0.6, 0.8]))) AS b_{c}"
    for c in ("recency_days", "frequency", "monetary"))


def _above(c: str) -> str:
    return f"len(list_filter(b_{c}, lambda e: CAST({c} AS DOUBLE) > e))"


_R1 = f"""{RRF}, scored AS (
  SELECT *, CAST(r_score + f_score + m_score AS INTEGER) AS rfm_score FROM (
    SELECT customer_id, y,
           CAST(len(b_recency_days) + 1 - {_above('recency_days')} AS INTEGER) AS r_score,
           CAST(1 + {_above('frequency')} AS INTEGER) AS f_score,
           CAST(1 + {_above('monetary')} AS INTEGER) AS m_score
    FROM raw_rfm, (SELECT {_BREAKS} FROM raw_rfm)))"""
SQL["r1_population_scores"] = f"{_R1} SELECT customer_id, r_score, f_score, m_score, rfm_score FROM scored"


def _rates(source: str, score: str) -> str:
    return (f"SELECT '{score}' AS score, {score} AS level, count(*) AS customers, "
            f"{r('avg(y)', 'repeat_rate')} FROM {source} GROUP BY {score}")


SQL["r2_rates_per_score"] = _R1 + "\n" + "\nUNION ALL ".join(
    _rates("scored", s) for s in ("r_score", "f_score", "m_score"))
SQL["r3_rates_combined"] = _R1 + "\n" + _rates("scored", "rfm_score")
SQL["r4_fit_edges"] = f"""{RUL}
SELECT col AS "column", CAST(len(edges) - 1 AS INTEGER) AS n_groups,
       CAST(i - 2 AS INTEGER) AS edge_no, {r('edges[i]', 'edge')}
FROM (SELECT *, unnest(range(2, len(edges))) AS i FROM edges WHERE fold = -1)"""
SQL["r5_apply_edges"] = f"""{RUL}
SELECT customer_id, recency_days_score, frequency_score, monetary_total_score FROM rule_train"""
SQL["r6_rule_totals"] = f"""{RUL}
SELECT 'train' AS split, customer_id, rfm_total FROM rule_train
UNION ALL SELECT 'test', customer_id, rfm_total FROM rule_test"""
SQL["r7_rates_on_split"] = RUL + "\n" + "\nUNION ALL ".join(
    [_rates("rule_train", s)
     for s in ("recency_days_score", "frequency_score", "monetary_total_score")]
    + [_rates("rule_test", "rfm_total")])
SQL["r8_out_of_fold_scores"] = f"{RUL} SELECT customer_id, fold, rfm_total FROM rule_oof"
_GROUPS = ", ".join(
    f"CAST(max(CASE WHEN col = '{c}' THEN len(edges) - 1 END) AS INTEGER) AS {c}_groups"
    for c in ("recency_days", "frequency", "monetary_total"))
SQL["r9_fold_diagnostics"] = f"""{RUL}, pooled AS (
  SELECT fold, y, rfm_total AS score FROM rule_oof
  UNION ALL SELECT -1, y, rfm_total FROM rule_train),
aucs AS ({auc('pooled', 'fold')}),
groups AS (SELECT fold, {_GROUPS} FROM edges GROUP BY fold)
SELECT fold, recency_days_groups, frequency_groups, monetary_total_groups, {r('roc_auc', 'roc_auc')}
FROM aucs JOIN groups USING (fold)"""

# Metrics
SQL["m1_roc_auc"] = f"""{SCO}, a AS ({auc('test_scores', 'candidate')})
SELECT candidate, {r('roc_auc', 'roc_auc')}, n_rows FROM a"""
# Precision of every positive row at its own score, averaged over positives.
SQL["m2_average_precision"] = f"""{SCO}
SELECT candidate, {r('avg(p)', 'pr_auc')} FROM (
  SELECT s.candidate, s.customer_id,
         CAST(count(*) FILTER (WHERE o.y = 1) AS DOUBLE) / count(*) AS p
  FROM test_scores s JOIN test_scores o ON o.candidate = s.candidate AND o.score >= s.score
  WHERE s.y = 1 GROUP BY s.candidate, s.customer_id) GROUP BY candidate"""
SQL["m3_roc_points"] = f"""{SCO}
SELECT t.candidate, {r('t.threshold', 'threshold')},
       {r('CAST(count(*) FILTER (WHERE s.y = 0 AND s.score >= t.threshold) AS DOUBLE) / count(*) FILTER (WHERE s.y = 0)', 'fpr')},
       {r('CAST(count(*) FILTER (WHERE s.y = 1 AND s.score >= t.threshold) AS DOUBLE) / count(*) FILTER (WHERE s.y = 1)', 'tpr')}
FROM (SELECT DISTINCT candidate, score AS threshold FROM test_scores
      UNION ALL SELECT DISTINCT candidate, NULL FROM test_scores) t
JOIN test_scores s ON s.candidate = t.candidate
GROUP BY t.candidate, t.threshold"""
SQL["m3_roc_corners"] = f"""{SCO}, levels AS (
  SELECT candidate, score, count(*) FILTER (WHERE y = 1) AS pos, count(*) FILTER (WHERE y = 0) AS neg
  FROM test_scores GROUP BY candidate, score),
points AS (
  SELECT candidate, score, pos, neg, row_number() OVER falling AS place,
         lead(pos) OVER falling AS pos_next, lead(neg) OVER falling AS neg_next,
         sum(pos) OVER falling AS tp, sum(neg) OVER falling AS fp,
         sum(pos) OVER (PARTITION BY candidate) AS all_pos, sum(neg) OVER (PARTITION BY candidate) AS all_neg
  FROM levels WINDOW falling AS (PARTITION BY candidate ORDER BY score DESC))
SELECT candidate, {r('score', 'threshold')}, {r('CAST(fp AS DOUBLE) / all_neg', 'fpr')},
       {r('CAST(tp AS DOUBLE) / all_pos', 'tpr')}
FROM points WHERE place = 1 OR pos_next IS NULL OR pos_next <> pos OR neg_next <> neg
UNION ALL SELECT DISTINCT candidate, CAST(NULL AS DOUBLE), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE) FROM levels"""
SQL["m4_univariate_auc"] = f"""{SPL}, s AS (
  SELECT 'frequency' AS candidate, y, CAST(frequency AS DOUBLE) AS score FROM train
  UNION ALL SELECT 'monetary_total', y, monetary_total FROM train), a AS ({auc('s', 'candidate')})
SELECT candidate, {r('roc_auc', 'roc_auc')} FROM a"""
SQL["m5_comparison"] = f"""{RUL}, s AS (
  SELECT 'RFM heuristic' AS candidate, customer_id, y, CAST(rfm_total AS DOUBLE) AS score FROM rule_test
  UNION ALL SELECT 'Majority class', customer_id, y, (SELECT avg(y) FROM train) FROM test),
a AS ({auc('s', 'candidate')}),
ap AS (SELECT candidate, avg(p) AS pr_auc FROM (
  SELECT s.candidate, s.customer_id,
         CAST(count(*) FILTER (WHERE o.y = 1) AS DOUBLE) / count(*) AS p
  FROM s JOIN s o ON o.candidate = s.candidate AND o.score >= s.score
  WHERE s.y = 1 GROUP BY s.candidate, s.customer_id) GROUP BY candidate)
SELECT candidate, {r('roc_auc', 'roc_auc')}, {r('pr_auc', 'pr_auc')},
       roc_auc > (SELECT roc_auc FROM a WHERE candidate = 'RFM heuristic') AS beats_rule,
       roc_auc >= 0.75 AS clears_bar
FROM a JOIN ap USING (candidate)"""
SQL["d1_majority_baseline"] = f"""{SPL}, learned AS (
  SELECT CAST(CASE WHEN avg(y) > 0.5 THEN 1 ELSE 0 END AS INTEGER) AS majority_class,
         avg(y) AS rate FROM train)
SELECT majority_class, {r('rate', 'constant_score')},
       {r('CAST((SELECT count(*) FROM test WHERE y = majority_class) AS DOUBLE) / (SELECT count(*) FROM test)', 'accuracy')},
       (SELECT count(*) FROM test) AS n_rows FROM learned"""

_SPREAD = f"""per_fold AS ({auc('train_scores', 'candidate, fold')}),
spread AS (SELECT candidate, avg(roc_auc) AS cv_roc_auc, stddev_pop(roc_auc) AS cv_std
           FROM per_fold GROUP BY candidate),
pooled AS ({auc('train_scores', 'candidate')})"""
_RULE_AUC = "(SELECT roc_auc FROM {t} WHERE candidate = 'RFM heuristic')"
SQL["d7_fold_spread_of_plain_scores"] = f"""{SCO}, {_SPREAD}
SELECT candidate, {r('cv_roc_auc', 'cv_roc_auc')}, {r('cv_std', 'cv_std')} FROM spread"""
SQL["m6_selection_of_plain_scores"] = f"""{SCO}, {_SPREAD},
fitted AS (SELECT * FROM spread WHERE candidate <> 'RFM heuristic'),
a AS ({auc('test_scores', 'candidate')}),
ap AS (SELECT candidate, avg(p) AS pr_auc FROM (
  SELECT s.candidate, s.customer_id,
         CAST(count(*) FILTER (WHERE o.y = 1) AS DOUBLE) / count(*) AS p
  FROM test_scores s JOIN test_scores o ON o.candidate = s.candidate AND o.score >= s.score
  WHERE s.y = 1 GROUP BY s.candidate, s.customer_id) GROUP BY candidate)
SELECT candidate, {r('cv_roc_auc', 'cv_roc_auc')}, {r('cv_std', 'cv_std')},
       {r('roc_auc', 'test_roc_auc')}, {r('pr_auc', 'test_pr_auc')},
       coalesce(cv_roc_auc - {_RULE_AUC.format(t='a')} > cv_std, FALSE) AS beats_rule_beyond_noise,
       candidate = (SELECT candidate FROM fitted ORDER BY cv_roc_auc DESC, candidate DESC LIMIT 1)
         AS best_by_cv
FROM a JOIN ap USING (candidate) LEFT JOIN fitted USING (candidate)"""
SQL["m7_noise_test_of_plain_scores"] = f"""{SCO}, {_SPREAD}
SELECT candidate, {r('roc_auc', 'roc_auc')}, {r('cv_std', 'cv_std')},
       {r('roc_auc - ' + _RULE_AUC.format(t='pooled'), 'gap')},
       roc_auc - {_RULE_AUC.format(t='pooled')} > cv_std AS beats_rule
FROM pooled JOIN spread USING (candidate) WHERE candidate <> 'RFM heuristic'"""

# Decisions
SQL["x1_cost_at_threshold"] = f"""{RUL}, c AS (
  SELECT count(*) FILTER (WHERE rfm_total >= 9 AND y = 0) AS missed,
         count(*) FILTER (WHERE rfm_total < 9 AND y = 1) AS wasted, count(*) AS n_rows FROM rule_oof)
SELECT 'RFM heuristic' AS candidate, missed, wasted, n_rows,
       {r(COST.format(missed='missed', wasted='wasted', wasted_cost='0.15'), 'cost')} FROM c"""
_BEST = f"candidate, {r('threshold', 'threshold')}, {r('cost', 'cost')}, {r('cost_per_customer', 'cost_per_customer')}"
SQL["x2_sweep_rule"] = f"{THR} SELECT {_BEST} FROM best WHERE candidate = 'RFM heuristic'"
SQL["x3_sweep_candidates"] = f"{THR} SELECT {_BEST} FROM best"
SQL["x4_trivial_policies"] = f"""{TST}
SELECT policy, {r('cost', 'cost')}, {r('cost_per_customer', 'cost_per_customer')}, is_best
FROM policies"""
SQL["x5_cost_reduction"] = f"""{TST}
SELECT candidate, {r('cost', 'cost')}, best_trivial_policy,
       {r('best_trivial_cost', 'best_trivial_cost')}, {r('cost_reduction', 'cost_reduction')},
       cost_reduction >= 0.2 AS meets_bar FROM reduction"""
SQL["x6_campaign_report"] = f"""{TST}
SELECT candidate, {r('threshold', 'threshold')}, n_rows AS customers, offers, churners, caught,
       missed, wasted, {r('100 * CAST(offers AS DOUBLE) / n_rows', 'pct_offered')},
       {r('CASE WHEN churners > 0 THEN 100 * CAST(caught AS DOUBLE) / churners END', 'pct_caught')},
       {r('CASE WHEN offers > 0 THEN 100 * CAST(caught AS DOUBLE) / offers END', 'pct_precision')}
FROM test_costs"""
SQL["x7_record_of_plain_scores"] = f"""{TST},
pooled AS ({auc('train_scores', 'candidate')})
SELECT c.candidate AS selected_model, 'models/selected' AS model_path,
       {r('c.threshold', 'threshold')}, {r('1.0', 'cost_missed_churner')},
       {r('0.15', 'cost_wasted_offer')}, {r('0.2', 'min_cost_reduction_required')},
       {r("(SELECT roc_auc FROM pooled WHERE candidate = 'RFM heuristic')", 'oof_rule')},
       {r("(SELECT roc_auc FROM pooled WHERE candidate = 'Recency')", 'oof_selected')},
       {r("(SELECT cost_per_customer FROM policies WHERE policy = 'Contact nobody')", 'cost_nobody')},
       {r("(SELECT cost_per_customer FROM policies WHERE policy = 'Contact everybody')", 'cost_everybody')},
       {r("(SELECT cost_per_customer FROM policies WHERE policy = 'RFM heuristic')", 'cost_rule')},
       {r('d.cost / c.n_rows', 'cost_selected')},
       {r('d.cost_reduction', 'cost_reduction_vs_best_trivial_policy')}, d.best_trivial_policy,
       {r('100 * CAST(offers AS DOUBLE) / n_rows', 'test_offers_sent_pct')},
       {r('CASE WHEN churners > 0 THEN 100 * CAST(caught AS DOUBLE) / churners END', 'test_churners_caught_pct')},
       {r('CASE WHEN offers > 0 THEN 100 * CAST(caught AS DOUBLE) / offers END', 'test_offer_precision_pct')},
       d.cost_reduction >= 0.2 AS meets_cost_reduction_bar,
       CASE WHEN d.cost_reduction >= 0.2
            THEN 'Use Recency with offers below a score of ' || printf('%.4f', c.threshold) || '.'
            ELSE 'Stay with the RFM heuristic: Recency saves ' || printf('%.1f', 100 * d.cost_reduction)
              || ' percent of the campaign cost, and 20 percent would be needed.'
            END AS recommendation
FROM test_costs c JOIN reduction d ON c.candidate = d.candidate"""
SQL["x8_acceptance"] = f"""{TST},
pooled AS ({auc('train_scores', 'candidate')}),
per_fold AS ({auc('train_scores', 'candidate, fold')}),
noise AS (SELECT candidate, stddev_pop(roc_auc) AS cv_std FROM per_fold GROUP BY candidate)
SELECT candidate, auc_ok, beats_rule_ok, cost_ok, auc_ok AND beats_rule_ok AND cost_ok AS accepted
FROM (SELECT p.candidate, p.roc_auc >= 0.75 AS auc_ok,
             p.roc_auc - (SELECT roc_auc FROM pooled WHERE candidate = 'RFM heuristic') > n.cv_std
               AS beats_rule_ok,
             d.cost_reduction >= 0.2 AS cost_ok
      FROM pooled p JOIN noise n USING (candidate) JOIN reduction d USING (candidate))"""
SQL["x9_campaign_list"] = f"""{THR}
SELECT s.customer_id, s.candidate, {r('s.score', 'score')}
FROM test_scores s JOIN best b ON s.candidate = b.candidate AND s.score < b.threshold"""
SQL["x10_f2_on_churners"] = f"""{TST}, pr AS (
  SELECT candidate, CASE WHEN offers > 0 THEN CAST(caught AS DOUBLE) / offers END AS p,
         CASE WHEN churners > 0 THEN CAST(caught AS DOUBLE) / churners END AS q FROM test_costs)
SELECT candidate, {r('p', '"precision"')}, {r('q', 'recall')},
       {r('CASE WHEN 4 * p + q > 0 THEN 5 * p * q / (4 * p + q) END', 'f2')} FROM pr"""
_COSTS = ("0.05", "0.1", "0.15", "0.3", "0.6")
SQL["x11_ratio_sensitivity"] = SCO + ",\ncurves AS (" + "\nUNION ALL ".join(
    f"SELECT CAST({w} AS DOUBLE) AS wasted_cost, * FROM ({curve('train_scores', w)})"
    for w in _COSTS) + "),\nb AS (" + best("curves", "candidate, wasted_cost") + f""")
SELECT candidate, {r('wasted_cost', 'wasted_cost')}, {r('threshold', 'threshold')},
       {r('cost', 'cost')} FROM b"""
SQL["s11_json_record_of_plain_scores"] = SQL["x7_record_of_plain_scores"]
