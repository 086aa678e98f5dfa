"""From scores to a costed decision: an offer goes to everyone who scores below the threshold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortline.config import RetentionConfig
from cohortline.operators.metrics import score_levels


def campaign_cost(missed: Column, wasted: Column, cfg: RetentionConfig) -> Column:
    return F.lit(cfg.cost_missed_churner) * missed + F.lit(cfg.cost_wasted_offer) * wasted


def _offered(threshold: float | Column) -> Column:
    return F.col("score") < threshold


def cost_at(scores: DataFrame, threshold: float | Column, cfg: RetentionConfig) -> DataFrame:
    """Missed churners, wasted offers and their cost at one threshold."""
    offered = _offered(threshold)
    return scores.groupBy("candidate").agg(
        F.count_if(~offered & (F.col("y") == 0)).alias("missed"),
        F.count_if(offered & (F.col("y") == 1)).alias("wasted"),
        F.count("*").alias("n_rows"),
    ).withColumn("cost", campaign_cost(F.col("missed"), F.col("wasted"), cfg))


def threshold_curve(levels: DataFrame, cfg: RetentionConfig) -> DataFrame:
    """Cost at every observed score, from running totals instead of one scan per threshold."""
    missed = F.col("neg_total") - F.col("neg_upto") + F.col("neg")
    wasted = F.col("pos_upto") - F.col("pos")
    return levels.select(
        "candidate", F.col("score").alias("threshold"),
        missed.alias("missed"), wasted.alias("wasted"),
        campaign_cost(missed, wasted, cfg).alias("cost"),
        (F.col("pos_total") + F.col("neg_total")).alias("n_rows"),
    )


def best_thresholds(curve: DataFrame) -> DataFrame:
    """Cheapest threshold per candidate; the lowest one among equals."""
    best = F.min(F.struct("cost", "threshold", "n_rows")).alias("best")
    return curve.groupBy("candidate").agg(best).select(
        "candidate", "best.threshold", "best.cost",
        (F.col("best.cost") / F.col("best.n_rows")).alias("cost_per_customer"))


def sweep(scores: DataFrame, cfg: RetentionConfig, levels: DataFrame | None = None) -> DataFrame:
    """Best threshold per candidate; ``levels`` of the same scores save slicing them again."""
    return best_thresholds(threshold_curve(
        score_levels(scores) if levels is None else levels, cfg))


def apply_thresholds(scores: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Scores with their candidate's threshold. One row per candidate is sent to every task."""
    return scores.join(F.broadcast(thresholds.select("candidate", "threshold")), "candidate")


def trivial_policies(test_scores: DataFrame, thresholds: DataFrame, rule: str,
                     cfg: RetentionConfig) -> DataFrame:
    """Contact nobody, contact everybody, and the rule at its own threshold, on test rows."""
    ruled = apply_thresholds(test_scores.filter(F.col("candidate") == rule), thresholds)
    offered = _offered(F.col("threshold"))
    counts = ruled.agg(
        F.count("*").alias("n"),
        F.count_if(F.col("y") == 0).alias("churners"),
        F.count_if(F.col("y") == 1).alias("repeaters"),
        F.count_if(~offered & (F.col("y") == 0)).alias("missed"),
        F.count_if(offered & (F.col("y") == 1)).alias("wasted"),
    )
    zero = F.lit(0)
    policies = {
        "Contact nobody": campaign_cost(F.col("churners"), zero, cfg),
        "Contact everybody": campaign_cost(zero, F.col("repeaters"), cfg),
        rule: campaign_cost(F.col("missed"), F.col("wasted"), cfg),
    }
    entries = [
        F.struct(F.lit(name).alias("policy"), cost.alias("cost"),
                 (cost / F.col("n")).alias("cost_per_customer"))
        for name, cost in policies.items()
    ]
    cheapest = F.least(*policies.values())
    # Among equals the first in the order above is the best.
    best = F.coalesce(*[F.when(cost == cheapest, F.lit(n)) for n, cost in policies.items()])
    return (
        counts.select(best.alias("best"), F.inline(F.array(*entries)))
        .withColumn("is_best", F.col("policy") == F.col("best")).drop("best")
    )


def cost_reduction(test_scores: DataFrame, thresholds: DataFrame, selected: str, rule: str,
                   cfg: RetentionConfig) -> DataFrame:
    """Saving of the selected candidate against the best trivial policy, and the bar."""
    best = trivial_policies(test_scores, thresholds, rule, cfg).filter("is_best").select(
        F.struct("policy", "cost").alias("best")).scalar()
    chosen = apply_thresholds(test_scores.filter(F.col("candidate") == selected), thresholds)
    return (
        cost_at(chosen, F.col("threshold"), cfg).withColumn("best", best)
        .select(
            "candidate", "cost",
            F.col("best.policy").alias("best_trivial_policy"),
            F.col("best.cost").alias("best_trivial_cost"),
            F.when(F.col("best.cost") != 0, 1 - F.col("cost") / F.col("best.cost"))
            .alias("cost_reduction"),
        )
        .withColumn("meets_bar", F.col("cost_reduction") >= cfg.min_cost_reduction)
    )


def campaign_report(test_scores: DataFrame, thresholds: DataFrame) -> DataFrame:
    """What the retention team sees at the chosen threshold, per candidate."""
    offered = _offered(F.col("threshold"))
    churner = F.col("y") == 0
    counts = apply_thresholds(test_scores, thresholds).groupBy("candidate", "threshold").agg(
        F.count("*").alias("customers"),
        F.count_if(offered).alias("offers"),
        F.count_if(churner).alias("churners"),
        F.count_if(offered & churner).alias("caught"),
        F.count_if(~offered & churner).alias("missed"),
        F.count_if(offered & ~churner).alias("wasted"),
    )
    return counts.withColumns({
        "pct_offered": 100 * F.col("offers") / F.col("customers"),
        "pct_caught": F.when(F.col("churners") > 0, 100 * F.col("caught") / F.col("churners")),
        "pct_precision": F.when(F.col("offers") > 0, 100 * F.col("caught") / F.col("offers")),
    })


def f2_on_churners(report: DataFrame) -> DataFrame:
    """F2 of the non-repeat class: recall weighs four times as much as precision."""
    precision = F.when(F.col("offers") > 0, F.col("caught") / F.col("offers"))
    recall = F.when(F.col("churners") > 0, F.col("caught") / F.col("churners"))
    return report.select(
        "candidate", precision.alias("precision"), recall.alias("recall"),
    ).withColumn("f2", F.when(
        4 * F.col("precision") + F.col("recall") > 0,
        5 * F.col("precision") * F.col("recall") / (4 * F.col("precision") + F.col("recall"))))


def ratio_sensitivity(curve: DataFrame, wasted_costs: Sequence[float],
                      cfg: RetentionConfig) -> DataFrame:
    """Best threshold under other costs of a wasted offer, all from one pass over the curve."""
    costs = [campaign_cost(F.col("missed"), F.col("wasted"), cfg.with_(cost_wasted_offer=w))
             for w in wasted_costs]
    best = curve.groupBy("candidate").agg(*[
        F.min(F.struct(cost.alias("cost"), F.col("threshold"))).alias(f"best_{i}")
        for i, cost in enumerate(costs)
    ])
    return best.select("candidate", F.inline(F.array(*[
        F.struct(F.lit(float(w)).alias("wasted_cost"),
                 F.col(f"best_{i}.threshold").alias("threshold"),
                 F.col(f"best_{i}.cost").alias("cost"))
        for i, w in enumerate(wasted_costs)
    ])))


def campaign_list(scores: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Customers who get an offer."""
    return apply_thresholds(scores, thresholds).filter(_offered(F.col("threshold"))).select(
        "customer_id", "candidate", "score")


def acceptance(noise: DataFrame, reduction: DataFrame, cfg: RetentionConfig) -> DataFrame:
    """The three conditions a candidate must meet, and whether it meets them all."""
    return (
        noise.join(reduction, "candidate")
        .select(
            "candidate",
            (F.col("roc_auc") >= cfg.min_roc_auc).alias("auc_ok"),
            F.col("beats_rule").alias("beats_rule_ok"),
            F.coalesce("meets_bar", F.lit(False)).alias("cost_ok"),
        )
        .withColumn("accepted", F.col("auc_ok") & F.col("beats_rule_ok") & F.col("cost_ok"))
    )


def _as_struct(df: DataFrame, key: str, value: str, keys: Sequence[str]) -> Column:
    """A key/value table with known keys as one struct."""
    return df.agg(F.struct(*[
        F.max(F.when(F.col(key) == k, F.col(value))).alias(k.lower().replace(" ", "_"))
        for k in keys
    ])).scalar()


def selection_record(selected: str, model_path: str, rule: str, candidates: Sequence[str],
                     pooled: DataFrame, thresholds: DataFrame, test_scores: DataFrame,
                     cfg: RetentionConfig) -> DataFrame:
    """One nested row: the choice, its numbers, and a recommendation in words."""
    policies = trivial_policies(test_scores, thresholds, rule, cfg)
    reduction = cost_reduction(test_scores, thresholds, selected, rule, cfg)
    report = campaign_report(
        test_scores.filter(F.col("candidate") == selected), thresholds)
    threshold, saving = F.col("threshold"), F.col("cost_reduction")
    deploy = F.format_string(f"Use {selected} with offers below a score of %.4f.", threshold)
    keep_rule = F.format_string(
        f"Stay with the {rule}: {selected} saves %.1f percent of the campaign cost, and "
        f"{100 * cfg.min_cost_reduction:.0f} percent would be needed.", 100 * saving)
    meets = F.coalesce("meets_bar", F.lit(False))
    return (
        report.join(reduction, "candidate")
        .withColumns({
            "oof": _as_struct(pooled, "candidate", "roc_auc", candidates),
            "policy_costs": _as_struct(
                policies, "policy", "cost_per_customer",
                ["Contact nobody", "Contact everybody", rule]),
        })
        # The names in the record.
        .select(
            F.lit(selected).alias("selected_model"),
            F.lit(model_path).alias("model_path"),
            threshold.alias("threshold"),
            F.struct(
                F.lit(cfg.cost_missed_churner).alias("cost_missed_churner"),
                F.lit(cfg.cost_wasted_offer).alias("cost_wasted_offer"),
                F.lit(cfg.min_cost_reduction).alias("min_cost_reduction_required"),
            ).alias("decision_parameters"),
            F.struct(
                F.col("oof").alias("oof_roc_auc"),
                F.struct(
                    F.col("policy_costs.*"),
                    (F.col("cost") / F.col("customers")).alias("selected"),
                ).alias("test_cost_per_customer"),
                saving.alias("cost_reduction_vs_best_trivial_policy"),
                "best_trivial_policy",
                F.col("pct_offered").alias("test_offers_sent_pct"),
                F.col("pct_caught").alias("test_churners_caught_pct"),
                F.col("pct_precision").alias("test_offer_precision_pct"),
            ).alias("metrics"),
            meets.alias("meets_cost_reduction_bar"),
            F.when(meets, deploy).otherwise(keep_rule).alias("recommendation"),
            F.current_timestamp().alias("generated_at"),
        )
    )
