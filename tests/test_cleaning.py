from datetime import datetime

import pytest
from pyspark.sql import functions as F

from cohortline.operators import audit, checks, cleaning
from cohortline.config import RetentionConfig

DAY = datetime(2020, 5, 1, 10)
CFG = RetentionConfig()


@pytest.fixture
def raw(log):
    (log.add(1, DAY, "100", "47503J ")
        .add(1, DAY, "101", "\t20001\n")
        .add(1, DAY, "102", " 20002 ")
        .add(1, DAY, "103", "m").add(1, DAY, "104", "M").add(1, DAY, "105", "x")
        .add(1, DAY, "106", "DCGS0003").add(1, DAY, "107", "SP1002", description=None)
        .add(None, DAY, "A108", "20003", price=50.0)
        .add(1, DAY, "109", price=0.0).add(1, DAY, "110", price=-5.0)
        .add(1, DAY, "111", qty=-4)
        .add(1, DAY, "C112", qty=-3)
        .add(None, DAY, "113", country=" Spain "))
    return log.frame()


def test_rules_keep_and_trim(raw):
    clean = cleaning.clean_transactions(raw, CFG)
    rows = {r.invoice: r for r in clean.collect()}
    assert set(rows) == {"100", "101", "102", "105", "106", "107", "C112", "113"}
    assert rows["100"].stock_code == "47503J"
    assert rows["101"].stock_code == "20001"
    assert rows["102"].stock_code == "20002"
    assert rows["113"].country == "Spain" and rows["113"].customer_id is None
    assert rows["C112"].is_cancellation and rows["C112"].line_revenue == -6.0
    assert clean.columns == ["invoice", "stock_code", "quantity", "invoice_date", "price",
                             "customer_id", "country", "is_cancellation", "line_revenue"]
    checks.validate_clean(clean)


def test_frame_without_optional_columns(raw):
    narrow = raw.drop("description", "source_sheet")
    assert checks.frames_equal(
        cleaning.clean_transactions(narrow, CFG), cleaning.clean_transactions(raw, CFG))


def test_bad_customer_text_raises(raw):
    broken = raw.withColumn("customer_id", F.lit("not a number"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        cleaning.clean_transactions(broken, CFG).collect()


def test_audit_matches_filtering_step_by_step(raw):
    steps = {r.step: r for r in audit.filter_audit(raw, CFG).collect()}
    frame, start = cleaning.normalise(raw), raw.count()
    for name, keep in cleaning.keep_rules(CFG):
        kept = frame.filter(keep)
        assert steps[name].rows_before == frame.count()
        assert steps[name].rows_removed == frame.count() - kept.count()
        assert steps[name].pct_rows == pytest.approx(100 * steps[name].rows_removed / start)
        frame = kept
    totals = audit.audit_totals(raw, CFG).first()
    assert totals.rows_after == frame.count()
    assert totals.pct_gross_revenue == pytest.approx(
        sum(s.pct_gross_revenue for s in steps.values()))


def test_null_code_is_dropped_and_audited(log):
    log.add(1, DAY, "1", code=None).add(1, DAY, "2")
    raw = log.frame()
    assert cleaning.clean_transactions(raw, CFG).count() == 1
    removed = {r.step: r.rows_removed for r in audit.filter_audit(raw, CFG).collect()}
    assert removed["drop non-product codes"] == 1


def test_trim_audit(raw):
    changed = {r["column"]: r.rows_changed for r in audit.trim_changes(raw).collect()}
    assert changed == {"invoice": 0, "stock_code": 3, "description": 0, "country": 1}
    assert {r.after for r in audit.trim_samples(raw).collect()} == {
        "47503J", "20001", "20002", "Spain"}
    identity = audit.code_identity(raw).first()
    # "20001" exists untrimmed as the default code of other rows.
    assert identity.codes_trimmed == 3 and identity.trimmed_already_present == 1
    assert identity.codes_before == identity.codes_after + 1


def test_price_filter_loses_no_cancellation(raw, log):
    assert audit.price_filter_losses(raw, CFG).first().cancellations_removed == 0
    log.add(1, DAY, "C200", qty=-1, price=0.0)
    assert audit.price_filter_losses(log.frame(), CFG).first().cancellations_removed == 1


@pytest.mark.parametrize("column, value, message", [
    ("invoice", "'A1'", "adjustment_rows"),
    ("price", "0D", "unpriced_rows"),
    ("quantity", "-1", "sign_disagreements"),
    ("stock_code", "CAST(NULL AS STRING)", "null_stock_code"),
])
def test_clean_contract_fails_on_planted_violation(raw, column, value, message):
    clean = cleaning.clean_transactions(raw, CFG).withColumn(column, F.expr(value))
    with pytest.raises(checks.ContractViolation, match=message):
        checks.validate_clean(clean)


def test_raw_contract(raw):
    checks.validate_raw(raw)
    with pytest.raises(TypeError):
        checks.validate_raw(raw.withColumn("invoice", F.lit(1)))
    with pytest.raises(checks.ContractViolation, match="without an invoice"):
        checks.validate_raw(raw.withColumn(
            "invoice", F.when(F.col("invoice") != "100", F.col("invoice"))))
    with pytest.raises(checks.ContractViolation, match="no cancellation"):
        checks.validate_raw(raw.filter(~F.col("invoice").startswith("C")))


def test_frame_difference_counts_multiplicity(raw):
    assert checks.frames_equal(raw, raw.repartition(3))
    extra = checks.frame_difference(raw.union(raw.limit(1)), raw).collect()
    assert [r.surplus for r in extra] == [1]
