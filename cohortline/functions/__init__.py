from cohortline.functions.expressions import (
    CODE_PATTERN,
    STRING_COLUMNS,
    gross_value,
    invoice_kind,
    is_cancelled_invoice,
    is_standard_code,
    line_value,
    micros_since_epoch,
    named,
    stripped,
    timestamp,
    whole_days,
)

__all__ = [
    "CODE_PATTERN", "STRING_COLUMNS", "gross_value", "invoice_kind", "is_cancelled_invoice",
    "is_standard_code", "line_value", "micros_since_epoch", "named", "stripped", "timestamp", "whole_days",
]
