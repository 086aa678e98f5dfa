"""The decisions every stage shares, held in one frozen object that is passed explicitly."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import datetime, timedelta

# Stock codes that are not products (shipping, fees and accounting, internal
# test rows, gift vouchers). Matching is case-sensitive, on trimmed codes.
NON_PRODUCT_CODES = (
    "POST", "DOT", "C2", "C3",
    "M", "m", "D", "S", "BANK CHARGES", "AMAZONFEE", "CRUK", "B", "ADJUST", "ADJUST2", "PADS",
    "TEST001", "TEST002",
    "GIFT", "gift_0001_10", "gift_0001_20", "gift_0001_30", "gift_0001_40", "gift_0001_50",
    "gift_0001_60", "gift_0001_70", "gift_0001_80", "gift_0001_90",
)

# Countries that get their own indicator column; all others become OTHER.
COUNTRY_VOCAB = (
    "Belgium", "France", "Germany", "Netherlands", "Other", "Spain", "Switzerland",
    "United Kingdom",
)
OTHER = "Other"

# Column order of the encoded matrix, before the country indicators.
NUMERIC_FEATURES = (
    "recency_days", "frequency", "monetary_total", "monetary_avg_per_order",
    "tenure_days", "avg_days_between_orders", "recency_over_avg_gap",
    "is_single_order_customer",
    "total_quantity", "distinct_products", "avg_items_per_order", "avg_unit_price",
    "avg_distinct_products_per_order", "distinct_active_months",
    "cancel_order_count", "cancel_order_rate", "return_value_ratio",
    "orders_last_30d", "orders_last_90d", "orders_last_180d",
    "spend_last_90d", "spend_last_365d", "spend_momentum",
)


@dataclass(frozen=True)
class RetentionConfig:
    # Dates, shares, seed, costs and bars of the study.
    observation_start: datetime = datetime(2009, 12, 1)
    cutoff: datetime = datetime(2011, 9, 11)
    horizon_days: int = 90
    non_product_codes: tuple[str, ...] = NON_PRODUCT_CODES
    country_vocab: tuple[str, ...] = COUNTRY_VOCAB
    min_country_customers: int = 20
    seed: int = 42
    test_size: float = 0.2
    n_folds: int = 5
    cost_missed_churner: float = 1.0
    cost_wasted_offer: float = 0.15
    min_roc_auc: float = 0.75
    min_cost_reduction: float = 0.20
    search_settings: int = 40

    @property
    def prediction_end(self) -> datetime:
        return self.cutoff + timedelta(days=self.horizon_days)

    @property
    def observation_days(self) -> int:
        return (self.cutoff - self.observation_start).days

    @property
    def country_columns(self) -> tuple[str, ...]:
        return tuple(f"country_{name}" for name in self.country_vocab)

    @property
    def feature_columns(self) -> tuple[str, ...]:
        return NUMERIC_FEATURES + self.country_columns

    @property
    def binary_columns(self) -> tuple[str, ...]:
        return ("is_single_order_customer",) + self.country_columns

    @property
    def continuous_columns(self) -> tuple[str, ...]:
        return tuple(c for c in self.feature_columns if c not in self.binary_columns)

    def with_(self, **changes) -> "RetentionConfig":
        return replace(self, **changes)


# Settings for the TPC-H-like tables that stand in for a retail log (see sources/star_tables.py).
STAR_CONFIG = RetentionConfig(
    observation_start=datetime(1995, 1, 1),
    cutoff=datetime(2001, 5, 4),
    non_product_codes=("POST", "gift_0001_10"),
    country_vocab=(
        "NATION_0", "NATION_10", "NATION_11", "NATION_13", "NATION_19", "NATION_2",
        "NATION_3", "NATION_7", "Other",
    ),
    min_country_customers=66,
)
