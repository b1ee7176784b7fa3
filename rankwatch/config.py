"""Column roles, thresholds and limits of one risk-ranking project."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from typing import Any

# ---- fixed values: defaults a project starts from ---------------------------------
ID = "customer_id"
TARGET = "churn"
DATE = "signup_date"
TEXT = "customer_feedback"
NUMERIC = (
    "age",
    "monthly_income",
    "monthly_bill",
    "internet_usage_gb",
    "call_minutes",
    "support_tickets",
)
CATEGORICAL = ("gender", "city", "education_level", "employment_status", "contract_type")
REQUIRED = (
    "customer_id",
    "signup_date",
    "age",
    "gender",
    "city",
    "education_level",
    "employment_status",
    "monthly_income",
    "monthly_bill",
    "internet_usage_gb",
    "call_minutes",
    "contract_type",
    "support_tickets",
    "customer_feedback",
    "churn",
)
KEYWORDS = ("billing", "coverage", "support")
RANGES = {
    "age": (0, 120),
    "monthly_income": (0, None),
    "monthly_bill": (0, None),
    "internet_usage_gb": (0, None),
    "call_minutes": (0, None),
    "support_tickets": (0, None),
}
MONITOR_NUMERIC = (
    "monthly_bill",
    "internet_usage_gb",
    "call_minutes",
    "support_tickets",
    "customer_tenure_days",
)
MONITOR_CATEGORICAL = ("city", "contract_type", "employment_status")
HIGH_RISK, MEDIUM_RISK = 0.75, 0.50
# ---- end of fixed values ----------------------------------------------------------


@dataclass(frozen=True)
class Config:
    """Everything the operators need to know about a table; immutable."""

    id_column: str = ID
    target_column: str = TARGET
    date_column: str = DATE
    date_format: str = "yyyy-MM-dd"
    text_column: str = TEXT
    ticket_column: str = "support_tickets"
    age_column: str = "age"
    numeric: tuple[str, ...] = NUMERIC
    categorical: tuple[str, ...] = CATEGORICAL

    tenure_column: str = "customer_tenure_days"
    ticket_flag_column: str = "many_support_tickets_flag"
    length_column: str = "customer_feedback_length"
    keyword_prefix: str = "customer_feedback_keyword"
    keywords: tuple[str, ...] = KEYWORDS

    ticket_threshold: float = 3
    test_size: float = 0.2
    validation_size: float = 0.2
    seed: int = 42
    top_k: int = 100
    high_risk: float = HIGH_RISK
    medium_risk: float = MEDIUM_RISK
    decision_threshold: float = 0.5

    required: tuple[str, ...] = REQUIRED
    allow_missing: bool = False
    max_duplicates: int = 0
    ranges: Mapping[str, tuple[float | None, float | None]] = field(
        default_factory=lambda: dict(RANGES)
    )
    monitor_numeric: tuple[str, ...] = MONITOR_NUMERIC
    monitor_categorical: tuple[str, ...] = MONITOR_CATEGORICAL

    # All date and text columns a profile describes; empty: the one used by the features.
    date_columns: tuple[str, ...] = ()
    text_columns: tuple[str, ...] = ()

    # Ids read from CSV get this type.
    id_type: str = "bigint"
    # Quoted CSV fields may hold line breaks when this is on; a file is one task then.
    csv_line_breaks: bool = False

    def required_columns(self, require_target: bool) -> tuple[str, ...]:
        if require_target:
            return self.required
        return tuple(c for c in self.required if c != self.target_column)

    @property
    def dates(self) -> tuple[str, ...]:
        return self.date_columns or (self.date_column,)

    @property
    def texts(self) -> tuple[str, ...]:
        return self.text_columns or (self.text_column,)

    @property
    def keyword_columns(self) -> tuple[str, ...]:
        return tuple(f"{self.keyword_prefix}_{w.strip()}" for w in self.keywords)

    @property
    def derived(self) -> tuple[str, ...]:
        return (
            self.tenure_column,
            self.ticket_flag_column,
            self.length_column,
            *self.keyword_columns,
        )

    @property
    def model_numeric(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys(self.numeric + self.derived))

    def with_(self, **changes: Any) -> "Config":
        return replace(self, **changes)

    @classmethod
    def from_dict(cls, raw: Mapping[str, Any]) -> "Config":
        """Build a config from the nested mapping form of a project document."""
        data = raw.get("data", {})
        feats = raw.get("features", {})
        derived = feats.get("derived", {})
        split = raw.get("evaluation", {}).get("split", {})
        queue = raw.get("evaluation", {}).get("review_queue", {})
        rules = raw.get("validation", {})
        watch = raw.get("monitoring", {})
        flat = {
            "id_column": data.get("id_column"),
            "target_column": data.get("target_column"),
            "numeric": feats.get("numeric"),
            "categorical": feats.get("categorical"),
            # The first one feeds the features, all of them are profiled.
            "date_column": (feats.get("date") or [None])[0],
            "text_column": (feats.get("text") or [None])[0],
            "date_columns": feats.get("date"),
            "text_columns": feats.get("text"),
            "tenure_column": derived.get("tenure_column"),
            "ticket_flag_column": derived.get("support_ticket_rule_column"),
            "length_column": derived.get("feedback_length_column"),
            "keyword_prefix": derived.get("feedback_keyword_prefix"),
            "ticket_threshold": raw.get("baseline", {}).get("support_tickets_threshold"),
            "test_size": split.get("test_size"),
            "validation_size": split.get("validation_size"),
            "seed": split.get("random_seed"),
            "top_k": queue.get("default_top_k"),
            "required": rules.get("required_columns"),
            "max_duplicates": rules.get("max_duplicate_customer_ids"),
            "monitor_numeric": watch.get("key_numeric_features"),
            "monitor_categorical": watch.get("key_categorical_features"),
        }
        if "validation" in raw:
            # Missing values are only an error when the document says false.
            flat["allow_missing"] = rules.get("allow_missing_values") is not False
            flat["ranges"] = {
                c: (b.get("min"), b.get("max"))
                for c, b in rules.get("numeric_ranges", {}).items()
            }
        kept = {k: tuple(v) if isinstance(v, list) else v for k, v in flat.items() if v is not None}
        return cls(**kept)
