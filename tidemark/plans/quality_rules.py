"""Quality rules per table. Rule ids, types, columns, valid-row expressions and severities.

An expression states when a row is *valid*; NULL counts as invalid unless the expression allows it.
"""

from __future__ import annotations

from tidemark.operators.quality import Rule

EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"


def _not_null(rule_id: str, col: str, severity: str = "SKIP_ROW") -> Rule:
    return Rule(rule_id, "NULL_CHECK", col, f"{col} is not null", severity)


def _range(rule_id: str, col: str, valid: str) -> Rule:
    return Rule(rule_id, "RANGE_CHECK", col, valid, "SKIP_ROW")


SILVER_DQ = {
    "customers": [
        _not_null("DQ-N-001", "customer_id", "ERROR"),
        _not_null("DQ-N-002", "email"),
        Rule("DQ-F-001", "FORMAT_CHECK", "email", f"email is null or email rlike r'{EMAIL_PATTERN}'", "WARNING"),
        Rule("STATUS_IS_NULL", "NULL_CHECK", "status", "status is not null", "WARNING"),
    ],
    "customer_registration_source": [
        _not_null("DQ-N-003", "registration_source_id"),
        _not_null("DQ-N-004", "customer_id"),
    ],
    "oe_order_headers_all": [
        _not_null("DQ-N-005", "order_id"),
        _not_null("DQ-N-006", "customer_id"),
        _range("DQ-V-001", "total_amount", "total_amount > 0"),
    ],
    "oe_order_lines_all": [
        _not_null("DQ-N-007", "line_id"),
        _not_null("DQ-N-008", "order_id"),
        _range("DQ-R-003", "quantity", "quantity > 0"),
        _range("DQ-R-004", "unit_price", "unit_price >= 0"),
    ],
    "addresses": [_not_null("DQ-N-009", "address_id"), _not_null("DQ-N-010", "customer_id")],
    "city_tier_master": [_not_null("DQ-N-011", "city"), _not_null("DQ-N-012", "state")],
    "mtl_system_items_b": [
        _not_null("DQ-N-013", "inventory_item_id"),
        _range("DQ-R-005", "unit_cost", "unit_cost >= 0"),
    ],
    "categories": [_not_null("DQ-N-014", "category_id")],
    "brands": [_not_null("DQ-N-015", "brand_id")],
    "marketing_campaigns": [
        _not_null("DQ-N-016", "campaign_id"),
        _range("DQ-R-006", "total_spend", "total_spend >= 0"),
    ],
    "incidents": [_not_null("DQ-N-017", "incident_id"), _not_null("DQ-N-018", "customer_id")],
    "interactions": [_not_null("DQ-N-019", "interaction_id"), _not_null("DQ-N-020", "incident_id")],
    "surveys": [
        _not_null("DQ-N-021", "survey_id"),
        _not_null("DQ-N-022", "customer_id"),
        _range("DQ-R-001", "nps_score", "nps_score between 0 and 10 or nps_score is null"),
        _range("DQ-R-002", "csat_score", "csat_score between 1 and 5 or csat_score is null"),
    ],
}

# (rule id, child, child key, parent, parent key); warnings: the row is still loaded
REFERENTIAL = [
    ("DQ-RI-001", "oe_order_headers_all", "customer_id", "customers", "customer_id"),
    ("DQ-RI-002", "customer_registration_source", "customer_id", "customers", "customer_id"),
    ("DQ-RI-003", "oe_order_lines_all", "order_id", "oe_order_headers_all", "order_id"),
]

GOLD_DQ = {
    "fact_sales": [
        _range("DQ-G-F-001", "line_total", "line_total >= 0"),
        _range("DQ-G-F-002", "quantity", "quantity > 0"),
    ],
    "fact_interactions": [_not_null("DQ-G-F-003", "interaction_id")],
    "fact_surveys": [
        _range("DQ-G-F-004", "nps_score", "nps_score between 0 and 10 or nps_score is null"),
        _range("DQ-G-F-005", "csat_score", "csat_score between 1 and 5 or csat_score is null"),
    ],
}

# measure checks on the finished facts
GOLD_MEASURES = {
    "fact_sales": [_range("DQ-G-M-001", "line_total", "line_total >= 0")],
    "fact_surveys": [_range("DQ-G-M-002", "nps_score", "nps_score between 0 and 10 or nps_score is null")],
}

# (rule id, dimension, key columns, row condition)
GOLD_UNIQUE = [
    ("DQ-G-D-001", "dim_customer", ("customer_id",), "_is_current"),
    ("DQ-G-D-003", "dim_product", ("inventory_item_id",), None),
    ("DQ-G-D-004", "dim_location", ("address_id",), None),
    ("DQ-G-D-005", "dim_campaign", ("campaign_id",), None),
    ("DQ-G-D-006", "dim_registration_source", ("registration_source_id",), None),
]

# the two hard-coded rule sets of the row-level silver load
ORDER_LOAD_RULES = [
    _range("ORDER_TOTAL", "total_amount", "total_amount > 0"),
    _not_null("ORDER_ID", "order_id"),
    _not_null("ORDER_CUSTOMER", "customer_id"),
]
CUSTOMER_LOAD_RULES = [
    _not_null("CUSTOMER_ID", "customer_id", "ERROR"),
    Rule("STATUS_IS_NULL", "NULL_CHECK", "status", "status is not null", "WARNING"),
]
