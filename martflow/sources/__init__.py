"""Table contracts and file scans."""

from .contracts import (
    CUSTOMERS_SCHEMA,
    ORDER_RULES,
    ORDERS,
    ORDERS_SCHEMA,
    Contract,
    FiniteRule,
    Rule,
    finite_rule,
)
from .readers import HeaderError, read_contract, read_if_present, text_options

__all__ = [
    "CUSTOMERS_SCHEMA",
    "Contract",
    "FiniteRule",
    "HeaderError",
    "ORDERS",
    "ORDERS_SCHEMA",
    "ORDER_RULES",
    "Rule",
    "finite_rule",
    "read_contract",
    "read_if_present",
    "text_options",
]
