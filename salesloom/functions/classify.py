"""Grouping of findings for audit and reports."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Native column names counted as quantity and as price.
QUANTITY_FIELDS = ("qty", "quantity", "units")
PRICE_FIELDS = ("price", "unit_price", "item_price", "total_amount")


def _by_rule(rule: Column, duplicate: str) -> Column:
    return (
        F.when(rule.isin("MISSING_REQUIRED", "MISSING_OPTIONAL"), "missing_value")
        .when(rule.isin("DUPLICATE_BUSINESS_KEY", "CONFLICTING_DUPLICATE"), duplicate)
        .when(rule == "INVALID_DATE", "invalid_date")
        .when(rule == "INVALID_STATUS", "invalid_status")
        .when(rule == "UNMAPPED_PRODUCT", "unmapped_product")
    )


def audit_category(rule: Column, field: Column) -> Column:
    """Category of a finding in the audit tables (8 values)."""
    name = F.lower(F.coalesce(field, F.lit("")))
    return (
        _by_rule(rule, "duplicate")
        .when(name.isin(*QUANTITY_FIELDS), "invalid_quantity")
        .when(name.isin(*PRICE_FIELDS), "invalid_price_or_amount")
        .otherwise("other")
    )


def report_section(rule: Column, field: Column) -> Column:
    """Section of a finding in the run report (8 values; discount counts as price)."""
    name = F.lower(F.coalesce(field, F.lit("")))
    return (
        _by_rule(rule, "duplicate_business_key")
        .when(name.isin(*QUANTITY_FIELDS), "invalid_quantity")
        .when(name.isin(*PRICE_FIELDS, "discount_amount"), "invalid_price")
        .otherwise("type_cast_failure")
    )


# Keywords that classify a return rejection, first match wins.
RETURN_CLASSES = (
    ("duplicate", ("duplikat", "business key")),
    ("date", ("date", "tanggal", "yyyy-mm-dd")),
    ("status", ("status",)),
    ("quantity", ("quantity", "jumlah retur")),
    ("refund", ("refund", "net amount")),
    ("reference", ("tidak ditemukan", "cancelled", "merujuk")),
)


def return_rejection_class(reason: Column) -> Column:
    text = F.lower(F.coalesce(reason, F.lit("")))
    result = None
    for name, words in RETURN_CLASSES:
        test = text.contains(words[0])
        for word in words[1:]:
            test = test | text.contains(word)
        result = F.when(test, name) if result is None else result.when(test, name)
    return result.otherwise("required")
