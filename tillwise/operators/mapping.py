"""Matching the columns of an uploaded table to the sales fields."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

# Field, label, and the column names it is known by, in the order they are tried.
FIELDS = {
    "order_date": ("Order date", ("order date", "invoice date", "date", "transaction date", "bill date", "sale date")),
    "order_id": (
        "Order or invoice ID",
        ("order id", "invoice no", "invoice number", "invoice id", "order no", "bill no", "receipt no", "transaction id"),
    ),
    "product": (
        "Product / SKU",
        ("product", "product name", "sku", "sku name", "item", "item name", "service", "description"),
    ),
    "category": ("Category", ("category", "product category", "department", "group", "product group")),
    "region": ("Region", ("region", "territory", "state", "zone", "area", "market")),
    "channel": ("Channel", ("channel", "sales channel", "source", "order channel", "store type")),
    "customer_segment": (
        "Customer segment",
        ("customer segment", "segment", "customer type", "client type", "account type"),
    ),
    "quantity": ("Quantity", ("quantity", "qty", "units", "units sold", "volume")),
    "net_revenue": (
        "Net revenue / sales",
        ("net revenue", "revenue", "sales", "sales value", "net sales", "amount", "net amount", "invoice value", "total"),
    ),
    "cost": ("Cost / COGS", ("cost", "cogs", "cost of goods sold", "total cost", "product cost", "landed cost")),
    "gross_profit": ("Gross profit", ("gross profit", "profit", "contribution", "margin value", "gp")),
    "discount_rate": (
        "Discount rate",
        ("discount rate", "discount %", "discount percentage", "discount pct", "discount"),
    ),
    "discount_amount": (
        "Discount amount",
        ("discount amount", "discount value", "discount amt", "discount spend"),
    ),
}
REQUIRED_FIELDS = ("order_date", "product", "net_revenue")
OPTIONAL_DIMENSIONS = ("region", "channel", "customer_segment", "category")


def clean_header(name: str) -> str:
    """Lower case letters, digits, % and single spaces."""
    spaced = re.sub(r"[_-]+", " ", name.lower())
    return " ".join(re.sub(r"[^a-z0-9% ]", "", spaced).split())


def infer_mapping(columns: Sequence[str]) -> dict[str, str]:
    """Column name per field: the first exact alias, else the first overlap with one, else empty.

    A column may serve several fields, and a header that cleans to nothing overlaps with every alias.
    """
    cleaned = [(name, clean_header(name)) for name in columns]
    mapping = {}
    for field, (_, aliases) in FIELDS.items():
        exact = (name for name, clean in cleaned if clean in aliases)
        close = (name for name, clean in cleaned if any(a in clean or clean in a for a in aliases))
        mapping[field] = next(exact, None) or next(close, "")
    return mapping


def require_mapping(mapping: Mapping[str, str]) -> None:
    for field in REQUIRED_FIELDS:
        if not mapping.get(field):
            raise ValueError(f"{FIELDS[field][0]} must be mapped.")
    if not mapping.get("cost") and not mapping.get("gross_profit"):
        raise ValueError("Map either Cost / COGS or Gross profit so profitability is real rather than invented.")


def mapping_warnings(mapping: Mapping[str, str]) -> list[str]:
    warnings = []
    if not mapping.get("order_id"):
        warnings.append("Order ID was not mapped. Each row is treated as one order, so AOV may be approximate.")
    for field in OPTIONAL_DIMENSIONS:
        if not mapping.get(field):
            warnings.append(f"{FIELDS[field][0]} was not mapped; that drilldown will use “Unspecified”.")
    return warnings
