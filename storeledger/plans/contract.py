"""The contract of the semantic layer: entities, metrics, checks and policy.

Fixed values: names, types, aggregates, allow-lists and bounds below are the
published contract and must not be changed.
"""

import json

CONTRACT = {
    "entities": {
        "money_summary": {
            "table": "money_summary",
            "primary_key": "category",
            "fields": {
                "category": "text",
                "amount_gbp": "numeric",
                "pct_of_revenue": "numeric",
            },
        },
        "product_leaks": {
            "table": "product_leaks",
            "primary_key": "product",
            "fields": {
                "product": "text",
                "orders": "int",
                "units": "int",
                "revenue_gbp": "numeric",
                "discount_gbp": "numeric",
                "discount_pct": "numeric",
            },
        },
        "product_margin": {
            "table": "product_margin",
            "primary_key": "product",
            "fields": {
                "product": "text",
                "units": "int",
                "revenue_gbp": "numeric",
                "cogs_gbp": "numeric",
                "margin_gbp": "numeric",
                "margin_pct": "numeric",
                "discount_gbp": "numeric",
                "discount_share_of_potential_margin_pct": "numeric",
            },
        },
        "stock_capital": {
            "table": "stock_capital",
            "primary_key": "product",
            "fields": {
                "product": "text",
                "variant": "text",
                "inventory_quantity": "int",
                "unit_cost": "numeric",
                "capital_gbp": "numeric",
            },
        },
    },
    "policy": {
        "block_pii": ["PERSON", "EMAIL_ADDRESS", "PHONE_NUMBER", "CREDIT_CARD"],
        "max_rows": 500,
    },
    "metrics": {
        "shop_leaks": {
            "entity": "money_summary",
            "aggregate": "sum",
            "field": "amount_gbp",
            "dimensions_allowed": ["category"],
            "filters_allowed": ["category"],
        },
        "discount_by_product": {
            "entity": "product_leaks",
            "aggregate": "sum",
            "field": "discount_gbp",
            "dimensions_allowed": ["product"],
            "filters_allowed": ["product"],
        },
        "margin_by_product": {
            "entity": "product_margin",
            "aggregate": "sum",
            "field": "margin_gbp",
            "dimensions_allowed": ["product"],
            "filters_allowed": ["product"],
        },
        "margin_hit_by_discounts": {
            "entity": "product_margin",
            "aggregate": "avg",
            "field": "discount_share_of_potential_margin_pct",
            "dimensions_allowed": ["product"],
            "filters_allowed": ["product"],
        },
        "capital_in_stock": {
            "entity": "stock_capital",
            "aggregate": "sum",
            "field": "capital_gbp",
            "dimensions_allowed": ["product"],
            "filters_allowed": ["product"],
        },
    },
    "checks": {
        "margins_exist": {"entity": "product_margin", "kind": "row_count_min", "min": 1},
        "product_named": {"entity": "product_margin", "kind": "not_null", "field": "product"},
        "margin_pct_sane": {
            "entity": "product_margin",
            "kind": "range",
            "field": "margin_pct",
            "min": -100,
            "max": 100,
            "severity": "warn",
        },
    },
}

# Declared field types and the Spark types the marts carry for them.
SPARK_TYPES = {"text": "string", "int": "bigint", "numeric": "double"}


def load_contract(path: str) -> dict:
    """A contract file (YAML or JSON) in the shape of ``CONTRACT``.

    A field may be given as its type or as a mapping with a ``type``. YAML needs
    PyYAML; JSON does not.
    """
    with open(path, encoding="utf-8") as file:
        if path.endswith(".json"):
            contract = json.load(file)
        else:
            try:
                import yaml
            except ImportError as missing:
                raise RuntimeError("PyYAML is needed to read a YAML contract") from missing
            contract = yaml.safe_load(file)
    for entity in contract["entities"].values():
        entity["fields"] = {
            name: declared["type"] if isinstance(declared, dict) else declared
            for name, declared in entity["fields"].items()
        }
    policy = {"block_pii": [], **contract.get("policy", {})}
    return {"checks": {}, **contract, "policy": policy}
