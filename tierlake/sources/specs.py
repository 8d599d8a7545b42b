"""Landing sources and their schema contracts.

A contract is a JSON-Schema-style mapping (``required``, ``properties`` with
``type``, ``pattern``, ``format``, ``enum``, ``minimum``, ``maximum``) so that
existing contract files load unchanged with ``load_contract``.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from typing import Any

Contract = dict[str, Any]


@dataclass(frozen=True)
class SourceSpec:
    name: str
    subpath: str
    file_format: str = "csv"
    primary_key: str = ""
    partition_cols: tuple[str, ...] = ("ingestion_date",)
    contract: Contract | None = field(default=None, hash=False, compare=False)


def load_contract(path_or_text: str) -> Contract:
    """Read a contract from a JSON file path or JSON text (driver-side, tiny)."""
    text = path_or_text
    if not path_or_text.lstrip().startswith("{"):
        with open(path_or_text) as fh:
            text = fh.read()
    return json.loads(text)


_S = {"type": "string"}
_SN = {"type": ["string", "null"]}

# The contracts of the three contracted sources.
SALES_CONTRACT: Contract = {
    "required": ["transaction_id", "order_id", "transaction_date", "product_id", "quantity",
                 "unit_price", "payment_method", "channel"],
    "properties": {
        "transaction_id": {"type": "string", "pattern": r"^TXN-\d+$"},
        "order_id": {"type": "string", "pattern": r"^ORD-\d+$"},
        "transaction_date": {"type": "string", "format": "date-time"},
        "store_id": {"type": ["string", "null"], "pattern": r"^STR-\d+$"},
        "customer_id": {"type": ["string", "null"], "pattern": r"^CUST-\d+$"},
        "product_id": {"type": "string", "pattern": r"^PRD-\d+$"},
        "quantity": {"type": "integer", "minimum": 1},
        "unit_price": {"type": "number", "minimum": 0},
        "discount_pct": {"type": "number", "minimum": 0, "maximum": 100},
        "payment_method": {"type": "string", "enum": ["credit_card", "debit_card", "cash", "pix", "voucher"]},
        "channel": {"type": "string", "enum": ["in_store", "online", "mobile"]},
    },
    "additionalProperties": False,
}

CUSTOMERS_CONTRACT: Contract = {
    "required": ["customer_id", "first_name", "last_name", "email", "registration_date"],
    "properties": {
        "customer_id": {"type": "string", "pattern": r"^CUST-\d+$"},
        "first_name": _S,
        "last_name": _S,
        "email": {"type": "string", "format": "email"},
        "phone": _SN,
        "date_of_birth": {"type": ["string", "null"], "format": "date"},
        "gender": {"type": ["string", "null"], "enum": ["M", "F", "O", None]},
        "loyalty_tier": {"type": ["string", "null"], "enum": ["Bronze", "Silver", "Gold", "Platinum", None]},
        "loyalty_points": {"type": ["integer", "null"], "minimum": 0},
        "registration_date": {"type": "string", "format": "date"},
        "address_line1": _SN,
        "address_line2": _SN,
        "city": _SN,
        "state": _SN,
        "zip_code": _SN,
        "country": _SN,
        "marketing_opt_in": {"type": ["boolean", "null"]},
    },
    "additionalProperties": False,
}

PRODUCTS_CONTRACT: Contract = {
    "required": ["product_id", "product_name", "category", "sku", "unit_cost", "unit_price", "is_active"],
    "properties": {
        "product_id": {"type": "string", "pattern": r"^PRD-\d+$"},
        "product_name": _S,
        "category": _S,
        "subcategory": _SN,
        "brand": _SN,
        "sku": _S,
        "unit_cost": {"type": "number", "minimum": 0},
        "unit_price": {"type": "number", "minimum": 0},
        "weight_kg": {"type": ["number", "null"], "minimum": 0},
        "is_perishable": {"type": "boolean"},
        "is_active": {"type": "boolean"},
        "launch_date": {"type": ["string", "null"], "format": "date"},
        "supplier_id": _SN,
    },
    "additionalProperties": False,
}

# The five landing sources.
SOURCES: dict[str, SourceSpec] = {
    "sales": SourceSpec("sales", "sales", "csv", "transaction_id", ("ingestion_date",), SALES_CONTRACT),
    "customers": SourceSpec("customers", "customers", "csv", "customer_id", ("ingestion_date",), CUSTOMERS_CONTRACT),
    "products": SourceSpec("products", "products", "csv", "product_id", ("ingestion_date",), PRODUCTS_CONTRACT),
    "stores": SourceSpec("stores", "stores", "csv", "store_id", ("ingestion_date",), None),
    "inventory": SourceSpec("inventory", "inventory", "csv", "inventory_id", ("ingestion_date",), None),
}
