"""Table contracts: the declared columns and key of a table, as Spark schemas."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import types as T

_DECIMAL = re.compile(r"decimal\(\s*(\d+)\s*,\s*(\d+)\s*\)")

_TYPE_WORDS: dict[str, T.DataType] = {
    "integer": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def spark_type(word: str) -> T.DataType:
    """Spark type of a contract's type word; an unknown word is an error, never a silent string."""
    if word in _TYPE_WORDS:
        return _TYPE_WORDS[word]
    if match := _DECIMAL.fullmatch(word):
        return T.DecimalType(int(match[1]), int(match[2]))
    raise ValueError(f"unknown contract type {word!r}; known: {', '.join(_TYPE_WORDS)}, decimal(p,s)")


@dataclass(frozen=True)
class TableContract:
    """Name, ordered columns and key of a table. The key may have several columns."""

    name: str
    schema: T.StructType
    key: tuple[str, ...]

    def __post_init__(self) -> None:
        names = self.schema.fieldNames()
        if len(set(names)) != len(names):
            raise ValueError(f"{self.name}: column named twice")
        missing = [k for k in self.key if k not in names]
        if missing or not self.key:
            raise ValueError(f"{self.name}: key columns {missing or '(none)'} are not in the contract")

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @classmethod
    def of(cls, name: str, key: str | tuple[str, ...], columns: str) -> TableContract:
        """Contract from text, one ``name type [required]`` per line or semicolon."""
        fields = []
        for line in re.split(r"[\n;]", columns):
            if words := line.split():
                fields.append(T.StructField(words[0], spark_type(words[1]), "required" not in words[2:]))
        return cls(name, T.StructType(fields), (key,) if isinstance(key, str) else tuple(key))

    @classmethod
    def from_json(cls, text: str) -> TableContract:
        """Contract from its JSON form: ``table``, ``columns`` (name, type, nullable), ``primary_key``."""
        spec = json.loads(text)
        fields = [T.StructField(c["name"], spark_type(c["type"]), c["nullable"]) for c in spec["columns"]]
        key = spec["primary_key"]
        return cls(spec["table"], T.StructType(fields), (key,) if isinstance(key, str) else tuple(key))

    @classmethod
    def load(cls, path: str | Path) -> TableContract:
        return cls.from_json(Path(path).read_text(encoding="utf-8"))


def load_contracts(directory: str | Path) -> dict[str, TableContract]:
    """Every ``*.json`` contract of a directory, by table name."""
    found = (TableContract.load(p) for p in sorted(Path(directory).glob("*.json")))
    return {c.name: c for c in found}


# The retail table contracts. CSV columns bind by position, so the order matters.
CONTRACTS: Mapping[str, TableContract] = {
    c.name: c
    for c in (
        TableContract.of("distribution_centers", "id", """
            id integer required
            name string
            latitude double
            longitude double
        """),
        TableContract.of("products", "id", """
            id integer required
            cost float
            category string
            name string
            brand string
            retail_price float
            department string
            sku string
            distribution_center_id integer
        """),
        TableContract.of("users", "id", """
            id integer required
            first_name string
            last_name string
            email string
            age integer
            gender string
            state string
            street_address string
            postal_code string
            city string
            country string
            latitude double
            longitude double
            traffic_source string
            created_at timestamp required
        """),
        TableContract.of("orders", "order_id", """
            order_id integer required
            user_id integer required
            status string
            gender string
            created_at timestamp required
            returned_at timestamp
            shipped_at timestamp
            delivered_at timestamp
            num_of_item integer
        """),
        TableContract.of("order_items", "id", """
            id integer required
            order_id integer required
            user_id integer required
            product_id integer
            inventory_item_id integer
            status string
            created_at timestamp required
            shipped_at timestamp
            delivered_at timestamp
            returned_at timestamp
            sale_price float
        """),
        TableContract.of("inventory_items", "id", """
            id integer required
            product_id integer
            created_at timestamp required
            sold_at timestamp
            cost float
            product_category string
            product_name string
            product_brand string
            product_retail_price float
            product_department string
            product_sku string
            product_distribution_center_id integer
        """),
        TableContract.of("events", "id", """
            id integer required
            user_id integer
            sequence_number integer
            session_id string
            created_at timestamp required
            ip_address string
            city string
            state string
            postal_code string
            browser string
            traffic_source string
            uri string
            event_type string
        """),
    )
}

# The batch tables, in the order the gate and the landing report them.
GATE_TABLES = ("distribution_centers", "products", "orders", "users", "order_items", "inventory_items")
LANDING_TABLES = ("distribution_centers", "inventory_items", "order_items", "orders", "products", "users")


def contract_schema(table: str, contracts: Mapping[str, TableContract] = CONTRACTS) -> T.StructType:
    """The Spark schema of a table's contract."""
    return contracts[table].schema
