from __future__ import annotations

import pytest
from pyspark.sql import types as T

from siltworks.contracts import CONTRACTS, GATE_TABLES, LANDING_TABLES, TableContract, load_contracts, spark_type
from siltworks.plans import PROFILES, RULES

JSON = """
{"table": "stores", "primary_key": "id",
 "columns": [{"name": "id", "type": "integer", "nullable": false},
             {"name": "area", "type": "decimal(9, 2)", "nullable": true},
             {"name": "opened", "type": "timestamp", "nullable": true}]}
"""


def test_json_contract(tmp_path):
    (tmp_path / "stores_schema.json").write_text(JSON)
    contract = load_contracts(tmp_path)["stores"]
    assert contract.key == ("id",)
    assert contract.schema == T.StructType(
        [
            T.StructField("id", T.IntegerType(), False),
            T.StructField("area", T.DecimalType(9, 2), True),
            T.StructField("opened", T.TimestampType(), True),
        ]
    )


def test_text_and_json_agree():
    text = TableContract.of("stores", "id", "id integer required; area decimal(9,2); opened timestamp")
    assert text == TableContract.from_json(JSON)


@pytest.mark.parametrize("word", ["int", "varchar", "", "decimal(9)"])
def test_unknown_type_word_is_an_error(word):
    with pytest.raises(ValueError, match="unknown contract type"):
        spark_type(word)


def test_key_must_be_declared():
    with pytest.raises(ValueError, match="not in the contract"):
        TableContract.of("t", "id", "a integer")
    with pytest.raises(ValueError, match="twice"):
        TableContract.of("t", "a", "a integer; a string")


def test_bundled_contracts():
    widths = {name: len(c.columns) for name, c in CONTRACTS.items()}
    assert widths == {
        "distribution_centers": 4,
        "products": 9,
        "users": 15,
        "orders": 9,
        "order_items": 11,
        "inventory_items": 12,
        "events": 13,
    }
    assert sorted(GATE_TABLES) == sorted(LANDING_TABLES) == sorted(set(CONTRACTS) - {"events"})
    assert {c.key for n, c in CONTRACTS.items() if n != "orders"} == {("id",)}
    assert CONTRACTS["orders"].key == ("order_id",)


def test_rules_and_profiles_name_contract_columns():
    for name, rules in RULES.items():
        assert rules.columns <= set(CONTRACTS[name].columns)
    for name, spec in PROFILES.items():
        named = {*spec.key, *spec.padded, *spec.lower, *spec.groups, *spec.extremes, *spec.bad}
        assert named <= set(CONTRACTS[name].columns)
