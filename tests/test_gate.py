from __future__ import annotations

import gzip

import pytest

from siltworks.contracts import CONTRACTS, GATE_TABLES, TableContract
from siltworks.plans import GateFailure, run_gate, validate_all, validate_table

PAIR = TableContract.of("t", "id", "id integer; name string")


def _report(spark, tmp_path, text, contract=PAIR, **options):
    path = tmp_path / "t.csv"
    path.write_text(text)
    return tuple(validate_table(spark, contract, str(path), **options).collect()[0])[:6]


def test_passes(spark, tmp_path):
    assert _report(spark, tmp_path, "id,name\n1,a\n1,a\n") == ("t", True, True, 0, 2, True)


def test_null_keys(spark, tmp_path):
    assert _report(spark, tmp_path, 'id,name\n1,a\n,b\n"",c\n') == ("t", True, True, 2, 3, False)


def test_text_that_is_no_number_is_a_key_here(spark, tmp_path):
    assert _report(spark, tmp_path, "id,name\nx,a\n") == ("t", True, True, 0, 1, True)


def test_wrong_width_does_not_stop_the_key_check(spark, tmp_path):
    assert _report(spark, tmp_path, "id,name,more\n1,a,b\n,c,d\n") == ("t", True, False, 1, 2, False)


def test_only_the_count_of_columns_matters_unless_names_are_checked(spark, tmp_path):
    text = "id,other\n1,a\n"
    assert _report(spark, tmp_path, text) == ("t", True, True, 0, 1, True)
    assert _report(spark, tmp_path, text, check_names=True) == ("t", True, False, 0, 1, False)


def test_key_not_in_header(spark, tmp_path):
    assert _report(spark, tmp_path, "ident,name\n1,a\n") == ("t", True, True, -1, 0, False)


@pytest.mark.parametrize("text", ["id,name\n", ""])
def test_empty(spark, tmp_path, text):
    assert _report(spark, tmp_path, text) == ("t", False, False, -1, 0, False)


def test_missing(spark, tmp_path):
    row = validate_table(spark, PAIR, str(tmp_path / "nowhere")).collect()[0]
    assert tuple(row) == ("t", False, False, -1, 0, False, 0, "PATH_NOT_FOUND")


def test_unreadable(spark, tmp_path):
    (tmp_path / "t.csv.gz").write_bytes(b"not a gzip file at all")
    row = validate_table(spark, PAIR, str(tmp_path / "t.csv.gz")).collect()[0]
    assert tuple(row)[:6] == ("t", False, False, -1, 0, False)
    assert row["error"] not in (None, "PATH_NOT_FOUND")


def test_malformed_rows_are_counted(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("id,name\n1,a,more\n2\n3,c\n")
    row = validate_table(spark, PAIR, str(path)).first()
    assert (row["row_count"], row["malformed_rows"], row["passed"]) == (3, 2, True)


def test_composite_key(spark, tmp_path):
    contract = TableContract.of("t", ("a", "b"), "a integer; b integer")
    assert _report(spark, tmp_path, "a,b\n1,\n,2\n3,4\n", contract) == ("t", True, True, 2, 3, False)


def _bronze(tmp_path, texts):
    for table, text in texts.items():
        (tmp_path / table).mkdir()
        (tmp_path / table / f"{table}.csv").write_text(text)
    return str(tmp_path)


def _row(table, values):
    return ",".join(CONTRACTS[table].columns) + "\n" + values + "," * (len(CONTRACTS[table].columns) - 1) + "\n"


def test_gate_tries_all_tables_in_order_then_raises(spark, tmp_path):
    texts = {t: _row(t, "1") for t in GATE_TABLES if t not in ("orders", "users")}
    bronze = _bronze(tmp_path, texts | {"users": _row("users", "")})
    with pytest.raises(GateFailure) as failure:
        run_gate(spark, bronze)
    assert failure.value.tables == ["orders", "users"]
    report = failure.value.report.collect()
    assert [r["table"] for r in report] == list(GATE_TABLES)
    assert [r["passed"] for r in report] == [t not in ("orders", "users") for t in GATE_TABLES]


def test_a_table_that_breaks_in_the_middle(spark, tmp_path):
    bronze = _bronze(tmp_path, {t: _row(t, "1") for t in GATE_TABLES if t != "orders"})
    parts = tmp_path / "orders" / "orders.csv"
    parts.mkdir(parents=True)
    (parts / "part-0.csv").write_text(_row("orders", "1"))
    (parts / "part-1.csv.gz").write_bytes(gzip.compress(_row("orders", "2").encode() * 10_000)[:-200])
    with pytest.raises(GateFailure) as failure:
        run_gate(spark, bronze)
    assert failure.value.tables == ["orders"]
    assert [r["row_count"] for r in failure.value.report.collect()] == [int(t != "orders") for t in GATE_TABLES]


def test_gate_passes(spark, tmp_path):
    bronze = _bronze(tmp_path, {t: _row(t, "1") for t in GATE_TABLES})
    report = run_gate(spark, bronze)
    assert [(r["table"], r["row_count"]) for r in report.collect()] == [(t, 1) for t in GATE_TABLES]
    assert validate_all(spark, bronze).count() == len(GATE_TABLES)
