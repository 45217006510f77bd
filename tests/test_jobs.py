"""The command-line jobs, chained: land, gate, refine, profile, publish, query, events."""

from __future__ import annotations

import uuid

import pytest

from siltworks import jobs
from siltworks.contracts import CONTRACTS
from siltworks.streaming import batch_report
from siltworks.sources import drop_database

VALUES = {
    "distribution_centers": ["1, Memphis ,35.1,-89.9", "1,Zzz,35.1,-89.9", "2,Nowhere,99,0", ",NoKey,1,1"],
    "products": ['1,2.5,Tops," Shirt, ""slim"" ", Acme ,5.0,Men ,SKU1,1'],
    "users": ["1, Ann , Lee , ANN@X.com ,30,F,TX,s,1, Austin , US ,1.0,2.0,Search,2024-01-05 10:00:00 UTC"],
    "orders": ["1,1, Shipped ,F,2024-01-05 10:00:00 UTC,,,,2"],
    "order_items": ["1,1,1,1,1, Shipped ,2024-01-05 10:00:00 UTC,,,,5.5"] * 2,
    "inventory_items": ["1,1,2024-01-05 10:00:00 UTC,,2.5,Tops,Shirt,Acme,5.0,Men,SKU1,1"],
    "events": ["1,1,1,s,2024-01-05 10:00:00 UTC,ip,c,st,1,Firefox,Email,/x,home"] * 3,
}


def _rows(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


@pytest.fixture(scope="module")
def lake(tmp_path_factory):
    home = tmp_path_factory.mktemp("lake")
    (home / "raw").mkdir()
    for table, lines in VALUES.items():
        text = "\n".join([",".join(CONTRACTS[table].columns), *lines]) + "\n"
        (home / "raw" / f"{table}.csv").write_text(text)
    return home


def test_jobs_chain(spark, lake):
    raw, bronze, silver = f"{lake}/raw", f"{lake}/bronze", f"{lake}/silver"
    landed = jobs.run(spark, ["land", "--raw", raw, "--bronze", bronze])
    assert all(landed for _, landed in _rows(landed, "table", "landed"))

    with pytest.raises(RuntimeError, match="distribution_centers"):
        jobs.run(spark, ["gate", "--bronze", bronze])
    passed = jobs.run(spark, ["gate", "--bronze", bronze, "--table", "products", "--table", "users"])
    assert _rows(passed, "table", "passed") == [("products", True), ("users", True)]

    report = jobs.run(spark, ["refine", "--bronze", bronze, "--silver", silver, "--run-date", "2024-01-31"])
    counts = {r[0]: r[1:6] for r in _rows(report, "*")}
    assert counts["distribution_centers"] == (4, 1, 1, 1, 1)
    assert counts["order_items"] == (2, 0, 1, 0, 1)
    user = spark.read.parquet(f"{silver}/users").first()
    assert (user["first_name"], user["last_name"], user["email"]) == ("Ann", "Lee", "ann@x.com")
    assert (user["city"], user["country"], str(user["ingestion_date"])) == ("Austin", "US", "2024-01-31")
    product = spark.read.parquet(f"{silver}/products").first()
    assert (product["name"], product["brand"], product["department"]) == ('Shirt, "slim"', "Acme", "Men")
    item = spark.read.parquet(f"{silver}/order_items").first()
    assert item["status"] == " Shipped "

    profile = jobs.run(spark, ["profile", "--bronze", bronze, "--table", "users"])
    assert ("users", "email", 1, 1) in _rows(profile, "table", "column_name", "padded_count", "not_lower_count")
    items = jobs.run(spark, ["profile", "--bronze", bronze, "--table", "order_items"])
    found = {r[0]: r[1:] for r in _rows(items, "column_name", "padded_count", "duplicated_values")}
    assert found["status"] == (2, None) and found["id"] == (None, 1)

    database = f"db_{uuid.uuid4().hex}"
    try:
        jobs.run(spark, ["publish", "--silver", silver, "--database", database])
        sql = "select u.email, o.status from users u join orders o on o.user_id = u.id"
        out = f"{lake}/out"
        found = jobs.run(spark, ["query", "--sql", sql, "--database", database, "--out", out])
        assert _rows(found, "*") == [(out, 1)] and _rows(spark.read.parquet(out), "*") == [("ann@x.com", "Shipped")]
        many = ["query", "--sql", "select id from range(2500)", "--out", f"{lake}/many"]
        assert _rows(jobs.run(spark, many), "rows_written") == [(2500,)]
        assert spark.read.parquet(f"{lake}/many").count() == 2500
    finally:
        drop_database(spark, database, cascade=True)


def test_events_job(spark, lake):
    feed = lake / "feed"
    feed.mkdir()
    lines = (lake / "raw" / "events.csv").read_text().splitlines()
    untimed = lines[1].replace("2024-01-05 10:00:00 UTC", "")
    for i in range(3):
        (feed / f"events{i}.csv").write_text("\n".join([lines[0], lines[1], untimed]) + "\n")
    paths = ["--source", str(feed), "--silver", f"{lake}/silver", "--checkpoint", f"{lake}/cp"]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    options = ["--watermark", "1 day", "--files-per-batch", "1", "--state-partitions", "3"]
    report = jobs.run(spark, ["events", *paths, *options])
    assert _rows(report, "*") == [("events", 0, 3)]
    assert spark.read.parquet(f"{lake}/silver/events").count() == 1
    sums = {(r["batches"], r["input_rows"], r["late_rows"]) for r in batch_report(spark, f"{lake}/cp/batches").collect()}
    assert (3, 6, 0) in sums and len(sums) == 2
    assert jobs.run(spark, ["events", *paths, *options]).first()["untimed_rows"] == 3  # nothing new, nothing twice
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
