"""Failed and rerun tasks must not change rows or counts. Needs a session that retries, so it has its own process."""

from __future__ import annotations

import json
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]

SCRIPT = """
import json, sys
from pyspark import TaskContext
from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F
from siltworks.plans import Rules, audit_of, conform_counted
from siltworks.sources import write_silver

spark = (
    SparkSession.builder.master("local[4, 3]").config("spark.sql.shuffle.partitions", 4)
    .config("spark.sql.adaptive.coalescePartitions.enabled", False)
    .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate()
)
spark.sparkContext.setLogLevel("OFF")

@F.udf("long")
def shaky(value):
    # The first attempt of every task fails once it is well under way.
    if TaskContext.get().attemptNumber() == 0 and value is not None and value % 100 == 99:
        raise RuntimeError("lost")
    return value

home = sys.argv[1]
source = spark.range(0, 4000, 1, 4).select(
    F.when(F.col("id") % 10 == 0, None).otherwise(F.col("id") % 1500).alias("id"), F.col("id").alias("v")
)
source = source.withColumn("v", shaky("v"))  # below the shuffle
seen = Observation()
silver = conform_counted(source, ["id"], Rules(ranges=(("v", 0, 1399),)), None, seen)
silver.withColumn("v", shaky("v")).write.parquet(home + "/silver")  # above it, after the counts
counts = audit_of(seen)
counts["on_disk"] = spark.read.parquet(home + "/silver").count()
counts["write_silver"] = write_silver(source.repartition(4), home + "/plain")
print(json.dumps(counts))
"""


def test_counts_survive_rerun_tasks(tmp_path):
    run = subprocess.run(
        [sys.executable, "-c", SCRIPT, str(tmp_path)], cwd=ROOT, capture_output=True, text=True, timeout=300
    )
    assert run.returncode == 0, run.stderr[-2000:]
    counts = json.loads(run.stdout.strip().splitlines()[-1])
    keys = [i % 1500 for i in range(4000) if i % 10]
    smallest = {}
    for i in range(4000):
        if i % 10:
            smallest[i % 1500] = min(i, smallest.get(i % 1500, i))
    kept = sum(v <= 1399 for v in smallest.values())
    assert counts == {
        "rows_read": 4000,
        "malformed_rows": 0,
        "null_key_rows": 400,
        "duplicate_rows": len(keys) - len(smallest),
        "out_of_range_rows": len(smallest) - kept,
        "rows_written": kept,
        "on_disk": kept,
        "write_silver": 4000,
    }
