"""The reference's unit of work at its own size: a batch of 1.1 million rows and 49 columns through all 152 banking rules, cold and warm; one JSON line.

The fifty fixture rows with their defects are repeated with ids of their own (BATCH_ROWS, default 1,100,000), as Parquet; a run validates them and writes the outcome.
"""

import datetime as dt
import json
import os
import statistics
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from dqloom.operators.engine import validate
from dqloom.plans.banking import rules, schema
from dqloom.plans.registry import load_registry
from tests import banking


def main() -> None:
    n, cpus, runs = int(os.environ.get("BATCH_ROWS", 1_100_000)), os.environ.get("BENCH_CPUS", "8"), int(os.environ.get("BATCH_RUNS", 3))
    folder = Path(tempfile.mkdtemp(prefix="spark-"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("batch").config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g")).config("spark.sql.shuffle.partitions", str(4 * int(cpus))).config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").config("spark.python.sql.dataFrameDebugging.enabled", "false").config("spark.local.dir", tempfile.mkdtemp(prefix="spark-")).config("spark.checkpoint.dir", str(folder / "shared")).getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    banking.write(folder)
    fixture = spark.createDataFrame([tuple(r[c] for c in banking.BASE) for r in banking.rows()], ", ".join(f"{c} string" for c in banking.BASE))
    cell = lambda c: F.when(F.col(c) != "", F.col(c)).alias(c)
    own = {"transaction_id": 10, "account_id": 7, "customer_id": 6}  # digits of each id; every copy of the fixture has ids of its own
    shifted = {c: F.concat(F.regexp_extract(c, r"^(\D*)", 1), F.lpad((F.regexp_extract(c, r"(\d+)$", 1).try_cast("long") + F.col("copy") * 50).cast("string"), w, "0")) for c, w in own.items()}
    rows = fixture.select(*[cell(c) for c in banking.BASE]).withColumn("at", F.monotonically_increasing_id())
    copies = spark.range(0, max(1, n // 50), 1, 4 * int(cpus)).select(F.col("id").alias("copy"))
    batch = copies.join(F.broadcast(rows))  # fifty rows
    batch = batch.select("copy", "at", *[F.when(F.col(c).rlike(rf"^[A-Z]+\d{{{own[c]}}}$"), shifted[c]).otherwise(F.col(c)).alias(c) if c in own else F.col(c) for c in banking.BASE])
    batch = batch.withColumn("row_no", F.expr("row_number() over (partition by copy order by at)") + F.col("copy") * 50)
    batch.withColumn("record_id", F.concat(F.lit("ING_ROW_"), F.lpad(F.col("row_no").cast("string"), 9, "0"))).drop("copy", "at").write.parquet(str(folder / "batch"))
    data, registry, took, counts = spark.read.parquet(str(folder / "batch")), load_registry(schema(), rules(), folder), [], {}
    for _ in range(runs):
        began = time.perf_counter()
        v = validate(data, registry, dt.date(2025, 6, 1))
        counts = {r["status"]: r["count"] for r in v.rows.groupBy("status").count().collect()}
        took.append(round(time.perf_counter() - began, 2))
    print(json.dumps({"metric": "validate_batch", "rows": data.count(), "columns": len(banking.BASE), "rules": len(registry.rules), "cold": took[0], "warm": round(statistics.median(took[1:] or took), 2), "unit": "sec", "runs": took, "cpus": int(cpus), "outcome": counts}))


if __name__ == "__main__":
    main()
