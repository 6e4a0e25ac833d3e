"""Times the toolkit's headline queries; prints one JSON line.

The workloads have the row counts, kinds of columns and row groups (250,000
rows) of the published figures; their values are those of ``lineitem``, whose
rows are repeated as often as a count asks for.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from lamina.sources.scan import open_parquet
from lamina.sources.write import write_parquet
from lamina.session import run_dir

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "5"))


def noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    lineitem = open_parquet(spark, f"{SF_DIR}/lineitem.parquet")
    at = f"{run_dir(spark)}/bench"
    rows = spark.read.parquet(lineitem.path)
    copies = -(-2_000_000 // lineitem.dim[0])
    many = rows.crossJoin(spark.range(copies).select(F.col("id").alias("copy"))).withColumn("id", (F.monotonically_increasing_id() % (1 << 31)).cast("int"))
    sometimes = lambda c: F.when(F.xxhash64("id") % 10 != 0, F.col(c)).alias(c)
    numeric = many.select("id", F.col("l_quantity").alias("count"), F.col("l_discount").alias("ratio"), F.col("l_extendedprice").alias("price"), (F.col("l_linestatus") == "O").alias("flag")).limit(2_000_000)
    label = lambda n: F.concat(F.lit("label-"), F.col("l_partkey") % n).alias("label")
    stamp = F.convert_timezone(F.lit("UTC"), F.current_timezone(), "l_shipdate").cast("timestamp")
    mixed = many.select("id", F.to_date("l_shipdate").alias("when"), stamp.alias("stamp"), label(50), F.col("l_extendedprice").alias("value"), F.when(F.xxhash64("id") % 10 != 0, F.col("l_linestatus") == "O").alias("flag")).limit(1_000_000)
    tables = {
        "numeric": numeric,
        "numeric_nulls": numeric.select("id", *[sometimes(c) for c in ("count", "ratio", "price")]),
        "string_low_cardinality": many.select(F.col("id").alias("key"), label(200), F.col("l_extendedprice").alias("value")).limit(1_000_000),
        "string_high_cardinality": many.select(F.concat_ws("-", "l_orderkey", "l_linenumber", "copy").alias("uid"), F.col("l_extendedprice").alias("value")).limit(1_000_000),
        "mixed": mixed,
    }
    files, cached = {}, {}
    for name, df in tables.items():
        write_parquet(df, f"{at}-{name}.parquet", row_group_size=250_000)
        files[name] = open_parquet(spark, f"{at}-{name}.parquet")
        cached[name] = spark.read.parquet(f"{at}-{name}.parquet")
    numbers = ["l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount"]
    runs = {f"read_{name}": lambda f=f: noop(f.collect()) for name, f in files.items()}
    runs |= {
        "collect_projection": lambda: noop(files["mixed"].collect(["id", "value"])),
        "collect_row_groups": lambda: noop(files["mixed"].collect(row_groups=[2])),
        "walk_batches": lambda: files["mixed"].walk_batches(lambda batch, index: None),
    }
    runs |= {f"write_{name}": lambda name=name: write_parquet(cached[name], f"{at}-out-{name}.parquet") for name in ("numeric", "string_low_cardinality", "mixed")}
    runs |= {
        "read_integer64": lambda: noop(lineitem.collect(numbers, int64="integer64")),
        "collect_pushed_filter": lambda: noop(lineitem.collect(["l_orderkey", "l_quantity"], where="l_orderkey < 1000")),
        "open_and_plan": lambda: open_parquet(spark, lineitem.path).plan(),
    }
    times = {}
    for name, run in runs.items():
        run()
        run()  # two warm-ups, as the published figures have
        took = []
        for _ in range(REPEATS):
            began = time.perf_counter()
            run()
            took.append(time.perf_counter() - began)
        times[name] = round(statistics.median(took), 4)
    print(json.dumps({"metric": "total_median_seconds", "value": round(sum(times.values()), 4), "unit": "sec", "queries": times, "sf": SF_DIR.rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
