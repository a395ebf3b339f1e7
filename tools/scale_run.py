"""Scale check of the full run: lineitem of one scale factor replicated N
times (copies via explode of a sequence, keys kept unique), written as a CSV
drop, then land → validate → route → enrich → validate → deliver.

    python tools/scale_run.py /root/testdata/sf0.1 10

Prints one JSON line with the row count, total seconds and per-step seconds.
Writes under a fresh scratch folder in spark.checkpoint.dir.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from dropgate.plans import lineitem_run as L  # noqa: E402
from dropgate.session import get_spark, scratch_path  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 10
    spark = get_spark("local[8]", 8, extra={"spark.driver.memory": "16g"})
    root = scratch_path(spark, "scale_run")
    li = spark.read.parquet(f"{sf}/lineitem.parquet").select(*L.LINEITEM_COLS)
    big = (li.withColumn("__c", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
           .withColumn("l_orderkey", F.col("l_orderkey") + F.col("__c").cast("long") * F.lit(10 ** 9))
           .drop("__c"))
    for flag in ("A", "N", "R"):
        (big.filter(F.col("l_returnflag") == flag).repartition(16).write.option("header", "true")
         .option("sep", ";").csv(f"{root}/drop/lineitem_sales_{flag}"))
    warm = "/root/testdata/sf0.001"
    if os.path.isdir(warm):
        L.run(spark, warm, L.write_drop(spark, warm), run_id="warm")
    t0 = time.perf_counter()
    pb = L.run(spark, sf, f"{root}/drop", out_root=f"{root}/out", run_id="scale")
    total = round(time.perf_counter() - t0, 1)
    delivered = spark.read.parquet(pb.staging("4_dispatcher") + "/*").count()
    print(json.dumps({"rows_in": li.count() * copies, "rows_delivered": delivered, "sec": total,
                      "steps": pb.timings}))
    spark.stop()


if __name__ == "__main__":
    main()
