"""Run by test_fault_tolerance.py in its own process: a session whose tasks
may be retried (local[4, 2]) and an input whose first attempt of one task
fails, then the same validation without failures; prints both results."""

import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from rowsieve import validate  # noqa: E402
from rowsieve.catalog.queries import DOCUMENT_RULES, table  # noqa: E402
from rowsieve.session import configure  # noqa: E402

SF = sys.argv[1]


def flaky_value(x):
    ctx = TaskContext.get()
    if ctx is not None and ctx.partitionId() == 1 and ctx.attemptNumber() == 0:
        raise RuntimeError("injected task failure")
    return x


def main():
    spark = (
        SparkSession.builder.master("local[4,2]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("WARN")  # keeps the failed attempts visible
    configure(spark)
    flaky = F.udf(flaky_value, "long")  # test-only fault injection
    out = {}
    for label, failing in (("with_failure", True), ("clean", False)):
        docs = table(spark, SF, "documents").repartition(4, "doc_id")
        if failing:
            docs = docs.withColumn("doc_id", flaky("doc_id"))
        r = validate(docs, DOCUMENT_RULES, refs={"labels": table(spark, SF, "labels")})
        path, stats = r.write_split(tempfile.mkdtemp(prefix=f"fault-{label}-", dir="/tmp") + "/out"), r.quality_stats()
        back = spark.read.parquet(path)
        out[label] = {
            "stats": stats,
            "rows": back.count(),
            "rejected": back.where("dq_status = 'rejected'").count(),
        }
    print("RESULT " + json.dumps(out))


if __name__ == "__main__":
    main()
