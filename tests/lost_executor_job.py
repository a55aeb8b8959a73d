"""Run by test_fault_tolerance.py in its own process: two executors, of which
one dies in the middle of the salted shuffle join, taking its shuffle output
along; then the same validation undisturbed.  Prints digests of both."""

import json
import os
import signal
import sys
import tempfile
from pathlib import Path

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF, BASE = sys.argv[1], tempfile.mkdtemp(prefix="rowsieve-lost-", dir="/tmp")


def spark_home() -> str:
    """Executors write their logs below Spark's home: one of links in /tmp."""
    import pyspark

    home = Path(BASE, "home")
    (home / "work").mkdir(parents=True)
    for entry in Path(pyspark.__file__).parent.iterdir():
        if entry.name != "work":
            (home / entry.name).symlink_to(entry)
    return str(home)


os.environ |= {"SPARK_HOME": spark_home(), "SPARK_SCALA_VERSION": "2.13", "SPARK_LOCAL_IP": "127.0.0.1", "PYSPARK_PYTHON": sys.executable}

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from rowsieve import validate  # noqa: E402
from rowsieve.catalog.queries import table  # noqa: E402
from rowsieve.plans import JoinPolicy  # noqa: E402

RULES = [
    {"name": "u", "type": "unique_check", "column": "hot", "priority": 1},
    {"name": "fk", "type": "referential_integrity", "column": "hot", "reference_table": "c", "reference_column": "c_custkey", "priority": 2},
]
POLICY = JoinPolicy(broadcast_max_rows=50, heavy_key_rows=100)


def mortal(flag: str):
    def same(x):
        ctx = TaskContext.get()
        if ctx is not None and ctx.partitionId() == 6 and os.path.exists(flag):
            os.remove(flag)
            executor = int(Path(f"/proc/{os.getppid()}/stat").read_text().rsplit(")", 1)[1].split()[1])  # of this worker's daemon
            os.kill(executor, signal.SIGKILL)
        return x

    return F.udf(same, "long")  # test-only fault injection


def main():
    spark = (
        SparkSession.builder.master("local-cluster[2,1,1024]")
        .config("spark.executor.memory", "700m")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"file://{BASE}/shared")
        .getOrCreate()
    )
    out = {}
    for label in ("lost", "clean"):
        flag = f"{BASE}/{label}"
        # behind a shuffle, so a task that runs again may see its rows in another order
        events = table(spark, SF, "events").repartition(8, "value")
        hot = F.when(F.col("event_id") % 3 == 0, F.lit(-1)).otherwise(F.col("event_id") % 2000)
        events = events.withColumn("hot", F.when(F.col("event_id") % 7 != 1, hot)).withColumn("event_id", mortal(flag)("event_id"))
        result = validate(events, RULES, refs={"c": table(spark, SF, "customer")}, policy=POLICY)
        paths = sorted(v["path"] for v in result.join_plan().values())
        if label == "lost":
            Path(flag).touch()
        rows = result.flagged.select(F.xxhash64("event_id", "hot", "value", F.array_join("failed_rules", ",")).cast("decimal(38,0)").alias("h"))
        total = rows.agg(F.count("*").alias("n"), F.sum("h").alias("h"), F.count_distinct("h").alias("d")).first()
        out[label] = {"paths": paths, "n": total["n"], "sum": str(total["h"]), "distinct": total["d"]}
        out[f"{label}_killed"] = label == "lost" and not os.path.exists(flag)
    print("RESULT " + json.dumps(out))
    sys.stdout.flush()
    os._exit(0)


if __name__ == "__main__":
    main()
