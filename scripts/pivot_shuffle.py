"""Shuffle bytes of the long -> wide pivot in two forms, from Spark's event log.

* conditional aggregation (the library's ``to_station_days``): one exchange on (id, date);
* ``groupBy(id, date).pivot(element, values).agg(first(value))``: the planner's pivot.

Each form runs in its own local session whose event log goes to a fresh temporary
folder; the script sums "Shuffle Bytes Written" over all tasks.

    python scripts/pivot_shuffle.py [sf_dir]
"""

import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from wxstar.operators.observations import prepare_observations, split_by_quality, to_station_days  # noqa: E402
from wxstar.schemas import CORE_ELEMENTS  # noqa: E402
from wxstar.sources import tables  # noqa: E402


def _session(log_dir):
    s = (
        SparkSession.builder.master("local[8]").appName("pivot-shuffle")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", log_dir)
        .config("spark.eventLog.compress", "false")
        .config("spark.sql.shuffle.partitions", "16").getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    return s


def _shuffle_bytes(log_dir):
    total, stages = 0, set()
    for path in glob.glob(f"{log_dir}/**/*", recursive=True):
        if os.path.isdir(path):
            continue
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                if ev.get("Event") == "SparkListenerTaskEnd":
                    w = ev.get("Task Metrics", {}).get("Shuffle Write Metrics", {})
                    b = w.get("Shuffle Bytes Written", 0)
                    if b:
                        total += b
                        stages.add(ev.get("Stage ID"))
    return total, len(stages)


def run(form, sf_dir):
    log_dir = tempfile.mkdtemp(prefix=f"evlog-{form}-")
    spark = _session(log_dir)
    clean, _ = split_by_quality(prepare_observations(tables.long_observations(spark, sf_dir)))
    if form == "conditional":
        wide = to_station_days(clean, "src_order")
    else:
        wide = clean.groupBy("id", "date").pivot("element", CORE_ELEMENTS).agg(F.first("data_value"))
    wide.write.format("noop").mode("overwrite").save()
    spark.stop()
    return _shuffle_bytes(log_dir)


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    out = {}
    for form in ("conditional", "pivot"):
        b, n = run(form, sf)
        out[form] = {"shuffle_bytes": b, "shuffle_map_stages": n}
    print(json.dumps({"sf_dir": sf, **out}))
