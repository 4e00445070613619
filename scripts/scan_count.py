"""Driver-table scans of registered queries over all jobs they start, eager ones included.

    python scripts/scan_count.py [sf_dir] name ...

Runs each query to the end with Spark's event log in a scratch folder and counts
the file scans below ``sf_dir`` in the plan of every SQL execution. Prints one
JSON object, name -> scans.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillflow.session import build_session  # noqa: E402


def main(args: list[str]) -> None:
    sf_dir = args.pop(0) if args and os.path.isdir(args[0]) else "/root/testdata/sf0.001"
    logs = tempfile.mkdtemp(prefix="tillflow-events-")
    spark = build_session("local[2]", shuffle_partitions=4, extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{logs}", "spark.eventLog.rolling.enabled": "false",
        "spark.eventLog.compress": "false", "spark.sql.maxMetadataStringLength": "500",
        # a large cluster's shape: no side is small enough to broadcast
        "spark.sql.autoBroadcastJoinThreshold": "-1"})
    from tillflow.plans import QUERIES
    marks = []
    for name in args:
        spark.sparkContext.setJobDescription(name)
        marks.append(name)
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.stop()
    counts = dict.fromkeys(marks, 0)
    where = f"[file:{os.path.abspath(sf_dir)}/"
    for f in os.listdir(logs):
        for line in open(os.path.join(logs, f)):
            event = json.loads(line)
            if event["Event"].endswith("SparkListenerSQLExecutionStart") and event.get("description") in counts:
                counts[event["description"]] += event["physicalPlanDescription"].count(where)
    print(json.dumps(counts))


if __name__ == "__main__":
    main(sys.argv[1:])
