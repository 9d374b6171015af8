"""What a query does, over all of its jobs: scans of each table, exchanges and jobs, from Spark's event log."""

import json
import os
import tempfile
from collections import Counter
from contextlib import contextmanager

FOLDER = tempfile.mkdtemp(prefix="tidewater-events-")


def conf():
    return {"spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{FOLDER}", "spark.eventLog.compress": "false",
            "spark.eventLog.rolling.enabled": "false", "spark.eventLog.buffer.kb": "1k"}


class Account:
    def __init__(self):
        self.plans = {}
        self.jobs = 0

    def read(self, event):
        kind = event["Event"].rpartition(".")[2]
        if kind in ("SparkListenerSQLExecutionStart", "SparkListenerSQLAdaptiveExecutionUpdate"):
            self.plans[event["executionId"]] = event["sparkPlanInfo"]  # the last one is the plan as it ran
        elif kind == "SparkListenerJobStart":
            self.jobs += 1

    def nodes(self):
        todo = list(self.plans.values())
        while todo:
            node = todo.pop()
            todo.extend(node["children"])
            yield node

    def scans(self, folder):
        """How often each table of ``folder`` was read; reused exchanges have no scan below them."""
        found = Counter()
        for node in self.nodes():
            place = node["metadata"].get("Location", "") if node["nodeName"].startswith("Scan ") else ""
            if f"{folder}/" in place:
                found[place.split(f"{folder}/")[1].split(".parquet")[0]] += 1
        return found

    def count(self, *names):
        return sum(node["nodeName"] in names for node in self.nodes())


def _log():
    return max((os.path.join(FOLDER, f) for f in os.listdir(FOLDER)), key=os.path.getmtime)


def _settle(spark):
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)


@contextmanager
def account(spark):
    """Everything that Spark ran inside the block."""
    _settle(spark)
    start, found = os.path.getsize(_log()), Account()
    yield found
    _settle(spark)
    with open(_log(), "rb") as f:
        f.seek(start)
        for line in f:
            if line.startswith((b'{"Event":"org.apache.spark.sql', b'{"Event":"SparkListenerJobStart')):
                found.read(json.loads(line))
