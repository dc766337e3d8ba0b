"""The executed plans of all SQL executions of a session, read from its own event log.

A frame's own plan leaves out what ran before it: sorts that a checkpoint
ends, the writes of versioned tables, micro-batches.  The event log has them
all, with the plan that adaptive execution ended with.
"""

from __future__ import annotations

import glob
import json
import os
import tempfile

START = "org.apache.spark.sql.execution.ui.SparkListenerSQLExecutionStart"
UPDATE = "org.apache.spark.sql.execution.ui.SparkListenerSQLAdaptiveExecutionUpdate"


def log_conf() -> dict[str, str]:
    """Settings of a session whose plans are to be read (local scratch folder)."""
    return {"spark.eventLog.enabled": "true", "spark.eventLog.dir": "file://" + tempfile.mkdtemp(prefix="tarmac-plans-"),
            "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false",
            "spark.sql.ui.explainMode": "simple", "spark.sql.maxMetadataStringLength": "2000",
            "spark.sql.maxPlanStringLength": "2000000"}


class PlanLog:
    def __init__(self, spark) -> None:
        self.sc = spark.sparkContext
        folder = spark.conf.get("spark.eventLog.dir").removeprefix("file://")
        (self.path,) = [p for p in glob.glob(os.path.join(folder, self.sc.applicationId + "*")) if os.path.isfile(p)]
        self.at = 0

    def new_plans(self) -> list[str]:
        """Final plans of the executions that were started since the last call, in order."""
        self.sc._jsc.sc().listenerBus().waitUntilEmpty(60_000)
        plans: dict[int, str] = {}
        with open(self.path, errors="replace") as f:
            f.seek(self.at)
            for line in f:
                if '"physicalPlanDescription"' in line:
                    e = json.loads(line)
                    if e["Event"] == START or e["Event"] == UPDATE and e["executionId"] in plans:
                        plans[e["executionId"]] = e["physicalPlanDescription"]
            self.at = f.tell()
        return [final(p) for _, p in sorted(plans.items())]


def final(plan: str) -> str:
    """The part of an adaptive plan that ran."""
    return plan.partition("== Initial Plan ==")[0]
