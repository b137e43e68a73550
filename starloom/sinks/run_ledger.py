"""Which steps of a job have finished for which inputs.

A step is named after the versioned table it writes.  Its entry holds the
versions of the tables it read, its parameters and the version it made; a step
whose newest entry says the same of its inputs, and whose table still is at
that version, need not run again.  A job that failed half-way is started anew
and does what is missing.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.sinks.storage import is_missing
from starloom.sinks.versions import current_version, read_current

SCHEMA = "step string, inputs string, version long, finished_at long"


@dataclass
class RunLedger:
    """The ledger at ``path`` for the versioned tables under ``store``; ``ran``
    and ``skipped`` list the steps of this run."""
    spark: SparkSession
    path: str
    store: str
    ran: list[str] = field(default_factory=list)
    skipped: list[str] = field(default_factory=list)

    def entries(self, step: str) -> DataFrame:
        """The step's entries; steps may run side by side, so each has its own."""
        try:
            return self.spark.read.schema(SCHEMA).parquet(f"{self.path}/{step}")
        except AnalysisException as e:
            if is_missing(e):
                return self.spark.createDataFrame([], SCHEMA)
            raise

    def base(self, table: str) -> str:
        return f"{self.store.rstrip('/')}/{table}"

    def version(self, table: str) -> int:
        return current_version(self.spark, self.base(table))

    def finished(self, step: str, inputs: dict) -> bool:
        last = self.entries(step).agg(F.max_by(F.struct("inputs", "version"), "finished_at")).first()[0]
        return last is not None and last["inputs"] == _text(inputs) and last["version"] == self.version(step)

    def step(self, name: str, inputs: dict | None, write: Callable[[], object]) -> DataFrame:
        """The table ``name`` after ``write`` made its new version, or as it is
        if it was made from ``inputs`` before.  ``None`` for inputs whose
        versions are not known: the step always runs."""
        if inputs is not None and self.finished(name, inputs):
            self.skipped.append(name)
        else:
            write()
            self.ran.append(name)
            if inputs is not None:
                row = (name, _text(inputs), self.version(name), time.time_ns())
                self.spark.createDataFrame([row], SCHEMA).coalesce(1).write.mode("append").parquet(f"{self.path}/{name}")
        return read_current(self.spark, self.base(name))


def _text(inputs: dict) -> str:
    return json.dumps(inputs, sort_keys=True, default=str)
