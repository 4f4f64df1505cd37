"""The state of an iterative training on shared storage, from which a cut-off fit goes on."""

from __future__ import annotations

import json
from dataclasses import dataclass
from uuid import uuid4

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

# Numbers in one row of a stored array.
_BLOCK = 1 << 16
_LOG = "step long, arrays string, settings string"


@dataclass(frozen=True)
class Stored:
    step: int
    arrays: dict[str, np.ndarray]


class TrainingState:
    """Named arrays by step. A state is written first and entered in the log last, so that a half-written
    one is never read; the log names the arrays of each step.
    """

    def __init__(self, spark: SparkSession, path: str, interval: int, settings: dict):
        self.spark, self.path, self.interval = spark, path.rstrip("/"), interval
        self.settings = json.dumps(settings, sort_keys=True, default=str)

    def save(self, step: int, **arrays: np.ndarray) -> None:
        """Store the arrays if the step is due."""
        if step % self.interval:
            return
        target = f"{self.path}/state-{uuid4().hex}"
        rows = [
            (name, start, values[start : start + _BLOCK].tolist()) for name, values in arrays.items() for start in range(0, max(len(values), 1), _BLOCK)
        ]
        self.spark.createDataFrame(rows, "name string, start long, part array<double>").write.parquet(target)
        log = self.spark.createDataFrame([(step, target, self.settings)], _LOG)
        log.coalesce(1).write.mode("append").parquet(f"{self.path}/log")

    def load(self) -> Stored | None:
        """The last state, or None if there is none; one of a training with other settings is refused."""
        try:
            log = self.spark.read.schema(_LOG).parquet(f"{self.path}/log")
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise
        last = log.orderBy(F.desc("step")).first()
        if last is None:
            return None
        if last["settings"] != self.settings:
            raise ValueError(f"{self.path} holds the state of a training with other settings: {last['settings']}, now {self.settings}")
        parts: dict[str, list[float]] = {}
        for row in self.spark.read.parquet(last["arrays"]).orderBy("name", "start").toLocalIterator():
            parts.setdefault(row["name"], []).extend(row["part"])
        return Stored(last["step"], {name: np.array(values, dtype=float) for name, values in parts.items()})
