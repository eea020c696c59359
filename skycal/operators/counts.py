"""Rows of each step of a run, counted by the jobs that run the steps."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class StepCounts:
    """Counts under the name of a step. A step that is made of several frames has the sum of theirs.

    Spark adds up what tasks report. Only tasks of a job's last stage report once for sure: those before a shuffle do again
    when a sort samples its input or a lost executor's work is redone. So watch a frame that is written without a
    shuffle in between, as the steps of a calibration are."""

    def __init__(self) -> None:
        self._seen: list[tuple[str, Observation]] = []

    def watch(self, df: DataFrame, step: str, rows: Column | None = None) -> DataFrame:
        """df, whose rows (or the sum of a column) are counted by the first job that runs it: no pass of their own."""
        observation = Observation(f"{step}-{uuid.uuid4().hex}")
        self._seen.append((step, observation))
        n = F.count(F.lit(1)) if rows is None else F.coalesce(F.sum(rows), F.lit(0))
        return df.observe(observation, n.cast("bigint").alias("n"))

    def rows(self) -> dict[str, int]:
        """The counts in the order of the steps. It waits for steps that no job has run yet."""
        out: dict[str, int] = {}
        for step, observation in self._seen:
            out[step] = out.get(step, 0) + _rows_of(observation)
        return out


def _rows_of(observation: Observation) -> int:
    """A frame that Spark finds empty while it runs drops out of the plan; its observation ends as a row without a field,
    which Python cannot take over."""
    try:
        return observation.get["n"]
    except Py4JJavaError as error:
        if "toPyRow" not in str(error):
            raise
        return 0


def watched(counts: StepCounts | None, df: DataFrame, step: str, rows: Column | None = None) -> DataFrame:
    return df if counts is None else counts.watch(df, step, rows)
