"""Run summaries as Spark observations.

A summary is gathered while the job runs (``DataFrame.observe``): the
counters ride along with the data, no extra pass and no collect of rows.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def observe_counts(df: DataFrame, name: str, **conditions) -> tuple[DataFrame, Observation]:
    """Attach an observation counting all rows plus one count per named condition.

    Returns the observed DataFrame (use it downstream) and the Observation,
    whose ``.get`` is available after the first action on it.
    """
    obs = Observation(name)
    metrics = [F.count(F.lit(1)).alias("rows")]
    metrics += [F.count_if(cond).alias(k) for k, cond in conditions.items()]
    return df.observe(obs, *metrics), obs


class RunSummary:
    """Counts of a job's stages, taken while the stages are computed for the job's own outputs."""

    def __init__(self) -> None:
        self._seen: dict[str, Observation] = {}

    def count(self, name: str, df: DataFrame) -> DataFrame:
        """``df``, whose rows are counted as ``name`` by the first action on what is returned."""
        self._seen[name] = Observation(name)
        return df.observe(self._seen[name], F.count(F.lit(1)).alias("rows"))

    def counts(self) -> dict[str, int]:
        """All counts; waits for stages that haven't run."""
        return {name: obs.get["rows"] for name, obs in self._seen.items()}
