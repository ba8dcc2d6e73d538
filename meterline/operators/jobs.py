"""Jobs that keep state between runs: the store of published vintages, and the explainer.

Both write through ``sources.sinks``, replace whole vintages, and can be run again after a failure at any point: a run
that is repeated leaves the same tables behind.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import sinks
from ..sources.shared import stored
from .explain import pending_vintages
from .publishing import ensemble_average
from .vintages import freeze_actuals, new_vintages

#: Schema of the ledger: what each run did to which vintage.
LEDGER = "vintage date, run_id string, step string"


class VintageStore:
    """Published forecasts, frozen actuals and a ledger of runs, in folders below ``folder``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def path(self, table: str) -> str:
        return f"{self.folder}/{table}"

    def read(self, table: str) -> DataFrame | None:
        """A table of the store; None before it has any rows."""
        return sinks.read_if_there(self.spark, self.path(table))

    def _note(self, vintages: Iterable[dt.date], run_id: str, step: str) -> None:
        sinks.append(self.spark.createDataFrame([(v, run_id, step) for v in vintages], LEDGER), self.path("ledger"))

    def publish(self, models: DataFrame, expected: Iterable[str], run_id: str, run_at: dt.datetime) -> list[dt.date]:
        """Publish the ensemble of the delivered models for their vintages; returns the vintages.

        The gate: every vintage needs rows of every expected model, else nothing is written. Frozen copies of a vintage that was
        published before are dropped first, so that it is frozen anew; then its forecasts are replaced. The ledger gets a row before
        and one after, so a vintage that was started and not finished shows.
        """
        wanted = sorted(set(expected))
        delivered = models.groupBy("vintage").agg(F.array_sort(F.collect_set("model")).alias("models")).collect()  # a row per vintage
        late = {str(r["vintage"]): sorted(set(wanted) - set(r["models"])) for r in delivered if set(wanted) - set(r["models"])}
        if late or not delivered:
            raise ValueError(f"models not delivered: {late or wanted}")
        vintages = sorted(r["vintage"] for r in delivered)
        fresh = ensemble_average(models.where(F.col("model").isin(wanted))).select(
            "*", F.lit(run_at).cast("timestamp").alias("score_run_at"), F.lit(True).alias("is_active"))
        self._note(vintages, run_id, "started")
        sinks.drop_vintages(self.spark, self.path("frozen"), vintages)
        sinks.write_vintages(fresh, self.path("forecast"), cluster_by=("ts_key",))
        self._note(vintages, run_id, "published")
        return vintages

    def freeze(self, snapshots: DataFrame, run_id: str) -> list[dt.date]:
        """Freeze the actuals of every active run that has no frozen copy; returns the vintages."""
        published = self.read("forecast")
        if published is None:
            return []
        pending = stored(new_vintages(published, self.read("frozen")))
        vintages = sorted(r["vintage"] for r in pending.select("vintage").distinct().collect())  # a row per vintage
        if vintages:
            sinks.append(freeze_actuals(snapshots, pending), self.path("frozen"), "vintage")
            self._note(vintages, run_id, "frozen")
        return vintages

    def unfinished(self) -> list[dt.date]:
        """Vintages whose newest entry for a run is its start: a job broke off."""
        ledger = self.read("ledger")
        if ledger is None:
            return []
        runs = ledger.groupBy("vintage", "run_id").agg(F.collect_set("step").alias("steps"))
        open_runs = runs.where(~F.array_contains("steps", "published") & F.array_contains("steps", "started"))
        done = ledger.where("step = 'published'").select("vintage").distinct()
        return sorted(r["vintage"] for r in open_runs.select("vintage").distinct().join(done, "vintage", "left_anti").collect())


def explain_pending(features: DataFrame, labels: DataFrame, folder: str,
                    explain: Callable[[DataFrame, DataFrame, list[dt.date]], DataFrame]) -> list[dt.date]:
    """Explain the vintages without a stored result and add them to the store at ``folder``, by vintage; returns them.

    A vintage is written as a whole, so one whose run broke off is explained again by the next run.
    """
    spark = features.sparkSession
    done = sinks.read_if_there(spark, folder)
    known = features.select("train_date").distinct()
    pending = known if done is None else pending_vintages(features, done)
    vintages = sorted(r["train_date"] for r in pending.collect())  # at most one per week
    if vintages:
        sinks.write_vintages(explain(features, labels, vintages), folder, vintage="train_date")
    return vintages
