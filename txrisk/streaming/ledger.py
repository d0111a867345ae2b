"""Rule counts of streams, kept as a table."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

LEDGER_DDL = "rule string, passed bigint, failed bigint"


class RuleLedger(StreamingQueryListener):
    """Writes what :func:`~txrisk.operators.rules.watch_rules` counts, batch by batch.

    Add it to ``spark.streams`` before the streams that it is to watch; those with an
    observation called ``watch`` are noted, one folder for each query and batch id, with
    a row per rule. A batch that runs again after a restart replaces its folder, so no
    batch counts twice. The counts arrive with the batch's progress, after it is
    committed: of a driver that dies in between, that one batch is missing.
    """

    def __init__(self, spark: SparkSession, root: str, watch: str = "quality"):
        self._spark, self._root, self._watch = spark, root, watch
        self._ended: set[str] = set()
        self._change = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        seen = progress.observedMetrics.get(self._watch)
        if seen is None or not seen["rows"]:
            return
        counts = seen.asDict()
        rows = counts.pop("rows")
        lines = [(rule, rows - failed, failed) for rule, failed in counts.items()]
        folder = f"{self._root}/query_id={progress.id}/batch_id={progress.batchId}"
        noted = self._spark.createDataFrame(lines, LEDGER_DDL).coalesce(1)
        noted.write.mode("overwrite").parquet(folder)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._change:
            self._ended.add(str(event.runId))
            self._change.notify_all()

    def settle(self, query: StreamingQuery, timeout: float = 60) -> None:
        """Wait until all that an ended query reported is written."""
        with self._change:
            run = str(query.runId)
            if not self._change.wait_for(lambda: run in self._ended, timeout):
                raise TimeoutError(f"no end of run {run} was reported in {timeout} seconds")


def read_ledger(spark: SparkSession, root: str) -> DataFrame:
    """``query_id, batch_id, rule, passed, failed`` of every batch with rows."""
    schema = f"{LEDGER_DDL}, query_id string, batch_id bigint"
    return spark.read.schema(schema).parquet(root)


def rule_totals(spark: SparkSession, root: str) -> DataFrame:
    """``rule, passed, failed`` over all batches noted."""
    sums = [F.sum(c).alias(c) for c in ("passed", "failed")]
    return read_ledger(spark, root).groupBy("rule").agg(*sums)
