"""Run statistics of streaming queries, batch by batch."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from dossierflow.functions import vocabulary as V

COUNTS = ("urls_found", "payloads_yielded", "payloads_failed", "missing_main_block")


def observed(tried: DataFrame, name: str = "run_stats", *, ok: str = "ok", parse_mode: str = "parse_mode") -> DataFrame:
    """The same rows, counted as they pass: one row per tried URL, with a flag of success and
    the parse mode. Nothing is shuffled or read again; :class:`RunStats` gets the counts."""
    failed = ~F.coalesce(F.col(ok), F.lit(False))
    counts = (F.count(F.lit(1)), F.count_if(~failed), F.count_if(failed), F.count_if(F.col(parse_mode) == V.MODE_WHOLE_PAGE))
    return tried.observe(name, *[c.alias(n) for c, n in zip(counts, COUNTS, strict=True)])


class RunStats(StreamingQueryListener):
    """Counts of an :func:`observed` stream by micro-batch: add it to ``spark.streams`` before
    the query starts. Batches without data are left out; a batch that is repeated replaces
    its counts."""

    def __init__(self, name: str = "run_stats") -> None:
        self.name = name
        self.batches: dict[tuple[str, int], tuple[int, ...]] = {}
        self._changed = threading.Condition()
        self._ended: set[str] = set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        row = p.observedMetrics.get(self.name)
        if row is not None and p.numInputRows:
            with self._changed:
                self.batches[str(p.id), p.batchId] = tuple(row[c] for c in COUNTS)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._changed:
            self._ended.add(str(event.id))
            self._changed.notify_all()

    def wait(self, query, timeout: float = 60.0) -> None:
        """Until the ended query's last event has come; listeners run behind the query."""
        with self._changed:
            if not self._changed.wait_for(lambda: str(query.id) in self._ended, timeout):
                raise TimeoutError("the query's last event did not come")

    def totals(self) -> dict[str, int]:
        return {c: sum(b[i] for b in self.batches.values()) for i, c in enumerate(COUNTS)}
