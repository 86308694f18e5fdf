"""Rows so far of each library, told while they are read, without another pass."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

METRIC = "rows_by_library"
#: Rows of a library between two reports.
EVERY = 500_000


def observed(rows: DataFrame, by: str, libraries: list[str], into: Observation | None = None) -> DataFrame:
    """``rows`` as they are, counted by library on the way.  ``libraries`` are those of the catalogue, so few;
    rows of others, and of none, count as ''.

    The counts of a batch query are in ``into`` once it has run; those of a stream go to :class:`Progress`.
    """
    known = [F.count_if(F.coalesce(F.col(by) == name, F.lit(False))).alias(name) for name in libraries]
    other = F.count_if(~F.coalesce(F.col(by).isin(libraries), F.lit(False))).alias("")
    return rows.observe(METRIC if into is None else into, *known, other)


class Progress(StreamingQueryListener):
    """Reports (library, rows so far) whenever a library has passed another ``every`` rows, and once more, with
    what it has, when the stream ends."""

    def __init__(self, report: Callable[[str, int], None], every: int = EVERY):
        self.report, self.every = report, every
        self.counts: dict[str, int] = {}
        self.told: dict[str, int] = {}

    def add(self, counts: dict[str, int]) -> None:
        for name, n in counts.items():
            before, now = self.counts.get(name, 0), self.counts.get(name, 0) + n
            self.counts[name] = now
            if now // self.every > before // self.every:
                self._tell(name, now)

    def end(self) -> None:
        for name, n in self.counts.items():
            if n and self.told.get(name) != n:
                self._tell(name, n)

    def _tell(self, name: str, n: int) -> None:
        self.told[name] = n
        self.report(name, n)

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        found = event.progress.observedMetrics.get(METRIC)
        if found is not None:
            self.add(found.asDict())

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self.end()
