"""In-flight ingest counts of a stream (S13), without another pass over its records.

``counted`` observes each micro-batch's input, accepted and rejected records
while they flow by; ``IngestTotals`` is a query listener that adds them up.
"""

from __future__ import annotations

import threading
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from marketlake.sources import landing

PREFIX = "ingest:"


def counted(records: DataFrame, domain: str, name: str) -> DataFrame:
    """``records`` of a domain, with the S12 outcome of each micro-batch observed on the way (``name``: its schema)."""
    reason = landing.reject_reason(records, name)
    return records.observe(f"{PREFIX}{domain}", F.count_if(reason.isNull()).alias("records"),
                           F.count_if(reason.isNotNull()).alias("errors"))


class IngestTotals(StreamingQueryListener):
    """Totals by domain over all batches of the queries it listens to. A batch that is run again counts once."""

    def __init__(self):
        self._lock = threading.Lock()
        self._seen: dict[tuple, dict[str, int]] = {}

    def onQueryStarted(self, event):  # noqa: N802 - the listener's names
        pass

    def onQueryProgress(self, event):  # noqa: N802
        progress = event.progress
        with self._lock:
            for name, row in (progress.observedMetrics or {}).items():
                if name.startswith(PREFIX):
                    self._seen[progress.id, progress.batchId, name.removeprefix(PREFIX)] = row.asDict()

    def onQueryIdle(self, event):  # noqa: N802
        pass

    def onQueryTerminated(self, event):  # noqa: N802
        pass

    def totals(self) -> dict[str, dict[str, int]]:
        """{domain: {records, errors}} so far."""
        out: dict[str, Counter] = {}
        with self._lock:
            for (_, _, domain), counts in self._seen.items():
                out.setdefault(domain, Counter()).update(counts)
        return {d: {"records": c["records"], "errors": c["errors"]} for d, c in out.items()}
