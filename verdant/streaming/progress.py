"""Per-batch progress of streaming queries (rows in, watermark, late rows dropped)."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

log = logging.getLogger(__name__)


#: Name of the metrics observed on what a query writes: ``rows``, and ``rows_<table>`` where it writes several tables.
WRITTEN = "written"


def _summary(p) -> dict:
    ops = p.stateOperators or []
    written = (getattr(p, "observedMetrics", None) or {}).get(WRITTEN)
    return {
        "name": p.name,
        "batch_id": p.batchId,
        "input_rows": p.numInputRows,
        "watermark": (p.eventTime or {}).get("watermark"),
        # rows (after the partial aggregate) dropped as late, over all stateful operators
        "late_rows_dropped": sum(op.numRowsDroppedByWatermark for op in ops),
        "state_rows": sum(op.numRowsTotal for op in ops),
        # rows handed to the sink, counted while they are written (None for queries that observe nothing)
        "rows_written": written.asDict() if written is not None else None,
        "sources": len(getattr(p, "sources", None) or ()),
    }


def batch_summary(query: StreamingQuery) -> list[dict]:
    """Compact view of the query's recent progress reports."""
    return [_summary(p) for p in query.recentProgress]


class BatchReportListener(StreamingQueryListener):
    """Logs one line per finished micro-batch of every query and hands its summary to ``on_report``; keeps nothing."""

    def __init__(self, on_report: Callable[[dict], None] | None = None):
        self.on_report = on_report

    def onQueryStarted(self, event):
        log.info("query started id=%s name=%s", event.id, event.name)

    def onQueryProgress(self, event):
        s = _summary(event.progress)
        log.info("query=%s batch=%s rows=%s watermark=%s late=%s written=%s", s["name"], s["batch_id"], s["input_rows"],
                 s["watermark"], s["late_rows_dropped"], s["rows_written"])
        if self.on_report is not None:
            self.on_report(s)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        log.info("query terminated id=%s exception=%s", event.id, event.exception)
