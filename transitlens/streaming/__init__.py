"""Structured Streaming forms of the questions.

The transformations are the batch operators where Spark allows them on a
stream (filters, per-key aggregates); windows use event time with a
watermark; the per-vehicle last-N buffer is keyed state, or a state merged per
micro-batch.  Runners write to a
fresh folder under ``spark.checkpoint.dir`` and keep their checkpoint there,
so a restarted query resumes where it stopped and a replayed micro-batch
overwrites its own output (idempotent by ``batch_id``).
"""

from .queries import (
    north_stream,
    report_stream_from_events,
    report_stream_from_text,
    sliding_average_stream,
    sliding_average_processing_time,
)
from .merges import (
    gap_text_writer,
    last_n_buffer_writer,
    last_n_per_vehicle_writer,
    last_stop_changes_writer,
    late_rows_writer,
    latest_writer,
    previous_snapshot,
    read_batches,
    recent_changes_writer,
    settled_writer,
    top_changes_writer,
)
from .runner import keyed_state, run_append, run_foreach, run_snapshots
from .state import last_n_per_vehicle_listed, last_n_per_vehicle_stream

__all__ = [
    "report_stream_from_events",
    "report_stream_from_text",
    "north_stream",
    "sliding_average_stream",
    "sliding_average_processing_time",
    "last_n_per_vehicle_stream",
    "last_n_per_vehicle_listed",
    "keyed_state",
    "run_append",
    "run_foreach",
    "last_n_buffer_writer",
    "last_n_per_vehicle_writer",
    "last_stop_changes_writer",
    "late_rows_writer",
    "top_changes_writer",
    "latest_writer",
    "recent_changes_writer",
    "gap_text_writer",
    "settled_writer",
    "read_batches",
    "previous_snapshot",
    "run_snapshots",
]
