from streamlab.streaming.backlog import drain_in_order, to_bytes
from streamlab.streaming.late import LateSplit
from streamlab.streaming.runtime import (
    ProgressLog, ProgressTable, progress_frame, run_stream, show_batch, start_batches, start_table,
)

__all__ = [
    "LateSplit",
    "ProgressLog",
    "ProgressTable",
    "drain_in_order",
    "progress_frame",
    "run_stream",
    "show_batch",
    "start_batches",
    "start_table",
    "to_bytes",
]
