"""Readers and writers."""

from .core import load_core
from .crashes import bind_by_position, crash_reports
from .nested import flatten_telemetry, parse_telemetry, telemetry_json
from .telemetry import skipped_files, telemetry, telemetry_v1
from .writers import append_scores, overwrite_atomically, read_scores, recover_swap, write_telemetry

__all__ = [
    "append_scores", "bind_by_position", "crash_reports", "flatten_telemetry", "load_core",
    "overwrite_atomically", "parse_telemetry", "read_scores", "recover_swap", "skipped_files",
    "telemetry", "telemetry_json", "telemetry_v1", "write_telemetry",
]
