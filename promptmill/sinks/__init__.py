"""Writers for chat lines, their sidecar, shards and reports."""

from promptmill.sinks.bundle import check_bundle, read_bundle, read_manifest, write_bundle
from promptmill.sinks.writers import (
    ROWS_PER_FILE,
    report_name,
    write_chat,
    write_report,
    write_shards,
    write_sidecar,
)

__all__ = [
    "ROWS_PER_FILE",
    "check_bundle",
    "read_bundle",
    "read_manifest",
    "report_name",
    "write_bundle",
    "write_chat",
    "write_report",
    "write_shards",
    "write_sidecar",
]
