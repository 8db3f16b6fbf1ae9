"""Writers: day log, deltas, versioned snapshots, distance reference, CSV export."""

from sootledger.sinks.ledger import (
    Days,
    Layout,
    append_distances,
    export_csv,
    publish,
    write_days,
)
from sootledger.sinks.published import read_published, with_keys, write_parts

__all__ = [
    "Days", "Layout", "append_distances", "export_csv", "publish", "read_published", "with_keys",
    "write_days", "write_parts",
]
