from .claims import claim, claim_folder, claim_next
from .delimited import REJECTED, read_delimited_sensor, rejected_lines, sensor_schema
from .tables import (
    append_history,
    create_namespace,
    overwrite_table,
    read_history,
    read_table,
    shared_folder,
    write_bucketed,
)

__all__ = [
    "REJECTED",
    "rejected_lines",
    "claim",
    "claim_folder",
    "claim_next",
    "append_history",
    "create_namespace",
    "overwrite_table",
    "read_delimited_sensor",
    "read_history",
    "read_table",
    "sensor_schema",
    "shared_folder",
    "write_bucketed",
]
