from .files import (
    infer_schema_diff,
    land_bronze,
    load_audit,
    load_history,
    load_untyped_csv,
    read_json_payloads,
    read_untyped_csv,
    split_rejects,
)
from .payloads import flatten_payload, merge_pages, payload_shape
from .sinks import append_new, write_partitions, write_replace

__all__ = [
    "append_new",
    "flatten_payload",
    "infer_schema_diff",
    "land_bronze",
    "load_untyped_csv",
    "split_rejects",
    "load_audit",
    "load_history",
    "merge_pages",
    "payload_shape",
    "read_json_payloads",
    "read_untyped_csv",
    "write_partitions",
    "write_replace",
]
