from tidelog.sinks.keyed import KeyedTable
from tidelog.sinks.lake import Lake
from tidelog.sinks.tables import append_rows, bootstrap, create_if_absent, replace_table

__all__ = ["KeyedTable", "Lake", "append_rows", "bootstrap", "create_if_absent", "replace_table"]
