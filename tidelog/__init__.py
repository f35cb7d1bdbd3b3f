"""Change-data-capture analytics on Spark DataFrames."""

from tidelog.config import REGISTRY, USERS, Field, Settings, TableSpec, spec_for

__all__ = ["REGISTRY", "USERS", "Field", "Settings", "TableSpec", "spec_for"]
__version__ = "0.1.0"
