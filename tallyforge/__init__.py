"""Prepare, profile and classify tabular data with Spark DataFrames."""

from tallyforge.spec import SKY_OBJECTS, TableSpec

__all__ = ["SKY_OBJECTS", "TableSpec"]
