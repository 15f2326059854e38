"""loomlog: event-log and case/vote-log analytics on Spark DataFrames."""

__version__ = "0.1.0"
