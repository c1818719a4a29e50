"""salesloom: multi-channel retail sales warehouse jobs on Spark DataFrames."""

__version__ = "0.1.0"
