"""Layered shop warehouse on Spark: raw logs and change records to detail, wide, statistics and report tables."""

__version__ = "0.1.0"
