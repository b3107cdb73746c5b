"""Contracts, audits, metrics and event-log semantics over Spark DataFrames."""
