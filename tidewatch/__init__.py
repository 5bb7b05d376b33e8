"""Behaviour analytics on Spark DataFrames: windows, rankings, click caps,
event sequences, order tracking and payment reconciliation, in batch and on
Structured Streaming."""
