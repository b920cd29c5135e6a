"""Readers of the two corpora and the table, report and model sinks."""
