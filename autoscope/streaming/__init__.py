"""Incremental variants of the batch jobs (Structured Streaming).

The original jobs are batch only; ``prepare_stream`` runs the same prepare
job (P1) over raw CSV files as they land, for inputs that arrive
continuously instead of as one 10 GB file.
"""
