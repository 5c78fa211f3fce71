"""Inputs and outputs: CSV/parquet readers, benchmark-table mapping, sinks."""
