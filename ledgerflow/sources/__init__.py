"""Inputs (CSV/Parquet readers, the star-schema adapter) and period-replacing sinks."""
