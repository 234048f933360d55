"""Readers and writers: nested JSON slices, Parquet artefacts, models, test view."""
