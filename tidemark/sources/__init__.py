"""Sources (raw readers, the test-data adapter) and sinks (layer writers)."""

from tidemark.sources.raw import load_bronze, read_raw, read_raw_tables
from tidemark.sources.sinks import Layout, Release, ReleaseConflict
from tidemark.sources.testdata import raw_tables

__all__ = ["load_bronze", "read_raw", "read_raw_tables", "Layout", "Release", "ReleaseConflict",
           "raw_tables"]
