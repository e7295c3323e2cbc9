"""Sources and sinks."""

from roomrate.sources.delimited import corrupt_rows, read_delimited, read_inferred, write_delimited
from roomrate.sources.staging import release_staged, stage, stage_table

__all__ = ["corrupt_rows", "read_delimited", "release_staged", "read_inferred", "write_delimited", "stage", "stage_table"]
