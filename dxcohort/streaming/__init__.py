"""Structured Streaming: incremental tagging and running year counts."""

from dxcohort.streaming.incremental import (
    admissions_stream,
    read_year_counts,
    start_tagging,
    start_year_counts,
    tag_stream,
)

__all__ = ["admissions_stream", "read_year_counts", "start_tagging", "start_year_counts", "tag_stream"]
