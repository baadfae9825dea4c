"""Incremental ingest with Structured Streaming.

The published load is a full refresh; nothing in the analyses is a stream.
This package re-expresses the same load (S2-S5) for files that land over time:
new register files in a folder are appended to the fact table, and the
additive main cube is kept current from per-batch partial cubes.
"""

from loanscope.streaming.ingest import (  # noqa: F401
    read_cube_deltas, register_stream, start_cube_upkeep, start_fact_stream,
)
