"""Readers (S1-S4, S9, S10), fixture views over the driver tables, and sinks."""
