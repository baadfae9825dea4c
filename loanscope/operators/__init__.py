"""Relational operators: cubes, reports, slice filters, rollups, rankings and lookups."""
