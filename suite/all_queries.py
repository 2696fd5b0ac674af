"""Imports every query module, which registers its queries."""

from suite import aggregates, composites, incremental, joins, rows, scalars, sources_sinks, texts  # noqa: F401
