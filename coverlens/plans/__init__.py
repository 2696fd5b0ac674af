"""Composed queries: star-schema views, export, dashboard, staged runs."""
