"""Composed plans: batch job, dashboard panels, table maintenance, the registered query catalog."""
