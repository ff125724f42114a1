"""Realtime lakehouse jobs on Spark: change feeds and events in, layered KPI tables out."""
