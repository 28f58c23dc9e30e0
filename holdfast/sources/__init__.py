"""Cohort and web-event source preparation, table reads and writes."""
