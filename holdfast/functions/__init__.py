"""Column-level building blocks: keys, dates, business labels, robust scores."""
