"""Compositions of operators: incremental runs and the behavioural analysis."""
