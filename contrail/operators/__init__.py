"""Relational operators of the pipeline: flatten, latest, hourly, serving, run log."""
