"""Joins, aggregates, windows, numbering, checks and case history as DataFrame functions."""
