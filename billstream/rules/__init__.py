"""Routine-activity rules as data."""
