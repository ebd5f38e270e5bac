"""Whole loads, from messages to tables."""
