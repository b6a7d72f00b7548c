"""Readers. Each has a path form and a form on lines already held as a ``value`` column.

Only header lines ever reach the driver; records are parsed by expressions.
"""
