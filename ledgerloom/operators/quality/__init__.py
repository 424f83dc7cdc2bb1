"""Data-quality checks over the relational core, its source ledger and the marts.

A check is a small DataFrame of (check_name, item, expected, actual, status, reason).  Only
aggregates appear in it, never row values.
"""
