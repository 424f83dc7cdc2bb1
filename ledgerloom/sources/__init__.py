"""Readers and writers for ledgers, core tables and feature files."""
