"""Composed jobs: the staged warehouse, the query catalog and the oracle texts."""
