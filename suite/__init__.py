"""Correctness and benchmark queries: library operators on the given star-schema tables."""
