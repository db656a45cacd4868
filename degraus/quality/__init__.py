"""Declarative quality rules, evaluated as Spark aggregates."""
