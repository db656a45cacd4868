"""Readers and writers: CSV, warehouse, layer tables, broker topics, alert log."""
