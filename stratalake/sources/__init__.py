"""Readers and writers: landed documents, the layered tables, durable staging."""
