"""Medallion analytics on Spark: raw documents -> bronze -> silver -> gold -> reports."""
