"""Retail-marketing lakehouse on PySpark: raw, clean, dimensional and mart layers."""
