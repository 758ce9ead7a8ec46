"""Readers and writers (S and K rows): explicit schemas, no inference pass."""
