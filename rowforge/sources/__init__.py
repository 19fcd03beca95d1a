"""Readers: text lines, CSV (typed or all-string), lookup lists, tables."""
