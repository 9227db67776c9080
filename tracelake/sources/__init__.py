"""Readers of trace formats: raw lines or documents in, one turns table out."""
