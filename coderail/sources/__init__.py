"""Readers and writers: entry tables, scheme documents, result runs."""
