"""Readers and writers: documents, lexicons, reports and append-only logs."""
