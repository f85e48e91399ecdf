"""Readers and writers: snapshot folders, the table store, reports."""
