"""Readers and writers: JSON arrays, CSV, NDJSON, REST and event pages."""
