"""Readers and writers: JSON payloads, entity tables, request logs."""
