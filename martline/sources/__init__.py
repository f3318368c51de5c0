"""Readers and writers: folder scans, sinks, and the test-data staging adapter."""
