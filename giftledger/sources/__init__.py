"""Readers and writers: delimited text, date-partitioned tables, scratch space, the test-data view."""
