"""Batch readers, stream readers, the table store and the test-table mappings."""
