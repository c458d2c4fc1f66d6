"""Whole flows: landed responses to accepted records, records to tables."""
