"""Readers and writers: landed readings, the lake, the raw table and the ledger."""
