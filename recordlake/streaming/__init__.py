"""Incremental refresh as a file stream (trigger availableNow + foreachBatch)."""
