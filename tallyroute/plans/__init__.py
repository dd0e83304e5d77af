"""Whole reports and batches.  ``crm`` maps table names to DataFrames; see README for columns."""
