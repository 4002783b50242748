"""The weekly run from raw tables to the merged table."""
