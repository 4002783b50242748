"""Column-level building blocks: plain expressions, no Python UDFs."""
