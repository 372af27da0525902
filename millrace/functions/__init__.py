"""Column-level functions for text, nested data and message payloads."""
