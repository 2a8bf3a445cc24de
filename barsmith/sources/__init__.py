"""Message parsing, layer tables and table adapters."""
