"""Reading content, and reading and writing index tables and results."""
