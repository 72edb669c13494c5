"""File events, as batches and as streams."""
