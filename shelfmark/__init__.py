"""Document indexing and search as Spark jobs over partitioned tables."""
