"""Document-to-retrieval jobs on Spark: pages -> markdown -> sections -> chunks -> search."""
