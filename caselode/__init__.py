"""Finding and reusing precedents in large text collections, on Spark."""
