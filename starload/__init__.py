"""Star-schema loading on Spark: clean, conform, key, resolve, assemble, check."""
