"""Text files named by messages, files with an inferred schema, topics."""
