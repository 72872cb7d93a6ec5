"""Feature preparation and similarity hashing as plain PySpark DataFrame code."""
