"""End-to-end jobs, the review views over the given tables, and the query registry."""
