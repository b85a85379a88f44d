"""End-to-end jobs and the queries on the driver tables."""
