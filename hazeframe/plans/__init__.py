"""End-to-end jobs over a folder of tables."""
