"""Column expressions: nothing here reads a table or starts a job."""
