"""Reading exports and tables, writing tables and reports."""
