"""Reading exports and tables, writing tables, and working storage."""
