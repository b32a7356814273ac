"""Reading landed files and tables, writing tables."""
