"""Column expressions: parsing of lines and paths, and text formats."""
