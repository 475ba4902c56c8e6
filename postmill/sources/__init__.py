"""Reading and writing: listing pages, JSON lines, tables."""
