"""Reading and writing topics, tables, files and databases."""
