"""Reading from and writing to files, tables and databases."""
