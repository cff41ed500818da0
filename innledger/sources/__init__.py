"""Reading the landing files, and reading and writing layer tables."""
