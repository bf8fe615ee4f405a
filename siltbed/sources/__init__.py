"""Reading and writing layer tables."""
