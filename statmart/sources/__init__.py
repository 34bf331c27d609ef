"""Reading raw files and tables, and writing results."""
