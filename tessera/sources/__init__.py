"""Reading channel tables, and writing channel and profile tables."""
