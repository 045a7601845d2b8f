"""Reading and writing recordings, stage tables, text files and settings."""
