"""Writers: tables, files, topics and databases."""
