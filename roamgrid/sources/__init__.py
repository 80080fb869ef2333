"""Reading and writing: raw line files, Parquet tables, the catalog."""
