"""Reading and writing: CSV, Parquet, JSON-stat cubes, HTML pages."""
