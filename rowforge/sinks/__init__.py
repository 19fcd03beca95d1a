"""Writers: text, CSV, JSON, Parquet, catalog tables, JDBC."""
