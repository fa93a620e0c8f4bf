"""Reading inputs: Parquet tables, the access map file, and logical inputs made from tables."""
