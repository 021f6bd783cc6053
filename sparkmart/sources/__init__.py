from sparkmart.sources.files import read_csv_strings, read_parquet, read_table
from sparkmart.sources.tables import load

__all__ = ["read_csv_strings", "read_parquet", "read_table", "load"]
