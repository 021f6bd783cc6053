from sparkmart.sinks.files import write_parquet, write_version

__all__ = ["write_parquet", "write_version"]
