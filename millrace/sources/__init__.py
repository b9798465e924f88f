from millrace.sources.tables import SCHEMAS, null_counts, read_table

__all__ = ["SCHEMAS", "null_counts", "read_table"]
