from vellum.sources.tables import table, TABLES
from vellum.sources.stage import list_stage, read_file_bytes

__all__ = ["table", "TABLES", "list_stage", "read_file_bytes"]
