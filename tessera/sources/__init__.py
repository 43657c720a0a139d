from tessera.sources.tables import TABLES, register_all, table

__all__ = ["TABLES", "register_all", "table"]
