"""SQL equivalents, where SQL can express a query of this subpackage."""
SQL: dict[str, str] = {}
