"""SQL for DuckDB that computes the registered queries by other routes than the Spark plans."""

from oracle import decisions, profiles, tables, trees

ORACLE: dict[str, str] = {**tables.SQL, **profiles.SQL, **decisions.SQL, **trees.SQL}
