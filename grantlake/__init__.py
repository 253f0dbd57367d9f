"""A PySpark-native engine for filings and grants: sources, canonical tables, text search, record linkage, grant analytics."""
