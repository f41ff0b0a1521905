"""DataFrame -> DataFrame operators (column names as arguments)."""
