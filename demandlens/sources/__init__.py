"""Sources and sinks: driver tables, posting-shaped fixtures, files, JDBC."""
