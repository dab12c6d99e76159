"""The library's operators run over the driver tables, each with a SQL statement of the same result."""
