"""Reports, the query registry and the SQL oracle."""
