"""Frame-to-frame operators, with column names as parameters."""
