"""Report queries by domain. Each takes a warehouse and returns a DataFrame."""
