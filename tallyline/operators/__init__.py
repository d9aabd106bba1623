"""DataFrame to DataFrame operators, from raw lines to table rows."""
