"""DataFrame operators: tables and column names in, a lazy table out."""
