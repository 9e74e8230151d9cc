"""DataFrame operators, grouped by what they do."""
