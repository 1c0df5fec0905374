"""The registered queries and, beside each, the SQL that states its result."""
