"""The operators applied to the given tables, with the SQL that states each expected result."""
