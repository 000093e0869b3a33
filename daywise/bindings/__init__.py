"""The library's operators bound to the given tables, with a SQL twin for each."""
