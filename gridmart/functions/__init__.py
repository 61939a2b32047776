"""Column functions: parsing, keys, calendar fields and display text."""
