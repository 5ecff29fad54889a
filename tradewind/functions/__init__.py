"""Column-level helpers: exact rounding, text rules, calendar maths, vocabularies."""
