"""Compositions of operators: the silver bundle, the gold tables, the query registry."""
