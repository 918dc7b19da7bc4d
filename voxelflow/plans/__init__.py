"""Compositions of operators (the reference's tools) and the query catalog."""
