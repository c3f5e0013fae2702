"""Compositions of operators: parameters, end-to-end plans and the query registry."""
