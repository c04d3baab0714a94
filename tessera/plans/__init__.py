"""Strategies, driver-table bindings, the query registry and its SQL oracle."""
