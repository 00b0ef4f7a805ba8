"""Derived input views and the registered queries with their oracles."""
