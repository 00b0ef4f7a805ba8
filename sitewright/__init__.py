"""Insertion-site and edit analytics as Spark DataFrame operators."""
