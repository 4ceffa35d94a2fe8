"""Annotated-text-graph analytics as Spark DataFrame operators."""
