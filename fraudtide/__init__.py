"""Streaming fraud analytics on a lakehouse, written as Spark DataFrame operators."""
