"""Broadband-availability analytics as Spark DataFrame operators."""
