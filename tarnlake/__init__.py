"""Governed three-tier lakehouse jobs written as plain PySpark DataFrame code."""
