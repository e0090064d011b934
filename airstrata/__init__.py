"""Layered (bronze, silver, gold) measurement analytics on PySpark."""
