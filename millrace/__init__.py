"""Layered retail and logistics warehouse jobs and stream analytics on Spark."""
