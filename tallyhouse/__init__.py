"""Retail, trip and player analytics as plain PySpark DataFrame functions."""
