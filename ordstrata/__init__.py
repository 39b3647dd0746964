"""Layered order analytics on Spark: stage, raw, silver and gold tables as DataFrame functions."""
