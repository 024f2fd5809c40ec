"""Retail price analytics as plain Spark DataFrame jobs.

Layers, bottom up: ``functions`` (column expressions), ``sources`` (readers and
writers), ``operators`` (DataFrame in, DataFrame out), ``streaming`` (the same
operators behind Structured Streaming), ``plans`` (whole jobs, the registered
queries and their SQL oracles).
"""
