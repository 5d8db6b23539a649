"""Retail, data-quality and station-climate analytics written for Apache Spark."""
