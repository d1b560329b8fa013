"""Catalog quality, feed import, order intake and sales analytics as Spark jobs."""
