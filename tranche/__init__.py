"""Loan-portfolio analytics as Spark DataFrame and SQL jobs."""

__version__ = "0.1.0"
