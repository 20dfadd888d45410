"""Marketplace analytics on PySpark: cleaning, star schema, sales aggregates,
review topics, fair seller scoring, seller segments and governance views."""
