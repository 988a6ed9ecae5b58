"""Market-data analytics on Spark: feeds, order books, tiers and monitoring as DataFrame jobs."""

__version__ = "0.1.0"
