"""Part quality analytics on Spark: Bronze -> Silver -> Gold, checks and reports."""

__version__ = "0.1.0"
