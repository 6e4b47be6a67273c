"""inkstrata: an evidence-first content index and analytics engine on PySpark."""

__version__ = "0.1.0"
