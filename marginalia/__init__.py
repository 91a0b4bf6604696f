"""marginalia: rule labelling and label quality checks as Spark DataFrame jobs."""

__version__ = "1.0.0"
