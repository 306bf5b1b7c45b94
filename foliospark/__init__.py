"""foliospark: documents in, training-ready records out, as Spark plans."""

__version__ = "0.1.0"
