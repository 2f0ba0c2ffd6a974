"""Change-history analytics on Spark: change streams in, versioned cells out, history queries on top."""

__version__ = "0.1.0"
