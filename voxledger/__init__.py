"""voxledger: Spark jobs for large collections of labelled recordings."""

__version__ = "0.1.0"
