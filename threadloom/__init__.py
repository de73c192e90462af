"""threadloom: build, repair and audit corpora of news posts and their threads on Spark."""

__version__ = "0.1.0"
