"""speechframe: building and analysing corpora of annotated speech samples on Spark."""

__version__ = "0.1.0"
