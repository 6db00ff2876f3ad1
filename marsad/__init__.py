"""marsad: curation, screening, scoring and exploration of conversation data on Spark."""

__version__ = "0.1.0"
