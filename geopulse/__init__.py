"""geopulse: anomaly analytics over event and environmental observations, as Spark operators."""

__version__ = "0.1.0"
