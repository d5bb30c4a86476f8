"""DataFrame operators for tabular analytics, time series, statistics, retrieval and question tables on Spark."""

__version__ = "0.1.0"
