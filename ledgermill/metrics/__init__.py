from ledgermill.metrics.query import MetricStore

__all__ = ["MetricStore"]
