"""Site operations analytics on PySpark: feeds, data products, metrics, governed views."""

from quarrylens.session import build_session
from quarrylens.sources.tables import Tables

__all__ = ["Tables", "build_session"]
