"""Software-delivery analytics on PySpark.

Webhook deliveries are validated, enriched and kept in one event table; every
other result is a DataFrame operator over that table. See ``README.md``.
"""

from devmetrics.session import configure

__all__ = ["configure"]
