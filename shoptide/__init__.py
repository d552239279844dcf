"""shoptide: shop clickstream tables, reports and streams written for Spark."""

from shoptide.session import configure

__all__ = ["configure"]
