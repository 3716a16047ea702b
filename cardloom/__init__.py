"""Card-transaction feature engineering and scoring as Spark DataFrame operators."""

from .session import build_session, configure

__all__ = ["build_session", "configure"]
