"""Social-comment analytics and copy experiments as Spark DataFrame operators."""

from audience_engine.settings import Settings

__all__ = ["Settings"]
