"""Chat-trace curation on Spark: traces in, judged and synthetic training rows out."""

from .config import ChatTemplate, CurationConfig

__all__ = ["ChatTemplate", "CurationConfig"]
