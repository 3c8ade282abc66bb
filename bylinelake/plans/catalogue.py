"""All queries over the driver's tables."""

from . import checks, curation, facts, refresh, resolution  # noqa: F401
from .registry import QUERIES, SQL  # noqa: F401
