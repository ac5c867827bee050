"""The library's queries over the driver's tables."""

from broadsheet.plans import (  # noqa: F401
    interface_queries,
    inventory_queries,
    more_queries,
    news_queries,
    source_queries,
    text_queries,
    write_queries,
)
from broadsheet.plans.registry import ORACLES, QUERIES  # noqa: F401
