"""Named queries over the test tables, each with the SQL that must agree with it."""

from itemflow.catalog import (  # noqa: F401
    inputs,
    keys,
    omits,
    outputs,
    row_filters,
    rules,
    runs,
    scores,
)
from itemflow.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
