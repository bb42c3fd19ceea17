"""The registered queries; importing the modules fills the registry."""

from logweir.catalog import analyses, groups, links, logs, masks, scores, streams  # noqa: F401
from logweir.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
