"""All registered queries."""

from kontor.workload import joining, labelling, reporting, storing, texts, webpages  # noqa: F401
from kontor.workload.bindings import REGISTRY

__all__ = ["REGISTRY"]
