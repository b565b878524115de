"""All registered queries."""

from stratus.workload import documents, layers, monitoring, quality, storage, streams  # noqa: F401  (register on import)
from stratus.workload.registry import ENTRIES

__all__ = ["ENTRIES"]
