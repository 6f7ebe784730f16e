from .batch import FullLoad
from .incremental import IncrementalLoad

__all__ = ["FullLoad", "IncrementalLoad"]
