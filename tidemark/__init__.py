"""tidemark: a Spark-native warehouse for published statistical indicators."""

from tidemark.params import Params
from tidemark.workspace import Workspace

__all__ = ["Params", "Workspace"]
