"""tidemark: user-behaviour window metrics on Spark.

Parse action and video-view messages, assign them to tumbling, sliding or
inclusive whole-second windows, reduce per user or per content item, build
profile rows and keep them in keyed tables, in batch and in Structured
Streaming. Every operator is a ``DataFrame -> DataFrame`` function built
from DataFrame / SQL primitives.
"""

from tidemark.config import ActionConfig, WindowSpec

__all__ = ["ActionConfig", "WindowSpec"]
