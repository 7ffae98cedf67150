"""Where ingest reads from. A source offers ``read(spec)`` and ``read_since(spec, mark)``."""

from tidemark.sources.frames import FrameSource
from tidemark.sources.jdbc import JdbcHexSplit, JdbcQuantileSplit, JdbcSource, JdbcSplit

__all__ = ["FrameSource", "JdbcHexSplit", "JdbcQuantileSplit", "JdbcSource", "JdbcSplit"]
