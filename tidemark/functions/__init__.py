"""Column builders."""

from tidemark.functions.casts import apply_schema, failed_cast, strict_cast
from tidemark.functions.hosts import url_host
from tidemark.functions.keyset import after_mark
from tidemark.functions.packing import FILL_VALUE, is_fill_collision, pack, scale_factor, unpack
from tidemark.functions.timetext import timestamp_text

__all__ = [
    "FILL_VALUE",
    "after_mark",
    "apply_schema",
    "failed_cast",
    "is_fill_collision",
    "pack",
    "scale_factor",
    "strict_cast",
    "timestamp_text",
    "unpack",
    "url_host",
]
