"""Readers, decoders and sinks."""

from burstwatch.sources import sinks
from burstwatch.sources.decode import decode_edits, decode_json, has_keys, require_keys
from burstwatch.sources.files import (
    decode_history, decode_ngrams, decode_toc, read_edit_lake, read_feature_lake,
    read_history, read_ngrams, read_toc,
)
from burstwatch.sources.topics import edit_stream, read_topic, stream_options, text_stream

__all__ = [
    "decode_edits", "decode_history", "decode_json", "decode_ngrams", "decode_toc",
    "edit_stream", "has_keys", "read_edit_lake", "read_feature_lake", "read_history", "read_ngrams",
    "read_toc", "read_topic", "require_keys", "sinks", "stream_options", "text_stream",
]
