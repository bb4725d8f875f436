"""Structured Streaming entry points.

The original has no streaming operator; the one place where data *arrives*
is the upload of new files, re-expressed here as a file-source stream."""

from .uploads import (UPLOAD_SCHEMA, announce_upload, read_classified, start_announced_stream,
                      start_upload_stream)

__all__ = ["UPLOAD_SCHEMA", "announce_upload", "read_classified", "start_announced_stream", "start_upload_stream"]
