"""Media types by file extension, and what each provider accepts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Extensions per media type.
EXTENSIONS = {
    "image": [".jpg", ".jpeg", ".png", ".gif", ".bmp", ".webp", ".tiff", ".tif"],
    "video": [".mp4", ".avi", ".mov", ".mkv", ".webm"],
    "audio": [".mp3", ".wav", ".flac", ".ogg", ".m4a"],
}

# Media types per provider.
PROVIDER_MEDIA = {
    "dashscope": ["image", "video", "audio"],
    "zhipuai": ["image", "video"],
}

# Content part that carries the URL of each media type.
URL_PART = {"image": "image_url", "video": "video_url", "audio": "input_audio"}


def extension(path: Column) -> Column:
    """Lower-case text from the last dot on; NULL where the path has no dot."""
    suffix = F.concat(F.lit("."), F.lower(F.substring_index(path, ".", -1)))
    return F.when(F.contains(path, F.lit(".")), suffix)


def media_type(path: Column) -> Column:
    ext = extension(path)
    kind = F.lit("unknown")
    for name, extensions in EXTENSIONS.items():
        kind = F.when(ext.isin(extensions), F.lit(name)).otherwise(kind)
    return kind


def is_supported(kind: Column, provider: str) -> Column:
    return kind.isin(PROVIDER_MEDIA.get(provider, []))
