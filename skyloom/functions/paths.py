"""Path columns: name, stem, suffix, parent, and derived output names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed extension sets: images in general, and with bitmaps where a stage takes them.
IMAGE_EXTS = (".jpg", ".jpeg", ".png", ".webp", ".tif", ".tiff")
IMAGE_EXTS_BMP = (*IMAGE_EXTS, ".bmp")
#: Fixed order in which a sibling's extension is looked for, after the image's own.
SIBLING_EXTS = (".jpg", ".jpeg", ".png", ".webp", ".tif", ".tiff", ".bmp")


def name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def parent(path: Column) -> Column:
    """Empty for a path without a folder."""
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def suffix(path: Column) -> Column:
    """From the last dot of the name; a name that begins with its only dot has none."""
    return F.regexp_extract(name(path), r"^.+(\.[^.]+)$", 1)


def stem(path: Column) -> Column:
    n = name(path)
    return F.substring(n, F.lit(1), F.length(n) - F.length(suffix(path)))


def is_image(path: Column, bmp: bool = False) -> Column:
    return F.lower(suffix(path)).isin(*(IMAGE_EXTS_BMP if bmp else IMAGE_EXTS))


def with_suffix(path: Column, new: str) -> Column:
    return F.concat(F.substring(path, F.lit(1), F.length(path) - F.length(suffix(path))), F.lit(new))


def sort_key(path: Column) -> Column:
    """Compares paths part by part, as file trees do: a/b before a-b/c."""
    return F.split(path, "/")
