"""File listings: discovery, filters, URLs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from batchloom.functions.media import extension, is_supported, media_type


def volume_location(kind: str, name: str, roots: dict[str, str]) -> str:
    """Folder of a volume. ``roots`` maps the kinds external, user and table to base folders."""
    if kind == "user":
        return roots["user"]
    if not name:
        raise ValueError(f"a {kind} volume needs a name")
    return f"{roots['table' if kind == 'table' else 'external'].rstrip('/')}/{name}"


def list_files(
    spark: SparkSession, root: str, prefixes: Sequence[str] = (), glob: str | None = None
) -> DataFrame:
    """Files below ``root`` as (relative_path, size), contents unread.

    Given more than a few ``prefixes``, Spark lists them in parallel tasks. The index is on the driver, and files
    without bytes are not in it. For trees larger than that see ``tree.list_tree``, or export the store's inventory as a
    table for ``from_inventory``.
    """
    base = root.rstrip("/")
    paths = [f"{base}/{p.strip('/')}" for p in prefixes] or [base]
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    marker = "/" + base.split("://")[-1].removeprefix("file:").strip("/") + "/"
    path = F.col("path")
    relative = F.substr(path, F.instr(path, marker) + F.lit(len(marker)))
    return from_inventory(reader.load(paths).select(relative.alias("relative_path"), F.col("length").alias("size")))


def extension_glob(extensions: Sequence[str]) -> str | None:
    """A file-name pattern for extensions in any case; no list, no pattern."""
    if not extensions:
        return None
    spelled = ["".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in e.lstrip(".")) for e in extensions]
    return "*.{" + ",".join(spelled) + "}"


def from_inventory(listing: DataFrame) -> DataFrame:
    """A listing table as (relative_path, size): empty paths go, an unknown size is 0."""
    return listing.where(F.col("relative_path") != "").select(
        "relative_path", F.coalesce(F.col("size").cast("bigint"), F.lit(0)).alias("size")
    )


def filter_extensions(files: DataFrame, extensions: Sequence[str], path_col: str = "relative_path") -> DataFrame:
    """Files with one of the extensions, in any case, with or without the dot; no list, no filter."""
    if not extensions:
        return files
    wanted = ["." + e.lstrip(".").lower() for e in extensions]
    return files.where(extension(F.col(path_col)).isin(wanted))


def filter_prefix(files: DataFrame, prefix: str, path_col: str = "relative_path") -> DataFrame:
    """Files whose path starts with ``prefix``, as plain case-sensitive text."""
    return files.where(F.col(path_col).startswith(prefix)) if prefix else files


def classify_media(files: DataFrame, path_col: str = "relative_path") -> DataFrame:
    return files.withColumn("media_type", media_type(F.col(path_col)))


def drop_unsupported_media(files: DataFrame, provider: str, path_col: str = "relative_path") -> DataFrame:
    return files.where(is_supported(media_type(F.col(path_col)), provider))


def attach_urls(files: DataFrame, urls: DataFrame) -> DataFrame:
    """Add the URL of each file; NULL where the URL table has none or an empty one.

    ``urls`` is (relative_path, url), one row per path.
    """
    usable = urls.where(F.col("url") != "").select("relative_path", F.col("url").alias("presigned_url"))
    return files.join(usable, "relative_path", "left")


def drop_unresolved_urls(files: DataFrame) -> DataFrame:
    return files.where(F.coalesce(F.col("presigned_url"), F.lit("")) != "")


def type_histogram(files: DataFrame, path_col: str = "relative_path") -> DataFrame:
    """Files and bytes per extension, most frequent first."""
    ext = F.coalesce(extension(F.col(path_col)), F.lit("(no ext)"))
    counts = files.groupBy(ext.alias("extension")).agg(F.count("*").alias("files"))
    return counts.orderBy(F.desc("files"), "extension")
