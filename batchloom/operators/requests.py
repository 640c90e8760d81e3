"""Turn source rows and files into batch requests, and pack them into size-capped shards."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from batchloom.functions.ids import request_id
from batchloom.functions.media import URL_PART, is_supported, media_type
from batchloom.functions.text import as_text, is_blank
from batchloom.operators.grouping import keep_first
from batchloom.operators.incremental import split_null_keys, unprocessed_rows
from batchloom.storage import materialise_counted

# Limits of the batch service.
MAX_LINE_BYTES = 6 * 1024 * 1024
MAX_SHARD_BYTES = 100 * 1024 * 1024
MAX_SHARD_ROWS = 50_000

# Endpoint and model defaults per provider.
ENDPOINTS = {"dashscope": "/v1/chat/completions", "zhipuai": "/v4/chat/completions"}
TEXT_MODELS = {"dashscope": "qwen3.5-flash", "zhipuai": "glm-4-flash"}
MEDIA_MODELS = {"dashscope": "qwen-vl-plus", "zhipuai": "glm-4v-plus"}
INFERENCE_PARAMS = ("temperature", "max_tokens", "top_p", "enable_thinking")


@dataclass(frozen=True)
class RequestOptions:
    """What every request of a run has in common."""

    model: str
    system_prompt: str = "You are a helpful assistant."
    user_prompt: str = ""
    endpoint: str = "/v1/chat/completions"
    provider: str = "dashscope"
    params: dict[str, Any] = field(default_factory=dict)

    @classmethod
    def for_provider(cls, provider: str, files: bool = False, **overrides) -> RequestOptions:
        """Options with the provider's own endpoint and default model."""
        model = (MEDIA_MODELS if files else TEXT_MODELS).get(provider, "")
        chosen = {"model": model, "endpoint": ENDPOINTS.get(provider, cls.endpoint), **overrides}
        return cls(provider=provider, **chosen)

    def set_params(self) -> dict[str, Any]:
        """Inference parameters that are set."""
        return {k: v for k, v in self.params.items() if v is not None}


def render_prompt(text: Column, template: str) -> Column:
    """The template with every {text} replaced; the text itself where there is no template."""
    return F.replace(F.lit(template), F.lit("{text}"), text) if template else text


def _compact(value: Any) -> str:
    return json.dumps(value, ensure_ascii=False, separators=(",", ":"))


def request_line(custom_id: Column, user_message: Column, options: RequestOptions, system: bool) -> Column:
    """One compact JSON request.

    Only id and user message vary by row. All else is the same text for the whole run and is
    rendered once, which fixes field order and number format. Encoded ids need no JSON escapes.
    """
    messages = f'"messages":['
    if system:
        messages += _compact({"role": "system", "content": options.system_prompt}) + ","
    before = f',"method":"POST","url":{_compact(options.endpoint)},"body":{{"model":{_compact(options.model)},'
    params = "".join(f",{_compact(k)}:{_compact(v)}" for k, v in options.set_params().items())
    return F.concat(
        F.lit('{"custom_id":"'),
        custom_id,
        F.lit('"' + before + messages),
        F.to_json(user_message),
        F.lit("]" + params + "}}"),
    )


def drop_blank_text(df: DataFrame, text_col: str) -> DataFrame:
    return df.where(~is_blank(F.col(text_col).cast("string")))


def drop_oversized(df: DataFrame, line_col: str = "request", max_bytes: int = MAX_LINE_BYTES) -> DataFrame:
    """Drop requests longer than the cap, in bytes of UTF-8."""
    return df.where(F.octet_length(F.col(line_col)) <= max_bytes)


def dedupe_requests(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first copy of each request.

    Groups by the key columns rather than the id they map to one-to-one: an anti-join on the same
    keys that follows uses the same partitioning, and the text is shuffled once. It comes before
    that join, since the copies of a frequent key are then cut down before the shuffle.
    """
    return keep_first(df, keys, order)


def first_copies(rows: DataFrame, keys: Sequence[str], text_col: str, order: Sequence[str] = ()) -> DataFrame:
    """Rows that can become requests: full keys only, then no blank text, then first copies.

    Without an ``order`` the text with the least digest wins; of equal digests, the lesser text.
    """
    return dedupe_requests(_usable(rows, keys, text_col), keys, order or [_rank(text_col, ()), F.col(text_col)])


def _rank(text_col: str, order: Sequence[str]) -> Column:
    """What the first copy of a key has the least of: the order columns, or else a digest of the text."""
    return F.struct(*order) if order else F.xxhash64(F.col(text_col).cast("string"))


def _usable(rows: DataFrame, keys: Sequence[str], text_col: str) -> DataFrame:
    return drop_blank_text(split_null_keys(rows, keys)[0], text_col)


def key_groups(rows: DataFrame, target: DataFrame | None, keys: Sequence[str], text_col: str, order: Sequence[str] = ()) -> DataFrame:
    """Keys that the target lacks: (keys, _rows, _blank, _best), one row per key, without any text.

    ``_rows`` and ``_blank`` count the key's rows and those with blank text; ``_best`` is the rank of its first usable
    copy, NULL where there is none. Keys with a NULL in them are groups too, with no usable copy. Copies are
    aggregated before they are shuffled, and the anti-join that follows uses the same partitioning.
    """
    complete = ~F.greatest(*[F.col(k).isNull() for k in keys], F.lit(False))
    blank = is_blank(F.col(text_col).cast("string"))
    narrow = rows.select(*keys, blank.alias("_is_blank"), F.when(complete & ~blank, _rank(text_col, order)).alias("_rank"))
    counts = (F.count("*").alias("_rows"), F.count_if("_is_blank").alias("_blank"), F.min("_rank").alias("_best"))
    return unprocessed_rows(narrow.groupBy(*keys).agg(*counts), target, keys)


def store_key_groups(groups: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, dict[str, int]]:
    """``key_groups`` stored, with the rows they stand for by outcome: selected, null_key, blank_text, duplicate; and usable keys."""
    complete = ~F.greatest(*[F.col(k).isNull() for k in keys], F.lit(False))
    usable = F.col("_best").isNotNull()
    return materialise_counted(
        groups,
        "fresh-keys",
        selected=F.sum("_rows"),
        null_key=F.sum(F.when(~complete, F.col("_rows"))),
        blank_text=F.sum(F.when(complete, F.col("_blank"))),
        duplicate=F.sum(F.when(complete & usable, F.col("_rows") - F.col("_blank") - 1)),
        usable=F.count_if(usable),
    )


def copies_of(groups: DataFrame, rows: DataFrame, keys: Sequence[str], text_col: str, order: Sequence[str] = ()) -> DataFrame:
    """The first copy of each usable key of ``groups``, with all columns of ``rows``.

    A copy is a key's first if its rank isn't above the key's least. That is no equality, so rows stay partitioned
    by key, and copies of equal rank are told apart by their text without another shuffle.
    """
    usable = _usable(rows, keys, text_col)
    chosen = groups.where("_best IS NOT NULL").select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_best")
    same = reduce(lambda a, b: a & b, [usable[k] == chosen[f"_k{i}"] for i, k in enumerate(keys)])
    first = usable.join(chosen, same & (_rank(text_col, order) <= chosen["_best"]), "left_semi")
    return keep_first(first, keys, [*order, text_col])


def fresh_copies(
    rows: DataFrame, target: DataFrame | None, keys: Sequence[str], text_col: str, order: Sequence[str] = ()
) -> DataFrame:
    """First copies of keys that the target lacks.

    Copies are chosen and processed keys removed on keys and ranks alone; text is fetched for the keys that are left,
    so a run over a source that is mostly done moves little of it. Without an ``order`` the text with the least
    digest wins.
    """
    groups, _ = store_key_groups(key_groups(rows, target, keys, text_col, order), keys)
    return copies_of(groups, rows, keys, text_col, order)


def render_requests(
    rows: DataFrame,
    keys: Sequence[str],
    text_col: str,
    options: RequestOptions,
    max_bytes: int = MAX_LINE_BYTES,
) -> DataFrame:
    """Rows with unique keys as (keys, source_text, custom_id, request), oversized ones dropped."""
    stamped = rows.select(*keys, as_text(F.col(text_col)).alias("source_text"), request_id(keys).alias("custom_id"))
    return drop_oversized(with_request(stamped, options), max_bytes=max_bytes)


def judge_requests(
    rows: DataFrame, keys: Sequence[str], text_col: str, options: RequestOptions, max_bytes: int = MAX_LINE_BYTES
) -> DataFrame:
    """Rows with unique keys as (keys, source_text, custom_id, fits). A row that can't be sent keeps its key only."""
    stamped = rows.select(*keys, as_text(F.col(text_col)).alias("source_text"), request_id(keys).alias("custom_id"))
    judged = with_request(stamped, options).withColumn("fits", F.octet_length("request") <= max_bytes)
    held = [F.when(F.col("fits"), F.col(c)).alias(c) for c in ("source_text", "custom_id")]
    return judged.select(*keys, *held, "fits")


def with_request(stamped: DataFrame, options: RequestOptions) -> DataFrame:
    """Add the request to rows of (custom_id, source_text); it follows from those two alone."""
    content = render_prompt(F.col("source_text"), options.user_prompt)
    message = F.struct(F.lit("user").alias("role"), content.alias("content"))
    return stamped.withColumn("request", request_line(F.col("custom_id"), message, options, system=True))


def build_requests(
    rows: DataFrame,
    keys: Sequence[str],
    text_col: str,
    options: RequestOptions,
    order: Sequence[str] = (),
    max_bytes: int = MAX_LINE_BYTES,
) -> DataFrame:
    """One request per key as (keys, source_text, custom_id, request).

    ``order`` decides which copy of a key wins. The size check comes last: an oversized first copy
    still blocks a smaller later one.
    """
    return render_requests(first_copies(rows, keys, text_col, order), keys, text_col, options, max_bytes)


def skip_accounting(
    rows: DataFrame,
    keys: Sequence[str],
    text_col: str,
    options: RequestOptions,
    order: Sequence[str] = (),
    max_bytes: int = MAX_LINE_BYTES,
) -> DataFrame:
    """Rows per outcome of build_requests: null_key, blank_text, duplicate, oversized, ready."""
    complete = ~F.greatest(*[F.col(k).isNull() for k in keys], F.lit(False))
    blank = is_blank(F.col(text_col).cast("string"))
    read = rows.agg(
        F.count_if(~complete).alias("null_key"),
        F.count_if(complete & blank).alias("blank_text"),
        F.count_if(complete & ~blank).alias("duplicate"),
    )
    first = render_requests(first_copies(rows, keys, text_col, order), keys, text_col, options, 2**31 - 1)
    fits = F.octet_length("request") <= max_bytes
    kept = first.agg(
        (-F.count("*")).alias("duplicate"), F.count_if(~fits).alias("oversized"), F.count_if(fits).alias("ready")
    )
    both = read.unpivot([], read.columns, "outcome", "rows").unionByName(
        kept.unpivot([], kept.columns, "outcome", "rows")
    )
    return both.groupBy("outcome").agg(F.sum("rows").alias("rows"))


def build_media_requests(
    files: DataFrame, options: RequestOptions, max_bytes: int = MAX_LINE_BYTES, path_col: str = "relative_path"
) -> DataFrame:
    """One request per file that has a URL and a type the provider takes."""
    return judge_media_requests(files, options, max_bytes, path_col).where("outcome = 'ready'").drop("outcome")


def judge_media_requests(
    files: DataFrame, options: RequestOptions, max_bytes: int = MAX_LINE_BYTES, path_col: str = "relative_path"
) -> DataFrame:
    """Every file with its ``outcome``: ready, no_url, unsupported or oversized; a request where it is ready.

    The user message holds the media part, then the instruction text. The system message is left
    out where the prompt is empty.
    """
    kind = media_type(F.col(path_col))
    url = F.struct(F.col("presigned_url").alias("url"))
    media_part = F.struct(
        _part_type(kind).alias("type"),
        *[F.when(kind == k, url).alias(part) for k, part in URL_PART.items()],
        F.lit(None).cast("string").alias("text"),
    )
    no_media = F.lit(None).cast("struct<url:string>")
    text_part = F.struct(
        F.lit("text").alias("type"),
        *[no_media.alias(part) for part in URL_PART.values()],
        F.lit(options.user_prompt).alias("text"),
    )
    # to_json leaves NULL fields out, which yields each part's own shape.
    message = F.struct(F.lit("user").alias("role"), F.array(media_part, text_part).alias("content"))
    request = request_line(F.col("custom_id"), message, options, system=bool(options.system_prompt))
    no_url = F.coalesce(F.col("presigned_url"), F.lit("")) == ""
    outcome = F.when(no_url, "no_url").when(~is_supported(kind, options.provider), "unsupported")
    outcome = outcome.when(F.octet_length("request") > max_bytes, "oversized").otherwise("ready")
    built = files.withColumn("custom_id", request_id([path_col])).withColumn("request", request)
    judged = built.withColumn("outcome", outcome)
    ready = F.col("outcome") == "ready"
    return judged.withColumns({c: F.when(ready, F.col(c)) for c in ("custom_id", "request")})


def _part_type(kind: Column) -> Column:
    name = F.lit(None).cast("string")
    for k, part in URL_PART.items():
        name = F.when(kind == k, F.lit(part)).otherwise(name)
    return name


def bucket_count(requests: DataFrame, max_bytes: int, line_col: str = "request") -> int:
    """How many hash buckets keep a bucket near eight full shards."""
    total = requests.agg(F.sum(F.octet_length(line_col) + 1)).first()[0] or 0
    return max(1, -(-total // (8 * max_bytes)))


def shard_requests(
    requests: DataFrame,
    max_rows: int = MAX_SHARD_ROWS,
    max_bytes: int = MAX_SHARD_BYTES,
    buckets: int | None = None,
    id_col: str = "custom_id",
    line_col: str = "request",
    max_line_bytes: int = MAX_LINE_BYTES,
) -> DataFrame:
    """Add a ``shard`` such that no shard exceeds either cap, line ends included.

    Ids are unique, so hash buckets are even; within a bucket a running sum of bytes cuts the
    shards. A shard opens on a multiple of (cap - longest line), so its last line still fits.
    Bucket count follows the measured total size: a bucket is one task's work at any scale.
    ``requests`` is read twice for that and should be a stored table.
    """
    if max_bytes <= max_line_bytes + 1:
        raise ValueError("a shard must hold at least one line of the largest size")
    n = buckets or bucket_count(requests, max_bytes, line_col)
    digest = F.substr(F.md5(F.col(id_col).cast("binary")), F.lit(1), F.lit(8))
    bucket = F.conv(digest, 16, 10).cast("bigint") % F.lit(n)
    order = Window.partitionBy("bucket").orderBy(id_col)
    line_bytes = F.octet_length(line_col) + 1
    before = F.coalesce(F.sum(line_bytes).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    by_bytes = F.floor(before / F.lit(max_bytes - max_line_bytes - 1))
    by_rows = F.floor((F.row_number().over(order) - 1) / F.lit(max_rows))
    return requests.withColumn("bucket", bucket).withColumn(
        "shard", F.format_string("%d-%d-%d", F.col("bucket"), by_bytes, by_rows)
    )


def write_requests(sharded: DataFrame, path: str, line_col: str = "request", mode: str = "errorifexists") -> None:
    """One JSON-lines file per shard, UTF-8.

    All shards of a bucket sit in one partition already, so each shard is written by one task
    without another shuffle. An empty set of requests is an error, as there is nothing to send.
    """
    seen = Observation()
    lines = sharded.select("shard", F.col(line_col).alias("value")).observe(seen, F.count(F.lit(1)).alias("lines"))
    lines.write.mode(mode).partitionBy("shard").text(path)
    if not seen.get["lines"]:
        raise ValueError("no valid requests: every row was skipped")
