"""Product master and channel summary: several sales channels on one layout."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from batchloom import schemas as S
from batchloom.functions.ranges import nonzero, normalise_ranges, within
from batchloom.functions.text import strip, to_integer, to_number
from batchloom.operators.grouping import sequence_in_group

# Level 1 and 2 categories of every product in the master.
LEVEL1 = "宠物用品"
LEVEL2 = "猫砂"

# Limits of believable range values.
PRICE_LIMIT = 5000
CONVERSION_LIMIT = 100


@dataclass(frozen=True)
class ChannelSpec:
    """How one channel's all-text sales table maps to the common metrics.

    ``exact`` columns hold a number, ``midpoint`` columns a range, ``rank`` a whole number. A
    metric in ``derived`` is computed: 'ratio' is a price from sales and volume, 'product' a sales
    amount from price and volume. ``title`` None means that the key is the title.
    """

    channel: str
    key: str
    title: str | None
    precision: str
    exact: Mapping[str, str] = field(default_factory=dict)
    midpoint: Mapping[str, str] = field(default_factory=dict)
    rank: str | None = None
    derived: Mapping[str, str] = field(default_factory=dict)
    bounded: bool = False


_RANGED = {
    S.SALES: "成交金额",
    S.VOLUME: "成交商品件数",
    S.PRICE: "成交客单价",
    S.TRAFFIC: "浏览量",
    S.CONVERSION: "成交转化率",
}

# Channels, their table columns and precision tags.
CHANNELS = [
    ChannelSpec("抖音", "商品", None, "精确值", {S.SALES: "销售额", S.VOLUME: "销量"}, derived={S.PRICE: "ratio"}),
    ChannelSpec(
        "天猫", "商品编码", "链接名称", "区间中位数估算",
        {S.PRICE: "件单价"}, {S.VOLUME: "支付单量"}, derived={S.SALES: "product"},
    ),
    ChannelSpec(
        "天猫超市", "商品ID", "商品名称", "指数值(非百分比)",
        {S.SALES: "成交热度", S.VOLUME: "成交人气", S.TRAFFIC: "访问热度"},
    ),
    ChannelSpec("京东自营", "商品编号", "商品名称", "区间中位数", {}, _RANGED, "排名", bounded=True),
    ChannelSpec("京东POP", "商品编号", "商品名称", "区间中位数", {}, _RANGED, "排名", bounded=True),
]


def union_channels(frames: Mapping[str, DataFrame], specs: Sequence[ChannelSpec] = CHANNELS) -> DataFrame:
    """Model results of all channels as (platform, source_key, ai_result)."""
    parts = [
        frames[s.channel].select(
            F.lit(s.channel).alias("platform"), F.col(s.key).cast("string").alias("source_key"), "ai_result"
        )
        for s in specs
        if s.channel in frames
    ]
    return reduce(DataFrame.unionByName, parts)


def source_names(sales: Mapping[str, DataFrame], specs: Sequence[ChannelSpec] = CHANNELS) -> DataFrame:
    """One title per (platform, source_key), for channels whose sales table has titles."""
    parts = [
        sales[s.channel].select(
            F.lit(s.channel).alias("platform"),
            F.col(s.key).cast("string").alias("source_key"),
            F.col(s.title).alias("source_name"),
        )
        for s in specs
        if s.title and s.channel in sales
    ]
    return reduce(DataFrame.unionByName, parts).groupBy("platform", "source_key").agg(
        F.min("source_name").alias("source_name")
    )


def dedupe_results(union: DataFrame) -> DataFrame:
    """The first model result of each (platform, source_key); a NULL result comes first."""
    null_first = F.when(F.count_if(F.col("ai_result").isNull()) == 0, F.min("ai_result"))
    return union.groupBy("platform", "source_key").agg(null_first.alias("ai_result"))


def attach_source_names(
    results: DataFrame, names: DataFrame, specs: Sequence[ChannelSpec] = CHANNELS
) -> DataFrame:
    """Add the original title. Both sides are grouped by the join keys, so nothing fans out."""
    key_is_title = [s.channel for s in specs if s.title is None]
    joined = results.join(names, ["platform", "source_key"], "left")
    own = F.when(F.col("platform").isin(key_is_title), F.col("source_key")).otherwise(F.col("source_name"))
    return joined.withColumn("source_name", own)


def parse_product_json(df: DataFrame, fields: Sequence[str] = S.PRODUCT_FIELDS, json_col: str = "ai_result") -> DataFrame:
    """Add the fields of a JSON object as text columns in one parse; NULL where it is no JSON."""
    shape = T.StructType([T.StructField(f, T.StringType()) for f in fields])
    parsed = df.withColumn("_parsed", F.from_json(F.col(json_col), shape))
    return parsed.select(*df.columns, *[F.col("_parsed").getField(f).alias(f) for f in fields])


def entity_code(brand: Column, cat_code: Column, seq: Column, spec: Column) -> Column:
    """Brand initials, category, sequence and grams as one code.

    The sequence is padded to four digits and never cut. A size that is no number counts as 0. Kilograms are read
    as a decimal, and fractions of a gram are cut off.
    """
    number = seq.cast("string")
    padded = F.lpad(number, F.greatest(F.lit(4), F.length(number)), F.lit("0"))
    kilograms = F.when(to_number(spec).isNotNull(), strip(spec).try_cast("decimal(28,10)"))  # a double of 1.001 is below it
    grams = F.coalesce((kilograms * F.lit(1000).cast("decimal(4,0)")).try_cast("int"), F.lit(0))
    return F.concat(
        F.coalesce(F.upper(F.substring(brand, 1, 2)), F.lit("XX")),
        F.lit("-PS-CL-"),
        F.coalesce(cat_code, F.lit("OL-OL")),
        F.lit("-"),
        padded,
        F.lit("-"),
        grams.cast("string"),
    )


def product_master(
    results: Mapping[str, DataFrame],
    sales: Mapping[str, DataFrame],
    specs: Sequence[ChannelSpec] = CHANNELS,
) -> DataFrame:
    """The de-duplicated product master of all channels.

    ``results`` and ``sales`` map channel names to tables. Results and titles are both reduced to
    one row per product before they meet, so a product copied many times costs no more than
    others, and the join uses the partitioning of the two aggregates.
    """
    unique = dedupe_results(union_channels(results, specs))
    named = attach_source_names(unique, source_names(sales, specs), specs)
    numbered = sequence_in_group(parse_product_json(named), [S.BRAND, S.CAT_CODE], ["platform", "source_key"])
    empty = F.lit("")
    return numbered.select(
        F.coalesce(S.BRAND, empty).alias(S.BRAND),
        F.lit(LEVEL1).alias(S.CAT1),
        F.lit(LEVEL2).alias(S.CAT2),
        F.coalesce(S.CAT3, empty).alias(S.CAT3),
        F.coalesce(S.CAT4, empty).alias(S.CAT4),
        F.coalesce(S.PRODUCT, empty).alias(S.PRODUCT),
        entity_code(F.col(S.BRAND), F.col(S.CAT_CODE), F.col("seq"), F.col(S.SPEC)).alias(S.CODE),
        F.coalesce(S.SPEC, empty).alias(S.SPEC),
        F.coalesce(S.FORMULA, empty).alias(S.FORMULA),
        F.col("platform").alias(S.PLATFORM),
        F.col("source_key").alias(S.SOURCE_KEY),
        F.col("source_name").alias(S.SOURCE_NAME),
        F.col(S.CAT_CODE),
        F.col("ai_result").alias(S.AI_RAW),
    )


def bound_metrics(df: DataFrame, price_limit: float = PRICE_LIMIT, conversion_limit: float = CONVERSION_LIMIT) -> DataFrame:
    """NULL for prices that are 0 or at the limit and beyond, conversions over the limit, rank 0."""
    return df.withColumns(
        {
            S.PRICE: nonzero(within(F.col(S.PRICE), below=price_limit)),
            S.CONVERSION: within(F.col(S.CONVERSION), at_most=conversion_limit),
            S.RANK: nonzero(F.col(S.RANK)),
        }
    )


def standardise_channel(sales: DataFrame, spec: ChannelSpec, keep: Sequence[str] = ()) -> DataFrame:
    """One channel's sales table as (channel, key, six metrics, precision), and its own columns in ``keep``."""
    metrics: dict[str, Column] = {m: F.lit(None).cast("double") for m in S.METRICS}
    metrics |= {m: to_number(F.col(c)) for m, c in spec.exact.items()}
    metrics |= {m: F.col(f"_{m}") for m in spec.midpoint}
    if spec.rank:
        metrics[S.RANK] = to_integer(F.col(spec.rank)).cast("double")
    ranged = normalise_ranges(sales, {f"_{m}": c for m, c in spec.midpoint.items()}) if spec.midpoint else sales
    typed = ranged.select(
        F.lit(spec.channel).alias(S.CHANNEL),
        F.col(spec.key).cast("string").alias(S.SOURCE_KEY),
        *[metrics[m].alias(m) for m in S.METRICS],
        F.lit(spec.precision).alias(S.PRECISION),
        *keep,
    )
    for metric, rule in spec.derived.items():
        typed = typed.withColumn(metric, _DERIVED[rule]())
    return bound_metrics(typed) if spec.bounded else typed


def _ratio() -> Column:
    return F.when(F.col(S.VOLUME) > 0, F.round(F.col(S.SALES) / F.col(S.VOLUME), 2))


def _product() -> Column:
    return nonzero(F.col(S.PRICE)) * nonzero(F.col(S.VOLUME))


_DERIVED = {"ratio": _ratio, "product": _product}


def channel_summary(
    master: DataFrame, sales: Mapping[str, DataFrame], specs: Sequence[ChannelSpec] = CHANNELS
) -> DataFrame:
    """Sales of all channels joined to the product master, on the 15-column layout.

    Channels are united before the join: the master is read and shuffled once, not per channel.
    A product sold in several rows of a channel keeps all of them.
    """
    rows = reduce(
        DataFrame.unionByName, [standardise_channel(sales[s.channel], s) for s in specs if s.channel in sales]
    )
    dims = [S.BRAND, S.CAT3, S.CAT4, S.CAT_CODE, S.PRODUCT, S.CODE, S.SPEC]
    known = master.select(F.col(S.PLATFORM).alias(S.CHANNEL), S.SOURCE_KEY, *dims)
    return rows.join(known, [S.CHANNEL, S.SOURCE_KEY]).select(*[f.name for f in S.SUMMARY.fields])


def taxonomy_violations(master: DataFrame, codes: DataFrame, code_col: str = S.CAT_CODE) -> DataFrame:
    """Master rows whose category code is not in the closed list; a missing code is one."""
    known = codes.select(code_col).distinct()
    return master.join(known, code_col, "left_anti")
