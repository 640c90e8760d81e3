"""Business analyses over the channel summary.

Sums are rounded to cents: the order in which tasks add doubles then does not show.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchloom import schemas as S
from batchloom.functions.text import has_value
from batchloom.sources.tables import inline_values

# Defaults of the reports.
MAIN_CHANNEL = "京东自营"
SECOND_CHANNEL = "京东POP"
EXACT_CHANNEL = "抖音"
OWN_BRAND = "福丸"
PEER_BRANDS = ["福丸", "pidan", "网易严选", "许翠花", "凯锐思", "洁客", "CATLINK", "小佩"]
PRICE_BANDS = [50, 100, 200, 300]


def total(col: str | Column) -> Column:
    return F.round(F.sum(col), 2)


def band(col: Column, edges: Sequence[int]) -> Column:
    """Text label of the half-open band a value falls in; the last band is open."""
    label = F.lit(f"{edges[-1]}+")
    lows = [0, *edges[:-1]]
    for low, high in reversed(list(zip(lows, edges))):
        label = F.when(col < high, f"{low}-{high}").otherwise(label)
    return label


def brand_share(summary: DataFrame, channel: str = MAIN_CHANNEL, n: int = 15) -> DataFrame:
    """Leading brands of one channel: products, sales, mean rank and conversion."""
    rows = summary.where((F.col(S.CHANNEL) == channel) & has_value(F.col(S.BRAND)) & (F.col(S.SALES) > 0))
    shares = rows.groupBy(S.BRAND).agg(
        F.count("*").alias("sku_count"),
        total(S.SALES).alias("total_sales"),
        F.round(F.avg(S.RANK), 1).alias("avg_rank"),
        F.round(F.avg(S.CONVERSION), 1).alias("avg_conv"),
    )
    return shares.orderBy(F.desc("total_sales"), S.BRAND).limit(n)


def category_structure(
    summary: DataFrame, main: str = MAIN_CHANNEL, other: str = EXACT_CHANNEL, n: int = 10
) -> DataFrame:
    """Leading categories with the sales of two channels side by side."""

    def sales_in(channel: str) -> Column:
        return total(F.when(F.col(S.CHANNEL) == channel, F.col(S.SALES)).otherwise(0.0))

    keys = [S.CAT3, S.CAT4, S.CAT_CODE]
    rows = summary.where(has_value(F.col(S.BRAND))).groupBy(*keys)
    sums = rows.agg(F.count("*").alias("sku_count"), sales_in(main).alias("jd_sales"), sales_in(other).alias("dy_sales"))
    return sums.orderBy(F.desc("jd_sales"), *keys).limit(n)


def brand_vs_peers(summary: DataFrame, brands: Sequence[str] = PEER_BRANDS, channel: str = MAIN_CHANNEL) -> DataFrame:
    """Named brands in one channel; a brand that is not there has found = false.

    The aggregate is filtered to the named brands before it is joined back to the list.
    """
    rows = summary.where((F.col(S.CHANNEL) == channel) & F.col(S.BRAND).isin(list(brands)))
    stats = rows.groupBy(S.BRAND).agg(
        F.count("*").alias("skus"),
        total(S.SALES).alias("sales"),
        F.round(F.avg(S.RANK), 1).alias("rank"),
        F.round(F.avg(S.PRICE), 0).alias("price"),
        F.round(F.avg(S.CONVERSION), 1).alias("conv"),
    )
    named = inline_values(summary.sparkSession, S.BRAND, brands)
    return named.join(stats, S.BRAND, "left").withColumn("found", F.col("skus").isNotNull())


def brand_cross_channel(summary: DataFrame, brand: str = OWN_BRAND) -> DataFrame:
    """One brand in every channel it sells in."""
    rows = summary.where(F.col(S.BRAND) == brand).groupBy(S.CHANNEL)
    stats = rows.agg(
        F.count("*").alias("skus"),
        total(S.SALES).alias("sales"),
        F.round(F.avg(S.VOLUME), 0).alias("avg_vol"),
        F.round(F.avg(S.PRICE), 0).alias("avg_price"),
    )
    return stats.orderBy(F.desc("sales"), S.CHANNEL)


def price_bands(summary: DataFrame, channel: str = MAIN_CHANNEL, edges: Sequence[int] = PRICE_BANDS) -> DataFrame:
    """Products, sales and conversion per price band, cheapest band first."""
    rows = summary.where((F.col(S.CHANNEL) == channel) & (F.col(S.PRICE) > 0))
    stats = rows.groupBy(band(F.col(S.PRICE), edges).alias("price_band")).agg(
        F.count("*").alias("sku_count"),
        total(S.SALES).alias("total_sales"),
        F.round(F.avg(S.CONVERSION), 1).alias("avg_conv"),
        F.min(S.PRICE).alias("min_price"),
    )
    return stats.orderBy("min_price")


def top_sellers(summary: DataFrame, channel: str = EXACT_CHANNEL, above: float = 100000, n: int = 10) -> DataFrame:
    rows = summary.where((F.col(S.CHANNEL) == channel) & (F.col(S.SALES) > above))
    return rows.orderBy(F.desc(S.SALES), S.CODE, S.PRODUCT).limit(n).select(S.BRAND, S.PRODUCT, S.SALES, S.VOLUME)


def high_conversion(
    summary: DataFrame,
    channels: Sequence[str] = (MAIN_CHANNEL, SECOND_CHANNEL),
    above: float = 15,
    n: int = 10,
) -> DataFrame:
    rows = summary.where((F.col(S.CONVERSION) > above) & F.col(S.CHANNEL).isin(list(channels)))
    first = rows.orderBy(F.desc(S.CONVERSION), S.CHANNEL, S.CODE, S.RANK).limit(n)
    return first.select(S.BRAND, S.PRODUCT, S.CHANNEL, S.CONVERSION, S.RANK, S.SALES)


def top_brand_channels(summary: DataFrame, n: int = 10) -> DataFrame:
    """The leading brands over all channels, each channel by channel.

    Brand and channel are grouped once; brand totals come from that aggregate, not from the rows.
    """
    rows = summary.where(has_value(F.col(S.BRAND)) & F.col(S.SALES).isNotNull())
    cells = rows.groupBy(S.BRAND, S.CHANNEL).agg(
        F.sum(S.SALES).alias("_sum"), F.count("*").alias("skus"), F.round(F.avg(S.PRICE), 0).alias("avg_price")
    )
    leaders = cells.groupBy(S.BRAND).agg(total("_sum").alias("_total"))
    leaders = leaders.orderBy(F.desc("_total"), S.BRAND).limit(n).select(S.BRAND)
    kept = cells.join(leaders, S.BRAND, "left_semi")
    return kept.select(S.BRAND, S.CHANNEL, F.round("_sum", 2).alias("sales"), "skus", "avg_price")


def channel_counts(summary: DataFrame) -> DataFrame:
    return summary.groupBy(S.CHANNEL).agg(F.count("*").alias("cnt")).orderBy(F.desc("cnt"), S.CHANNEL)


def price_distribution(summary: DataFrame) -> DataFrame:
    """Price range and gaps per channel."""
    price = F.col(S.PRICE)
    return summary.groupBy(S.CHANNEL).agg(
        F.min(price).alias("min_p"),
        F.max(price).alias("max_p"),
        F.round(F.avg(price), 0).alias("avg_p"),
        F.count("*").alias("total"),
        F.count_if(price.isNull()).alias("null_cnt"),
    )


def conversion_distribution(summary: DataFrame) -> DataFrame:
    """Conversion range and coverage per channel."""
    conversion = F.col(S.CONVERSION)
    return summary.groupBy(S.CHANNEL).agg(
        F.min(conversion).alias("min_c"),
        F.max(conversion).alias("max_c"),
        F.round(F.avg(conversion), 1).alias("avg_c"),
        F.count(conversion).alias("has_cnt"),
    )


def volume_spread(summary: DataFrame, channel: str = "天猫") -> DataFrame:
    """Range and number of distinct volumes of one channel."""
    return summary.where(F.col(S.CHANNEL) == channel).agg(
        F.min(S.VOLUME).alias("min_v"),
        F.max(S.VOLUME).alias("max_v"),
        F.count_distinct(S.VOLUME).alias("distinct_v"),
        F.count("*").alias("total"),
    )
