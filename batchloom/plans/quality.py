"""Data-quality audit of the channel summary and the product master."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchloom import schemas as S
from batchloom.functions.text import has_value
from batchloom.operators.sinks import table_counts
from batchloom.plans.analytics import MAIN_CHANNEL, band, volume_spread
from batchloom.plans.channels import CHANNELS, ChannelSpec, standardise_channel

# Audit thresholds.
PRICE_ALARM = 1000
CONVERSION_ALARM = 100
AUDIT_BANDS = [50, 100, 200, 500, 1000]
SIGNED_METRICS = [S.SALES, S.VOLUME, S.PRICE, S.TRAFFIC]
NULL_COUNTS = dict(zip(S.METRICS, ["n_sales", "n_vol", "n_price", "n_traffic", "n_conv", "n_rank"]))


def price_anomalies(summary: DataFrame, above: float = PRICE_ALARM, n: int | None = 10) -> DataFrame:
    return _highest(summary, S.PRICE, above, n)


def conversion_anomalies(summary: DataFrame, above: float = CONVERSION_ALARM, n: int | None = 10) -> DataFrame:
    return _highest(summary, S.CONVERSION, above, n)


def _highest(summary: DataFrame, metric: str, above: float, n: int | None) -> DataFrame:
    """Rows above a limit: the ``n`` highest, or all of them without ``n``."""
    rows = summary.where(F.col(metric) > above)
    if n is not None:
        rows = rows.orderBy(F.desc(metric), S.CHANNEL, S.CODE, S.PRODUCT).limit(n)
    return rows.select(S.CHANNEL, S.BRAND, S.PRODUCT, metric)


def empty_brands(summary: DataFrame) -> DataFrame:
    """Rows without a brand per channel; channels without any are left out."""
    return summary.where(~has_value(F.col(S.BRAND))).groupBy(S.CHANNEL).agg(F.count("*").alias("cnt"))


def negative_values(summary: DataFrame, metrics: Sequence[str] = SIGNED_METRICS) -> DataFrame:
    """Negative values per metric, all in one scan."""
    counted = summary.agg(*[F.count_if(F.col(m) < 0).alias(m) for m in metrics])
    return counted.unpivot([], list(metrics), "metric", "negatives")


def null_rates(summary: DataFrame) -> DataFrame:
    """NULLs per metric and channel, all in one scan."""
    return summary.groupBy(S.CHANNEL).agg(
        F.count("*").alias("total"), *[F.count_if(F.col(m).isNull()).alias(a) for m, a in NULL_COUNTS.items()]
    )


def duplicates(summary: DataFrame, n: int | None = 5) -> DataFrame:
    """Product codes that occur more than once in a channel: the ``n`` most frequent, or all without ``n``."""
    counted = summary.groupBy(S.CHANNEL, S.CODE).agg(F.count("*").alias("cnt")).where(F.col("cnt") > 1)
    return counted if n is None else counted.orderBy(F.desc("cnt"), S.CHANNEL, S.CODE).limit(n)


def raw_vs_parsed(raw: DataFrame, master: DataFrame, spec: ChannelSpec = CHANNELS[3]) -> DataFrame:
    """A range channel's raw texts beside the numbers they are read as, for every row with a master entry.

    Each row is read beside its own texts, by the same rules as the channel summary, so repeated products
    and product codes that collide can't pair texts with the numbers of other rows.
    """
    read = [S.SALES, S.VOLUME, S.PRICE]
    texts = [spec.midpoint[m] for m in read]
    own = master.where(F.col(S.PLATFORM) == spec.channel).select(S.SOURCE_KEY)
    parsed = standardise_channel(raw, spec, [spec.title, *texts])
    return parsed.join(own, S.SOURCE_KEY, "left_semi").select(spec.title, *texts, *read)


def range_readings(
    sales: Mapping[str, DataFrame], master: DataFrame, specs: Sequence[ChannelSpec] = CHANNELS
) -> DataFrame:
    """Every range text of every channel beside its number: (channel, source_key, metric, raw_text, value).

    As in ``raw_vs_parsed``, each row is read beside its own texts, and only rows with a master entry are shown;
    a row that is there twice is shown twice.
    """
    read = []
    for spec in specs:
        if spec.channel in sales and spec.midpoint:
            texts = {m: F.col(c).alias(f"_raw_{m}") for m, c in spec.midpoint.items()}
            rows = standardise_channel(sales[spec.channel], spec, list(texts.values()))
            parts = {m: (F.lit(m).alias("metric"), F.col(f"_raw_{m}").alias("raw_text"), F.col(m).alias("value")) for m in texts}
            cells = F.explode(F.array(*[F.struct(*p) for p in parts.values()])).alias("cell")
            read.append(rows.select(F.col(S.CHANNEL).alias("channel"), F.col(S.SOURCE_KEY).alias("source_key"), cells))
    own = master.select(F.col(S.PLATFORM).alias("channel"), F.col(S.SOURCE_KEY).alias("source_key"))
    shown = reduce(DataFrame.unionByName, read).join(own, ["channel", "source_key"], "left_semi")
    return shown.select("channel", "source_key", "cell.*")


def audit_price_bands(
    summary: DataFrame, channel: str = MAIN_CHANNEL, edges: Sequence[int] = AUDIT_BANDS
) -> DataFrame:
    rows = summary.where((F.col(S.CHANNEL) == channel) & F.col(S.PRICE).isNotNull())
    stats = rows.groupBy(band(F.col(S.PRICE), edges).alias("band")).agg(
        F.count("*").alias("cnt"), F.min(S.PRICE).alias("min_price")
    )
    return stats.orderBy("min_price").select("band", "cnt")


def master_completeness(master: DataFrame) -> DataFrame:
    """Gaps of the product master per platform."""

    def empty(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit("")) == ""

    return master.groupBy(S.PLATFORM).agg(
        F.count("*").alias("total"),
        F.count_if(~has_value(F.col(S.BRAND))).alias("no_brand"),
        F.count_if(empty(S.CAT3)).alias("no_cat3"),
        F.count_if(empty(S.SPEC)).alias("no_spec"),
    )


def audit_counts(
    summary: DataFrame, channel: str = MAIN_CHANNEL, edges: Sequence[int] = AUDIT_BANDS
) -> DataFrame:
    """Empty brands, negatives, NULLs and price bands as findings, from one scan.

    Everything is counted per channel at once; the few resulting rows are then spread into
    findings and added up per subject.
    """
    price = F.col(S.PRICE)
    counted = {"empty_brand": F.count_if(~has_value(F.col(S.BRAND)))}
    counted |= {f"negative {m}": F.count_if(F.col(m) < 0) for m in SIGNED_METRICS}
    counted |= {f"null_count {a}": F.count_if(F.col(m).isNull()) for m, a in NULL_COUNTS.items()}
    lows, highs = [None, *edges], [*edges, None]
    for low, high in zip(lows, highs):
        inside = (F.col(S.CHANNEL) == channel) & price.isNotNull()
        inside = inside & (price >= low) if low is not None else inside
        inside = inside & (price < high) if high is not None else inside
        counted[f"price_band {f'{low}+' if high is None else f'{low or 0}-{high}'}"] = F.count_if(inside)
    per_channel = summary.groupBy(S.CHANNEL).agg(*[c.alias(n) for n, c in counted.items()])
    spread = per_channel.unpivot([S.CHANNEL], list(counted), "counter", "rows")
    check = F.substring_index("counter", " ", 1)
    item = F.substring_index("counter", " ", -1)
    subject = (
        F.when(check == "empty_brand", F.col(S.CHANNEL))
        .when(check == "null_count", F.concat_ws("/", S.CHANNEL, item))
        .otherwise(item)
    )
    summed = spread.groupBy(check.alias("check"), subject.alias("subject")).agg(
        F.sum("rows").cast("double").alias("value")
    )
    shown = (F.col("value") > 0) | F.col("check").isin("negative", "null_count")
    issue = F.col("check").isin("empty_brand", "negative") & (F.col("value") > 0)
    return summed.where(shown).withColumn("is_issue", issue)


def _finding(df: DataFrame, check: str, subject: Column, value: Column, issue: Column) -> DataFrame:
    return df.select(
        F.lit(check).alias("check"),
        subject.cast("string").alias("subject"),
        value.cast("double").alias("value"),
        F.coalesce(issue, F.lit(False)).alias("is_issue"),
    )


def unread_texts(raw: DataFrame, master: DataFrame, spec: ChannelSpec = CHANNELS[3]) -> DataFrame:
    """Per metric of a range channel, rows whose raw text was read as no number."""
    pairs = raw_vs_parsed(raw, master, spec)
    metrics = [S.SALES, S.VOLUME, S.PRICE]
    unread = [F.count_if((F.col(spec.midpoint[m]) != "") & F.col(m).isNull()).alias(m) for m in metrics]
    return pairs.agg(*unread).unpivot([], metrics, "metric", "rows")


def dq_report(
    summary: DataFrame,
    master: DataFrame,
    tables: Mapping[str, DataFrame | None],
    raw: DataFrame | None = None,
    spec: ChannelSpec = CHANNELS[3],
) -> DataFrame:
    """All checks as (check, subject, value, is_issue).

    ``summary`` and ``master`` should be stored tables. All checks that count rows share one scan
    of the summary; the others read the few columns they need. ``raw`` is the sales table of the
    range channel whose texts are held against its numbers.
    """
    always, never = F.lit(True), F.lit(False)
    channel_brand = F.concat_ws("/", S.CHANNEL, S.BRAND, S.PRODUCT)
    complete = master_completeness(master).drop("total")
    complete_rows = complete.unpivot([S.PLATFORM], ["no_brand", "no_cat3", "no_spec"], "gap", "rows")
    spread = volume_spread(summary)
    checks = [
        _finding(
            table_counts(dict(tables), summary.sparkSession), "table_rows", F.col("table_name"), F.col("rows"),
            F.col("missing"),
        ),
        _finding(price_anomalies(summary, n=None), "price_anomaly", channel_brand, F.col(S.PRICE), always),
        _finding(conversion_anomalies(summary, n=None), "conversion_anomaly", channel_brand, F.col(S.CONVERSION), always),
        _finding(spread, "volume_distinct", F.lit("天猫"), F.col("distinct_v"), F.col("distinct_v") == 1),
        audit_counts(summary),
        _finding(duplicates(summary, n=None), "duplicate", F.concat_ws("/", S.CHANNEL, S.CODE), F.col("cnt"), always),
        _finding(complete_rows, "master_gap", F.concat_ws("/", S.PLATFORM, "gap"), F.col("rows"), never),
    ]
    if raw is not None:
        subject = F.concat_ws("/", F.lit(spec.channel), "metric")
        checks.append(_finding(unread_texts(raw, master, spec), "unread_text", subject, F.col("rows"), never))
    return reduce(DataFrame.unionByName, checks)


def issue_counts(report: DataFrame) -> DataFrame:
    """Findings and issues per check."""
    return report.groupBy("check").agg(F.count("*").alias("findings"), F.count_if("is_issue").alias("issues"))
