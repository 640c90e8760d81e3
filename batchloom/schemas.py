"""Column names, types and layouts shared by the whole package."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: audit columns appended to every result row, in this order ---
METADATA = T.StructType(
    [
        T.StructField("model", T.StringType()),
        T.StructField("provider", T.StringType()),
        T.StructField("prompt_tokens", T.IntegerType()),
        T.StructField("completion_tokens", T.IntegerType()),
        T.StructField("total_tokens", T.IntegerType()),
        T.StructField("batch_id", T.StringType()),
        T.StructField("processed_at", T.StringType()),
        T.StructField("status_code", T.IntegerType()),
        T.StructField("finish_reason", T.StringType()),
        T.StructField("response_id", T.StringType()),
        T.StructField("source_text", T.StringType()),
        T.StructField("raw_response", T.StringType()),
    ]
)
METADATA_COLUMNS = METADATA.names

# --- Fixed values: columns of a file-mode target ahead of the result column ---
FILE_COLUMNS = T.StructType(
    [
        T.StructField("file_path", T.StringType()),
        T.StructField("volume_name", T.StringType()),
        T.StructField("file_size", T.LongType()),
    ]
)

DEFAULT_RESULT_COLUMN = "ai_result"

# --- Fixed values: product and channel column names (they are the published table layout) ---
BRAND = "品牌"
CAT1 = "一级类目"
CAT2 = "二级类目"
CAT3 = "三级类目"
CAT4 = "四级类目"
CAT_CODE = "类目编码"
PRODUCT = "产品名称"
CODE = "主数据"
SPEC = "规格"
FORMULA = "配比"
PLATFORM = "数据来源平台"
SOURCE_KEY = "源数据主键"
SOURCE_NAME = "源数据商品名称"
AI_RAW = "ai_raw"
CHANNEL = "渠道"
SALES = "销售额"
VOLUME = "销量"
PRICE = "件单价"
TRAFFIC = "浏览量"
CONVERSION = "转化率"
RANK = "排名"
PRECISION = "数据精度"

METRICS = [SALES, VOLUME, PRICE, TRAFFIC, CONVERSION, RANK]

# Fields the model is asked to return for one product, in prompt order.
PRODUCT_FIELDS = [BRAND, CAT3, CAT4, CAT_CODE, PRODUCT, FORMULA, SPEC]


def _described(name: str, data_type: T.DataType, comment: str) -> T.StructField:
    return T.StructField(name, data_type, True, {"comment": comment})


MASTER_COMMENT = "Product master extracted from all channels, de-duplicated"
MASTER = T.StructType(
    [
        _described(BRAND, T.StringType(), "brand name found by the model"),
        _described(CAT1, T.StringType(), "level 1 category, constant"),
        _described(CAT2, T.StringType(), "level 2 category, constant"),
        _described(CAT3, T.StringType(), "level 3 category found by the model"),
        _described(CAT4, T.StringType(), "level 4 category found by the model"),
        _described(PRODUCT, T.StringType(), "standardised product name"),
        _described(CODE, T.StringType(), "generated code: brand-PS-CL-category-sequence-grams"),
        _described(SPEC, T.StringType(), "size in kg found by the model"),
        _described(FORMULA, T.StringType(), "ingredient ratio found by the model"),
        _described(PLATFORM, T.StringType(), "channel the row came from"),
        _described(SOURCE_KEY, T.StringType(), "key in the channel's sales table"),
        _described(SOURCE_NAME, T.StringType(), "title in the channel's sales table"),
        _described(CAT_CODE, T.StringType(), "category code from the closed list"),
        _described(AI_RAW, T.StringType(), "model output kept for audit"),
    ]
)

SUMMARY_COMMENT = "Sales of all channels on one numeric layout"
SUMMARY = T.StructType(
    [
        _described(BRAND, T.StringType(), "brand name"),
        _described(CAT3, T.StringType(), "level 3 category"),
        _described(CAT4, T.StringType(), "level 4 category"),
        _described(CAT_CODE, T.StringType(), "category code"),
        _described(PRODUCT, T.StringType(), "product name"),
        _described(CODE, T.StringType(), "product master code"),
        _described(SPEC, T.StringType(), "size in kg"),
        _described(CHANNEL, T.StringType(), "sales channel"),
        _described(SALES, T.DoubleType(), "sales amount"),
        _described(VOLUME, T.DoubleType(), "units sold"),
        _described(PRICE, T.DoubleType(), "unit price"),
        _described(TRAFFIC, T.DoubleType(), "page views"),
        _described(CONVERSION, T.DoubleType(), "conversion in percent"),
        _described(RANK, T.DoubleType(), "rank in the channel"),
        _described(PRECISION, T.StringType(), "how exact the numbers are"),
    ]
)


def target_schema(
    source: T.StructType,
    keys: list[str],
    result_column: str = DEFAULT_RESULT_COLUMN,
    include_metadata: bool = True,
) -> T.StructType:
    """Layout of a table-mode target: typed keys, the result text, the audit columns.

    Key types follow the source: long, int, float/double and decimal keep a numeric type (decimals
    keep their own precision and scale, so that no key value is rounded), all others become strings.
    """
    by_name = {f.name.lower(): f.dataType for f in source.fields}
    fields = [T.StructField(k, _key_type(by_name.get(k.lower()))) for k in keys]
    fields.append(T.StructField(result_column, T.StringType()))
    return T.StructType(fields + (METADATA.fields if include_metadata else []))


def file_target_schema(
    result_column: str = DEFAULT_RESULT_COLUMN, include_metadata: bool = True
) -> T.StructType:
    """Layout of a file-mode target."""
    fields = FILE_COLUMNS.fields + [T.StructField(result_column, T.StringType())]
    return T.StructType(fields + (METADATA.fields if include_metadata else []))


def _key_type(source_type: T.DataType | None) -> T.DataType:
    if isinstance(source_type, (T.LongType, T.DecimalType)):
        return source_type
    if isinstance(source_type, (T.ByteType, T.ShortType, T.IntegerType)):
        return T.IntegerType()
    if isinstance(source_type, (T.FloatType, T.DoubleType)):
        return T.DoubleType()
    return T.StringType()
