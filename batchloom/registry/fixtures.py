"""Inputs of the registered queries, derived from the test tables.

Each recipe is one SELECT that Spark SQL and DuckDB both run, so that a query and the SQL it is
checked against start from the same rows. Recipes may name other recipes as tables.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from batchloom.plans.channels import CHANNELS
from batchloom.storage import work_path

# A path that depends on the document: eight kinds of name, among them upper case, an unsupported
# type and no extension.
_PATH = (
    "concat(source, '/', CAST(doc_id AS STRING), CASE doc_id % 8 WHEN 0 THEN '.jpg' WHEN 1 THEN '.PNG' "
    "WHEN 2 THEN '.mp4' WHEN 3 THEN '.mp3' WHEN 4 THEN '.csv' WHEN 5 THEN '.webp' WHEN 6 THEN '.mov' ELSE '' END)"
)

# The key of a sold product: the first channel is keyed by title, the others by number.
_ITEM = "CASE WHEN region = 0 THEN concat(p_name, ' ', CAST(p_partkey AS STRING)) ELSE CAST(p_partkey AS STRING) END"

RECIPES = {
    # Text source: some texts blank, some keys NULL, flagged documents submitted twice.
    "f_req": (
        "SELECT doc_id, CASE WHEN doc_id % 53 = 0 THEN NULL ELSE source END AS source, "
        "CASE WHEN doc_id % 37 = 0 THEN '' WHEN doc_id % 41 = 0 THEN concat(chr(9), '　 ') ELSE text END AS text, "
        "lang, 0 AS copy_no FROM documents UNION ALL "
        "SELECT d.doc_id, d.source, concat('again: ', d.text) AS text, d.lang, 1 AS copy_no "
        "FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE l.toxic = 1"
    ),
    # Rows already processed.
    "f_tgt": (
        "SELECT d.doc_id, d.source, CAST(l.quality AS STRING) AS ai_result, "
        "concat('batch-', CAST(d.doc_id % 3 AS STRING)) AS batch_id "
        "FROM documents d JOIN labels l ON d.doc_id = l.doc_id"
    ),
    "f_files": f"SELECT {_PATH} AS relative_path, n_chars AS size FROM documents",
    "f_url": (
        f"SELECT {_PATH} AS relative_path, CASE WHEN doc_id % 11 = 0 THEN NULL WHEN doc_id % 13 = 0 THEN '' "
        "ELSE concat('https://files.example.com/', CAST(doc_id AS STRING)) END AS url FROM documents"
    ),
    "f_done_files": (
        f"SELECT {_PATH} AS file_path, l.quality FROM documents d JOIN labels l USING (doc_id)"
    ),
    # Result lines: junk, no id, null response, failed status, no usage, ids by provider.
    "f_res": (
        "SELECT doc_id, CASE WHEN doc_id % 29 = 0 THEN 'not json' "
        "WHEN doc_id % 47 = 0 THEN '  ' "
        "WHEN doc_id % 43 = 0 THEN '{\"response\":{\"status_code\":200,\"body\":{}}}' "
        "WHEN doc_id % 31 = 0 THEN concat('{\"custom_id\":\"req-', CAST(doc_id AS STRING), '\",\"response\":null}') "
        "WHEN doc_id % 23 = 0 THEN concat('{\"custom_id\":\"req-', CAST(doc_id AS STRING), "
        "'\",\"response\":{\"status_code\":500,\"body\":{}}}') "
        "WHEN doc_id % 19 = 0 THEN concat('{\"id\":\"x', CAST(doc_id AS STRING), '\",\"custom_id\":\"req-', "
        "CAST(doc_id AS STRING), '\",\"response\":{\"status_code\":200,\"body\":{\"model\":\"m1\",\"choices\":"
        "[{\"message\":{\"content\":\"', lang, '\"},\"finish_reason\":\"length\"}]}}}') "
        "WHEN doc_id % 17 = 0 THEN concat('{\"custom_id\":\"', CAST(doc_id AS STRING), '\",\"response\":"
        "{\"status_code\":200,\"body\":{\"id\":\"b', CAST(doc_id AS STRING), '\",\"model\":\"m2\",\"choices\":[],"
        "\"usage\":null}}}') "
        "ELSE concat('{\"custom_id\":\"req-', CAST(doc_id AS STRING), '\",\"response\":{\"status_code\":200,"
        "\"request_id\":\"r', CAST(doc_id AS STRING), '\",\"body\":{\"model\":\"m1\",\"choices\":[{\"message\":"
        "{\"content\":\"', lang, '\"},\"finish_reason\":\"stop\"}],\"usage\":{\"prompt_tokens\":', "
        "CAST(n_chars AS STRING), ',\"completion_tokens\":2,\"total_tokens\":', CAST(n_chars + 2 AS STRING), '}}}}') "
        "END AS line FROM documents"
    ),
    "f_err": (
        "SELECT event_id, CAST(event_id % 6 AS INT) + 1 AS attempt, concat('{\"custom_id\":\"req-', "
        "CAST(event_id AS STRING), '\",\"error\":', CASE event_id % 5 WHEN 0 THEN "
        "'{\"code\":\"429\",\"message\":\"rate limit\"}' WHEN 1 THEN '{\"code\":\"500\",\"message\":\"server\"}' "
        "WHEN 2 THEN '{\"code\":\"invalid_request\",\"message\":\"bad\"}' WHEN 3 THEN "
        "'{\"code\":\"400\",\"message\":\"Connection Reset\"}' ELSE 'null' END, '}') AS line "
        "FROM events WHERE event_type = 'error'"
    ),
    "f_jobs": (
        "SELECT concat('batch-', CAST(user_id AS STRING)) AS batch_id, CASE event_type WHEN 'view' THEN 'submitted' "
        "WHEN 'click' THEN 'in_progress' WHEN 'purchase' THEN 'completed' WHEN 'error' THEN 'failed' "
        "ELSE 'validating' END AS status, ts AS updated_at, event_id, "
        "CAST(event_id % 4 AS INT) * 40 AS total_requests, CAST(event_id % 37 AS INT) AS completed_requests, "
        "CAST(event_id % 3 AS INT) AS failed_requests FROM events"
    ),
    # Products sold per region; each of the five regions stands for one sales channel.
    "f_sold": (
        "SELECT r.region, p.p_partkey, p.p_name, p.p_brand, p.p_type, p.p_size, r.qty, r.amount, "
        "CAST(p.p_retailprice AS DECIMAL(18,2)) AS list_price FROM ("
        "SELECT l.l_partkey, n.n_regionkey AS region, CAST(SUM(CAST(l.l_quantity AS BIGINT)) AS BIGINT) AS qty, "
        "CAST(SUM(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS amount "
        "FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey "
        "GROUP BY l.l_partkey, n.n_regionkey) r JOIN part p ON r.l_partkey = p.p_partkey"
    ),
    # Exact amounts; small volumes are missing and one size is listed twice.
    "f_sales_a": (
        f"SELECT {_ITEM} AS item_key, CAST(amount AS STRING) AS sales, "
        "CASE WHEN p_size = 13 THEN '' WHEN p_size = 14 THEN '0' ELSE CAST(qty AS STRING) END AS volume "
        "FROM f_sold WHERE region = 0 UNION ALL "
        f"SELECT {_ITEM} AS item_key, '100.00' AS sales, '8' AS volume FROM f_sold WHERE region = 0 AND p_size = 7"
    ),
    "f_sales_b": (
        "SELECT CAST(p_partkey AS STRING) AS item_key, p_name AS title, "
        "CASE WHEN p_size = 21 THEN '' ELSE CAST(list_price AS STRING) END AS price, "
        "CASE WHEN p_size % 9 = 1 THEN '' WHEN p_size % 9 = 2 THEN concat(CAST(p_size AS STRING), '.5万 ~ ', "
        "CAST(p_size * 2 AS STRING), '万') ELSE concat(CAST(qty AS STRING), ' ~ ', CAST(p_size AS STRING), '万') END "
        "AS volume_range FROM f_sold WHERE region = 1"
    ),
    "f_sales_c": (
        "SELECT CAST(p_partkey AS STRING) AS item_key, p_name AS title, CAST(qty * 70 AS STRING) AS heat, "
        "CAST(qty * 24 AS STRING) AS popularity, CAST(p_size * 170 AS STRING) AS visits, "
        "CAST(p_size * 84 AS STRING) AS conv_index FROM f_sold WHERE region = 2"
    ),
    # Ranges with outliers: prices beyond the limit, conversions over 100, unreadable forms.
    "f_sales_de": (
        "SELECT region, CAST(p_partkey AS STRING) AS item_key, p_name AS title, "
        "CASE WHEN p_size % 25 = 0 THEN '0' WHEN p_size % 25 = 1 THEN '' ELSE CAST(p_partkey % 200 AS STRING) END AS rank_no, "
        "CASE WHEN p_size % 20 = 5 THEN '200万' WHEN p_size % 20 = 6 THEN 'abc' WHEN p_size % 20 = 7 THEN '1.2.3 ~ 4' "
        "ELSE concat('￥', CAST(qty AS STRING), '万 ~ ￥', CAST(qty + 25 AS STRING), '万') END AS amount_range, "
        "CASE WHEN p_size % 10 = 1 THEN concat(CAST(p_size AS STRING), ',000 ~ ', CAST(p_size * 2 AS STRING), ',000') "
        "WHEN p_size % 10 = 2 THEN '68.0' ELSE concat(CAST(p_size * 100 AS STRING), ' ~ ', CAST(p_size AS STRING), '万') END "
        "AS count_range, "
        "CASE WHEN p_size % 25 = 3 THEN '￥10万 ~ ￥20万' WHEN p_size % 25 = 4 THEN '￥0 ~ ￥0' "
        "ELSE concat('￥', CAST(p_size * 5 AS STRING), ' ~ ￥', CAST(p_size * 10 AS STRING)) END AS price_range, "
        "concat(CAST(p_size AS STRING), '万~', CAST(p_size * 2 AS STRING), '万') AS visits_range, "
        "concat(CAST(p_size * 2 AS STRING), '% ~ ', CAST(p_size * 3 AS STRING), '%') AS conv_range "
        "FROM f_sold WHERE region IN (3, 4)"
    ),
    # Model output per product: junk, null and 'null' brands, odd sizes, later duplicates.
    "f_ai": (
        f"SELECT region, {_ITEM} AS source_key, CASE WHEN p_partkey % 97 = 0 THEN 'no json here' "
        "ELSE concat('{\"品牌\":', CASE WHEN p_size % 31 = 0 THEN 'null' WHEN p_size % 43 = 0 THEN '\"null\"' "
        "ELSE concat('\"', substr(p_brand, 7), '-brand\"') END, ',\"三级类目\":\"', p_type, '\",\"四级类目\":\"', p_name, "
        "'\",\"类目编码\":', CASE WHEN p_size = 44 THEN 'null' ELSE concat('\"', upper(substr(p_type, 1, 2)), '-', "
        "upper(substr(p_name, 1, 2)), '\"') END, ',\"产品名称\":\"', p_name, ' ', CAST(p_partkey AS STRING), "
        "'\",\"配比\":\"\",\"规格\":\"', CASE WHEN p_size % 10 = 0 THEN '' WHEN p_size % 10 = 9 THEN '2.5kg' "
        "WHEN p_size % 10 = 8 THEN concat(CAST(p_size AS STRING), '.3') ELSE CAST(p_size AS STRING) END, '\"}') END "
        "AS ai_result FROM f_sold UNION ALL "
        f"SELECT region, {_ITEM} AS source_key, '~ later duplicate' AS ai_result FROM f_sold WHERE p_size = 20"
    ),
    # The closed list of category codes: all but one product line.
    "f_codes": (
        "SELECT DISTINCT concat(upper(substr(p_type, 1, 2)), '-', upper(substr(p_name, 1, 2))) AS code "
        "FROM part WHERE p_type <> 'PROMO'"
    ),
    # Model answers as text: with a tagged fence, a plain one, one left open, or none.
    "f_fenced": (
        "SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN concat('Sure:', chr(10), '```json', chr(10), '{\"lang\":\"', lang, "
        "'\"}', chr(10), '```', chr(10), 'done') WHEN 1 THEN concat('```', chr(10), '{\"lang\":\"', lang, '\"}', chr(10), '```') "
        "WHEN 2 THEN concat('```json {\"lang\":\"', lang, '\"}') ELSE concat(' {\"lang\":\"', lang, '\"} ') END AS answer FROM documents"
    ),
    # An untyped sheet: header, trimmed cells, blanks, a missing cell, blank rows.
    "f_sheet": (
        "SELECT CAST(0 AS BIGINT) AS row_no, ' key ' AS c0, 'brand' AS c1, '' AS c2, 'size' AS c3 UNION ALL "
        "SELECT p_partkey + 1, CASE WHEN p_size = 33 THEN '  ' ELSE concat(' ', CAST(p_partkey AS STRING)) END, "
        "CASE WHEN p_size = 33 THEN NULL ELSE concat(p_brand, chr(9)) END, CASE WHEN p_size = 33 THEN '' ELSE p_name END, "
        "CASE WHEN p_size = 33 THEN NULL WHEN p_size % 5 = 0 THEN NULL ELSE CAST(p_size AS STRING) END FROM part"
    ),
    # Files of a bucket listing with an unknown size and empty paths.
    "f_inventory": f"SELECT CASE WHEN doc_id % 59 = 0 THEN '' ELSE {_PATH} END AS relative_path, "
    "CASE WHEN doc_id % 7 = 0 THEN NULL ELSE n_chars END AS size FROM documents",
}

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

_stored: dict[tuple, tuple[str, StructType]] = {}
_schemas: dict[str, StructType] = {}


def _named(sql: str, names) -> list[str]:
    words = set(re.findall(r"[a-z_]+", sql))
    return [n for n in names if n in words]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; its schema is inferred once and then given, which saves a job per read."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def recipe(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The rows of a recipe in Spark."""
    sql = RECIPES[name]
    for t in _named(sql, TABLES):
        table(spark, sf_dir, t).createOrReplaceTempView(t)
    for r in _named(sql, RECIPES):
        source = sold(spark, sf_dir) if r == "f_sold" else recipe(spark, sf_dir, r)
        source.createOrReplaceTempView(r)
    return spark.sql(sql)


def ctes(*names: str) -> str:
    """The recipes, with those they name, as a list of common table expressions for DuckDB."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for r in _named(RECIPES[name], RECIPES):
            add(r)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    return ", ".join(f"{n} AS ({RECIPES[n]})" for n in ordered)


def stored(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """A table built once per application and read from shared storage afterwards."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _stored:
        path = work_path(spark, name)
        frame = build()
        frame.write.parquet(path)
        _stored[key] = path, frame.schema
    path, schema = _stored[key]
    return spark.read.schema(schema).parquet(path)


def sold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, sf_dir, "f_sold", lambda: recipe(spark, sf_dir, "f_sold"))


# ASCII recipe columns to the channels' own column names.
_COLUMNS = {
    "抖音": {"item_key": "商品", "sales": "销售额", "volume": "销量"},
    "天猫": {"item_key": "商品编码", "title": "链接名称", "price": "件单价", "volume_range": "支付单量"},
    "天猫超市": {
        "item_key": "商品ID", "title": "商品名称", "heat": "成交热度", "popularity": "成交人气",
        "visits": "访问热度", "conv_index": "转化指数",
    },
    "京东自营": {
        "item_key": "商品编号", "title": "商品名称", "rank_no": "排名", "amount_range": "成交金额",
        "count_range": "成交商品件数", "price_range": "成交客单价", "visits_range": "浏览量", "conv_range": "成交转化率",
    },
}
_COLUMNS["京东POP"] = _COLUMNS["京东自营"]

_RECIPE_OF = ["f_sales_a", "f_sales_b", "f_sales_c", "f_sales_de", "f_sales_de"]


def sales_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The five channels' sales tables, all text, under their own column names."""
    tables = {}
    for region, spec in enumerate(CHANNELS):
        frame = recipe(spark, sf_dir, _RECIPE_OF[region])
        if "region" in frame.columns:
            frame = frame.where(f"region = {region}").drop("region")
        tables[spec.channel] = frame.withColumnsRenamed(_COLUMNS[spec.channel])
    return tables


def ai_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The five channels' model results."""
    results = recipe(spark, sf_dir, "f_ai")
    return {
        spec.channel: results.where(f"region = {region}").drop("region").withColumnRenamed("source_key", spec.key)
        for region, spec in enumerate(CHANNELS)
    }
