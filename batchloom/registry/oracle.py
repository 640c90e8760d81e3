"""The SQL each registered query is checked against, in DuckDB's dialect.

Written from the definitions of the operators, over the same recipes; it shares no code with them.
"""

from __future__ import annotations

from batchloom.registry.fixtures import RECIPES, ctes

_SPACE = r"\t-\r\x1c-\x1f\x{85}\p{Z}"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^[{_SPACE}]+|[{_SPACE}]+$', '', 'g')"


def _blank(x: str) -> str:
    return f"(({x}) IS NULL OR NOT regexp_matches({x}, '[^{_SPACE}]'))"


def _number(x: str) -> str:
    pattern = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
    return f"CASE WHEN regexp_matches({_strip(x)}, '{pattern}') THEN TRY_CAST({_strip(x)} AS DOUBLE) END"


def _midpoint(x: str) -> str:
    clean = _strip(f"replace(replace(replace({x}, ',', ''), '￥', ''), '%', '')")
    pattern = r"^([\d.]+)(万)?\s*~\s*([\d.]+)(万)?"

    def end(group: int) -> str:
        number = f"TRY_CAST(regexp_extract({clean}, '{pattern}', {group}) AS DOUBLE)"
        return f"{number} * CASE WHEN regexp_extract({clean}, '{pattern}', {group + 1}) = '万' THEN 10000 ELSE 1 END"

    ranged = f"({end(1)} + {end(3)}) / 2.0"
    return f"CASE WHEN {_blank(x)} THEN NULL WHEN regexp_matches({clean}, '{pattern}') THEN {ranged} ELSE {_number(clean)} END"


def _round(x: str, digits: int) -> str:
    """Half-up rounding of a double's shortest decimal form."""
    return f"CAST(ROUND(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,20)), {digits}) AS DOUBLE)"


def _json(field: str) -> str:
    return f"json_extract_string(CASE WHEN json_valid(ai_result) THEN ai_result END, '$.\"{field}\"')"


def _has(x: str) -> str:
    return f"({x} IS NOT NULL AND {x} <> '' AND {x} <> 'null')"


_PLATFORM = (
    "CASE region WHEN 0 THEN '抖音' WHEN 1 THEN '天猫' WHEN 2 THEN '天猫超市' WHEN 3 THEN '京东自营' ELSE '京东POP' END"
)

# --- requests ---


def _request_json(custom_id: str, user: str) -> str:
    return (
        f"CAST(json_object('custom_id', {custom_id}, 'method', 'POST', 'url', '/v1/chat/completions', 'body', "
        "json_object('model', 'm1', 'messages', json_array(json_object('role', 'system', 'content', "
        f"'Label the language.'), json_object('role', 'user', 'content', 'Text: ' || {user})), "
        "'temperature', 0.5, 'max_tokens', 64)) AS VARCHAR)"
    )


def _candidates(rows: str) -> str:
    return (
        f"cand AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY doc_id, source ORDER BY copy_no) AS rn FROM {rows} "
        f"WHERE doc_id IS NOT NULL AND source IS NOT NULL AND NOT {_blank('text')})"
    )


_DOC_ID = "'req-' || url_encode(CAST(doc_id AS VARCHAR)) || '|' || url_encode(source)"
_REQ = (
    f"{ctes('f_req')}, {_candidates('f_req')}, req AS (SELECT doc_id, source, text AS source_text, "
    f"{_DOC_ID} AS custom_id, {_request_json(_DOC_ID, 'text')} AS request FROM cand WHERE rn = 1)"
)
_SENT = (
    f"sent AS (SELECT doc_id, 'req-' || doc_id AS custom_id, text AS source_text FROM documents WHERE lang <> 'de' "
    f"AND NOT {_blank('text')})"
)


def _shards(max_rows: int, max_bytes: int, max_line: int) -> str:
    return (
        f"{_REQ}, n AS (SELECT GREATEST(1, CAST(CEIL(SUM(strlen(request) + 1) / {8 * max_bytes}.0) AS BIGINT)) AS n FROM req), "
        "bucketed AS (SELECT custom_id, request, CAST('0x' || substr(md5(custom_id), 1, 8) AS BIGINT) "
        "% (SELECT n FROM n) AS bucket FROM req), running AS (SELECT custom_id, bucket, "
        "COALESCE(SUM(strlen(request) + 1) OVER (PARTITION BY bucket ORDER BY custom_id ROWS BETWEEN UNBOUNDED PRECEDING "
        "AND 1 PRECEDING), 0) AS before, ROW_NUMBER() OVER (PARTITION BY bucket ORDER BY custom_id) AS rn FROM bucketed) "
        f"SELECT custom_id, bucket || '-' || CAST(before // {max_bytes - max_line - 1} AS BIGINT) || '-' || "
        f"CAST((rn - 1) // {max_rows} AS BIGINT) AS shard FROM running"
    )


def _media(provider_audio: bool, system: str, model: str, params: str) -> str:
    def ext(*names: str) -> str:
        return "lower(regexp_extract(relative_path, '\\.([^.]*)$', 1)) IN (" + ", ".join(f"'{n}'" for n in names) + ")"

    image = ext("jpg", "jpeg", "png", "gif", "bmp", "webp", "tiff", "tif")
    video = ext("mp4", "avi", "mov", "mkv", "webm")
    audio = ext("mp3", "wav", "flac", "ogg", "m4a")
    kind = f"CASE WHEN {image} THEN 'image_url' WHEN {video} THEN 'video_url' WHEN {audio} THEN 'input_audio' END"
    allowed = "kind IS NOT NULL" if provider_audio else "kind IN ('image_url', 'video_url')"
    text = "json_object('type', 'text', 'text', 'Describe this file')"
    part = "json_object('type', kind, kind, json_object('url', url))"
    user = f"json_object('role', 'user', 'content', json_array({part}, {text}))"
    messages = f"json_array({system}{user})"
    cid = "'req-' || url_encode(relative_path)"
    return (
        f"WITH {ctes('f_files', 'f_url')}, joined AS (SELECT f.relative_path, u.url, {kind.replace('relative_path', 'f.relative_path')} "
        "AS kind FROM f_files f JOIN f_url u ON f.relative_path = u.relative_path WHERE u.url <> '') "
        f"SELECT relative_path, {cid} AS custom_id, CAST(json_object('custom_id', {cid}, 'method', 'POST', 'url', "
        f"'/v1/chat/completions', 'body', json_object('model', '{model}', 'messages', {messages}{params})) AS VARCHAR) AS request "
        f"FROM joined WHERE {allowed}"
    )


# --- results ---

_VALID = "CASE WHEN json_valid(line) THEN line END"


def _get(path: str) -> str:
    return f"json_extract_string({_VALID}, '$.{path}')"


_REASON = (
    f"CASE WHEN NOT json_valid(line) THEN 'not_json' WHEN COALESCE({_get('custom_id')}, '') = '' THEN 'no_custom_id' "
    f"WHEN json_type({_VALID}, '$.response') = 'NULL' THEN 'null_response' END"
)
_LINES = f"lines AS (SELECT doc_id, line, {_REASON} AS reason FROM f_res WHERE NOT {_blank('line')})"


def _count(field: str) -> str:
    return f"COALESCE(CAST({_get('response.' + field)} AS INT), 0)"


_FLAT = (
    f"{ctes('f_res')}, {_LINES}, flat AS (SELECT {_get('custom_id')} AS custom_id, "
    f"COALESCE({_get('response.body.choices[0].message.content')}, '') AS content, "
    f"COALESCE({_get('response.body.model')}, '') AS model, "
    f"{_count('body.usage.prompt_tokens')} AS prompt_tokens, {_count('body.usage.completion_tokens')} AS completion_tokens, "
    f"{_count('body.usage.total_tokens')} AS total_tokens, {_count('status_code')} AS status_code, "
    f"COALESCE({_get('response.body.choices[0].finish_reason')}, '') AS finish_reason, "
    f"COALESCE(NULLIF({_get('response.request_id')}, ''), NULLIF({_get('response.body.request_id')}, ''), "
    f"NULLIF({_get('response.body.id')}, ''), NULLIF({_get('id')}, ''), '') AS response_id, "
    f"COALESCE(NULLIF(CAST(json_extract({_VALID}, '$.response.body') AS VARCHAR), '{{}}'), '') AS raw_response "
    "FROM lines WHERE reason IS NULL)"
)
_BARE = "CASE WHEN starts_with(f.custom_id, 'req-') THEN substr(f.custom_id, 5) ELSE f.custom_id END"
_AUDITED = (
    f"{_FLAT}, {_SENT}, audited AS (SELECT {_BARE} AS doc_id, f.content AS ai_result, f.model, 'dashscope' AS provider, "
    "f.prompt_tokens, f.completion_tokens, f.total_tokens, 'batch-7' AS batch_id, '2024-03-02T04:30:00+08:00' AS processed_at, "
    "f.status_code, f.finish_reason, f.response_id, COALESCE(s.source_text, '') AS source_text, f.raw_response "
    "FROM flat f LEFT JOIN sent s ON f.custom_id = s.custom_id)"
)
_ERR = (
    f"{ctes('f_err')}, err AS (SELECT {_get('custom_id')} AS custom_id, {_get('error.code')} AS error_code, "
    f"{_get('error.message')} AS error_message, line AS raw, attempt FROM f_err)"
)
_SAID = "lower(concat_ws(' ', error_code, error_message))"
_WORDS = ["rate limit", "429", "500", "502", "503", "504", "timeout", "connection", "reset", "broken pipe"]
_TRANSIENT = "(" + " OR ".join(f"contains({_SAID}, '{w}')" for w in _WORDS) + ")"
_RETRYABLE = (
    "(NOT COALESCE(TRY_CAST(error_code AS INT) BETWEEN 400 AND 499 AND TRY_CAST(error_code AS INT) <> 429, FALSE) "
    f"AND {_TRANSIENT})"
)

_METADATA = [
    ("model", "string"), ("provider", "string"), ("prompt_tokens", "int"), ("completion_tokens", "int"),
    ("total_tokens", "int"), ("batch_id", "string"), ("processed_at", "string"), ("status_code", "int"),
    ("finish_reason", "string"), ("response_id", "string"), ("source_text", "string"), ("raw_response", "string"),
]


def _columns(table: str, filled: list[str], layout: list[tuple[str, str]]) -> str:
    rows = [
        f"SELECT '{n}' AS column_name, '{t}' AS data_type, {f'COUNT({n})' if n in filled else 'COUNT(NULL)'} AS filled FROM {table}"
        for n, t in layout
    ]
    return " UNION ALL ".join(rows)


# --- runs with the known scorer ---

_ANSWERED = (
    f"{ctes('f_req', 'f_tgt')}, fresh AS (SELECT * FROM f_req r WHERE NOT EXISTS (SELECT 1 FROM f_tgt t "
    f"WHERE t.doc_id = r.doc_id AND t.source = r.source)), {_candidates('fresh')}, "
    f"req AS (SELECT doc_id, source, text AS source_text, {_DOC_ID} AS custom_id, "
    f"strlen({_request_json(_DOC_ID, 'text')}) AS size FROM cand WHERE rn = 1)"
)
_FILE_RUN = (
    f"{ctes('f_files', 'f_done_files')}, media AS ({_media(False, '', 'm2', '')}), filereq AS (SELECT m.relative_path, "
    "f.size, strlen(m.request) AS bytes FROM media m JOIN f_files f ON m.relative_path = f.relative_path "
    "WHERE starts_with(m.relative_path, 'src') AND lower(regexp_extract(m.relative_path, '\\.([^.]*)$', 1)) IN "
    "('jpg', 'png', 'mp3', 'mov') AND m.relative_path NOT IN (SELECT file_path FROM f_done_files))"
)


def _answer_body(size: str) -> str:
    return (
        "'{\"model\":\"m1\",\"choices\":[{\"message\":{\"content\":\"' || " + size +
        " || '\"},\"finish_reason\":\"stop\"}],\"usage\":{\"prompt_tokens\":1,\"completion_tokens\":1,\"total_tokens\":2}}'"
    )


# --- channels ---

_UNION = f"{ctes('f_ai')}, united AS (SELECT {_PLATFORM} AS platform, source_key, ai_result FROM f_ai)"

_MASTER = (
    f"{ctes('f_ai', 'f_sales_a', 'f_sales_b', 'f_sales_c', 'f_sales_de')}, "
    f"united AS (SELECT {_PLATFORM} AS platform, source_key, ai_result FROM f_ai), "
    "titles AS (SELECT platform, item_key, MIN(title) AS title FROM (SELECT '天猫' AS platform, item_key, title FROM f_sales_b "
    "UNION ALL SELECT '天猫超市', item_key, title FROM f_sales_c "
    f"UNION ALL SELECT {_PLATFORM}, item_key, title FROM f_sales_de) t GROUP BY platform, item_key), "
    "deduped AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY platform, source_key ORDER BY ai_result) AS rn "
    "FROM united) d WHERE rn = 1), "
    f"parsed AS (SELECT platform, source_key, ai_result, {_json('品牌')} AS brand, {_json('三级类目')} AS cat3, "
    f"{_json('四级类目')} AS cat4, {_json('类目编码')} AS cat_code, {_json('产品名称')} AS pname, {_json('配比')} AS formula, "
    f"{_json('规格')} AS spec FROM deduped), "
    "numbered AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY brand, cat_code ORDER BY platform, source_key) AS seq FROM parsed), "
    "master AS (SELECT COALESCE(brand, '') AS brand, COALESCE(cat3, '') AS cat3, COALESCE(cat4, '') AS cat4, "
    "COALESCE(pname, '') AS pname, COALESCE(upper(substr(brand, 1, 2)), 'XX') || '-PS-CL-' || COALESCE(cat_code, 'OL-OL') "
    "|| '-' || CASE WHEN seq < 10000 THEN lpad(CAST(seq AS VARCHAR), 4, '0') ELSE CAST(seq AS VARCHAR) END || '-' || "
    "CAST(CAST(trunc(COALESCE(TRY_CAST(spec AS DOUBLE), 0) * 1000) AS INT) AS VARCHAR) AS code, "
    "COALESCE(spec, '') AS spec, COALESCE(formula, '') AS formula, n.platform, n.source_key, "
    "CASE WHEN n.platform = '抖音' THEN n.source_key ELSE t.title END AS source_name, cat_code, ai_result "
    "FROM numbered n LEFT JOIN titles t ON n.platform = t.platform AND n.source_key = t.item_key)"
)
_MASTER_COLUMNS = (
    "brand AS \"品牌\", '宠物用品' AS \"一级类目\", '猫砂' AS \"二级类目\", cat3 AS \"三级类目\", cat4 AS \"四级类目\", "
    "pname AS \"产品名称\", code AS \"主数据\", spec AS \"规格\", formula AS \"配比\", platform AS \"数据来源平台\", "
    "source_key AS \"源数据主键\", source_name AS \"源数据商品名称\", cat_code AS \"类目编码\", ai_result AS ai_raw"
)

_NULL = "CAST(NULL AS DOUBLE)"
_B_PRICE, _B_VOLUME = _number("price"), _midpoint("volume_range")
_E_PRICE, _E_CONV = _midpoint("price_range"), _midpoint("conv_range")
_SALES_ROWS = (
    "sales_rows AS (SELECT '抖音' AS channel, item_key, sales, volume, CASE WHEN volume > 0 THEN "
    f"{_round('sales / volume', 2)} END AS price, {_NULL} AS traffic, {_NULL} AS conv, {_NULL} AS rank, '精确值' AS precision_tag "
    f"FROM (SELECT item_key, {_number('sales')} AS sales, {_number('volume')} AS volume FROM f_sales_a) a "
    f"UNION ALL SELECT '天猫', item_key, NULLIF(price, 0) * NULLIF(volume, 0), volume, price, {_NULL}, {_NULL}, {_NULL}, "
    f"'区间中位数估算' FROM (SELECT item_key, {_B_PRICE} AS price, {_B_VOLUME} AS volume FROM f_sales_b) b "
    f"UNION ALL SELECT '天猫超市', item_key, CAST(heat AS DOUBLE), CAST(popularity AS DOUBLE), {_NULL}, CAST(visits AS DOUBLE), "
    f"{_NULL}, {_NULL}, '指数值(非百分比)' FROM f_sales_c "
    f"UNION ALL SELECT {_PLATFORM}, item_key, {_midpoint('amount_range')}, {_midpoint('count_range')}, "
    f"CASE WHEN ({_E_PRICE}) < 5000 AND ({_E_PRICE}) <> 0 THEN {_E_PRICE} END, {_midpoint('visits_range')}, "
    f"CASE WHEN ({_E_CONV}) <= 100 THEN {_E_CONV} END, CAST(NULLIF(TRY_CAST(rank_no AS INT), 0) AS DOUBLE), '区间中位数' "
    "FROM f_sales_de)"
)
_SUMMARY = (
    f"{_MASTER}, {_SALES_ROWS}, summary AS (SELECT m.brand, m.cat3, m.cat4, m.cat_code, m.pname, m.code, m.spec, "
    "s.channel, s.sales, s.volume, s.price, s.traffic, s.conv, s.rank, s.precision_tag FROM sales_rows s "
    "JOIN master m ON m.platform = s.channel AND m.source_key = s.item_key)"
)
_SUMMARY_COLUMNS = (
    "brand AS \"品牌\", cat3 AS \"三级类目\", cat4 AS \"四级类目\", cat_code AS \"类目编码\", pname AS \"产品名称\", "
    "code AS \"主数据\", spec AS \"规格\", channel AS \"渠道\", sales AS \"销售额\", volume AS \"销量\", price AS \"件单价\", "
    "traffic AS \"浏览量\", conv AS \"转化率\", rank AS \"排名\", precision_tag AS \"数据精度\""
)
_TABLE_COUNTS = (
    "SELECT 'sales_0' AS table_name, COUNT(*) AS rows, FALSE AS missing FROM f_sales_a UNION ALL "
    "SELECT 'sales_1', COUNT(*), FALSE FROM f_sales_b UNION ALL SELECT 'sales_2', COUNT(*), FALSE FROM f_sales_c UNION ALL "
    "SELECT 'sales_3', COUNT(*), FALSE FROM f_sales_de WHERE region = 3 UNION ALL "
    "SELECT 'sales_4', COUNT(*), FALSE FROM f_sales_de WHERE region = 4 UNION ALL SELECT 'old_master', NULL, TRUE"
)


def _bands(x: str, edges: list[int]) -> str:
    lows = [0, *edges[:-1]]
    cases = " ".join(f"WHEN {x} < {high} THEN '{low}-{high}'" for low, high in zip(lows, edges))
    return f"CASE {cases} ELSE '{edges[-1]}+' END"


def _top(metric: str, alias: str, above: int) -> str:
    return (
        f"SELECT channel AS \"渠道\", brand AS \"品牌\", pname AS \"产品名称\", {metric} AS \"{alias}\" FROM summary "
        f"WHERE {metric} > {above} ORDER BY {metric} DESC, channel, code, pname LIMIT 10"
    )


_ALL_DUPLICATES = "SELECT channel, code, COUNT(*) AS cnt FROM summary GROUP BY channel, code HAVING COUNT(*) > 1"
_DUPLICATES = f"{_ALL_DUPLICATES} ORDER BY cnt DESC, channel, code LIMIT 5"
_METRICS = [("sales", "销售额"), ("volume", "销量"), ("price", "件单价"), ("traffic", "浏览量"), ("conv", "转化率"), ("rank", "排名")]
_NULL_ALIASES = ["n_sales", "n_vol", "n_price", "n_traffic", "n_conv", "n_rank"]
_AUDIT_BAND = _bands("price", [50, 100, 200, 500, 1000])


def _nulls(metric: str) -> str:
    return f"SUM(CASE WHEN {metric} IS NULL THEN 1 ELSE 0 END)"


_REPORT = (
    f"WITH {_SUMMARY} SELECT 'table_rows' AS \"check\", table_name AS subject, CAST(rows AS DOUBLE) AS value, missing AS is_issue "
    f"FROM ({_TABLE_COUNTS}) t "
    "UNION ALL SELECT 'price_anomaly', concat_ws('/', channel, brand, pname), price, TRUE FROM (SELECT * FROM summary "
    "WHERE price > 1000) p "
    "UNION ALL SELECT 'conversion_anomaly', concat_ws('/', channel, brand, pname), conv, TRUE FROM (SELECT * FROM summary "
    "WHERE conv > 100) c "
    "UNION ALL SELECT 'volume_distinct', '天猫', CAST(COUNT(DISTINCT volume) AS DOUBLE), COUNT(DISTINCT volume) = 1 FROM summary "
    "WHERE channel = '天猫' "
    f"UNION ALL SELECT 'empty_brand', channel, CAST(COUNT(*) AS DOUBLE), TRUE FROM summary WHERE NOT {_has('brand')} GROUP BY channel "
    + " ".join(
        f"UNION ALL SELECT 'negative', '{a}', CAST(COUNT(*) FILTER (WHERE {m} < 0) AS DOUBLE), COUNT(*) FILTER (WHERE {m} < 0) > 0 FROM summary"
        for m, a in _METRICS[:4]
    )
    + " "
    + " ".join(
        f"UNION ALL SELECT 'null_count', channel || '/{alias}', CAST({_nulls(m)} AS DOUBLE), FALSE FROM summary GROUP BY channel"
        for (m, _), alias in zip(_METRICS, _NULL_ALIASES)
    )
    + f" UNION ALL SELECT 'duplicate', channel || '/' || code, CAST(cnt AS DOUBLE), TRUE FROM ({_ALL_DUPLICATES}) d "
    f"UNION ALL SELECT 'price_band', {_AUDIT_BAND}, CAST(COUNT(*) AS DOUBLE), FALSE FROM summary WHERE channel = '京东自营' "
    "AND price IS NOT NULL GROUP BY 2 "
    + " ".join(
        f"UNION ALL SELECT 'master_gap', platform || '/{alias}', CAST(COUNT(*) FILTER (WHERE {test}) AS DOUBLE), FALSE FROM master GROUP BY platform"
        for alias, test in [("no_brand", f"NOT {_has('brand')}"), ("no_cat3", "cat3 = ''"), ("no_spec", "spec = ''")]
    )
    + " "
    + " ".join(
        f"UNION ALL SELECT 'unread_text', '京东自营/{a}', CAST(COUNT(*) FILTER (WHERE r.{text} <> '' AND s.{m} IS NULL) AS DOUBLE), FALSE "
        "FROM f_sales_de r JOIN master m ON r.item_key = m.source_key AND m.platform = '京东自营' "
        "JOIN summary s ON m.code = s.code AND s.channel = '京东自营' WHERE r.region = 3"
        for m, a, text in [("sales", "销售额", "amount_range"), ("volume", "销量", "count_range"), ("price", "件单价", "price_range")]
    )
)

_EVENT_COLUMNS = [
    ("event_id", "bigint"), ("ts", "timestamp_ntz"), ("user_id", "bigint"), ("event_type", "string"),
    ("value", "double"), ("props", "string"),
]
_PATH_EXT = "lower(regexp_extract(relative_path, '\\.([^.]*)$', 1))"
_RAW_COLUMNS = [
    ("item_key", "商品编号"), ("title", "商品名称"), ("rank_no", "排名"), ("amount_range", "成交金额"),
    ("count_range", "成交商品件数"), ("price_range", "成交客单价"), ("visits_range", "浏览量"), ("conv_range", "成交转化率"),
]
_OUT_COLUMNS = [
    ("brand", "品牌", "string"), ("cat3", "三级类目", "string"), ("cat4", "四级类目", "string"), ("cat_code", "类目编码", "string"),
    ("pname", "产品名称", "string"), ("code", "主数据", "string"), ("spec", "规格", "string"), ("channel", "渠道", "string"),
    ("sales", "销售额", "double"), ("volume", "销量", "double"), ("price", "件单价", "double"), ("traffic", "浏览量", "double"),
    ("conv", "转化率", "double"), ("rank", "排名", "double"), ("precision_tag", "数据精度", "string"),
]


def _format_rows() -> str:
    wanted = [("amount_range", "成交金额"), ("count_range", "成交商品件数"), ("visits_range", "浏览量"), ("conv_range", "成交转化率"), ("price_range", "成交客单价")]
    rows = " UNION ".join(
        f"SELECT '{a}' AS column_name, {c} AS value FROM f_sales_de WHERE region = 3 AND {c} IS NOT NULL AND {c} <> ''"
        for c, a in wanted
    )
    return (
        f"WITH {ctes('f_sales_de')} SELECT * FROM (SELECT column_name, value, CAST(ROW_NUMBER() OVER (PARTITION BY column_name "
        f"ORDER BY value) AS INT) AS position FROM ({rows}) u) r WHERE position <= 8"
    )


def _diff() -> str:
    raw = " UNION ALL ".join(
        f"SELECT '{a}' AS column_name, 'string' AS left_type, COUNT({c}) AS left_filled FROM f_sales_de WHERE region = 3"
        for c, a in _RAW_COLUMNS
    )
    out = " UNION ALL ".join(
        f"SELECT '{a}' AS column_name, '{t}' AS right_type, COUNT({c}) AS right_filled FROM summary" for c, a, t in _OUT_COLUMNS
    )
    return (
        f"WITH {_SUMMARY}, l AS ({raw}), r AS ({out}) SELECT COALESCE(l.column_name, r.column_name) AS column_name, left_type, "
        "right_type, CASE WHEN right_type IS NULL THEN 'only_left' WHEN left_type IS NULL THEN 'only_right' "
        "WHEN left_type <> right_type THEN 'type_differs' ELSE 'same' END AS status, left_filled, right_filled "
        "FROM l FULL OUTER JOIN r ON l.column_name = r.column_name"
    )


def _profile() -> str:
    columns = ", ".join(f"('column', {i}, '{n}', '{t}')" for i, (n, t) in enumerate(_EVENT_COLUMNS))
    shown = ", ".join(f"'{n}', COALESCE(CAST({n} AS VARCHAR), 'NULL')" for n, _ in _EVENT_COLUMNS)
    return (
        f"SELECT * FROM (VALUES {columns}) v(section, position, name, value) UNION ALL "
        "SELECT 'row_count', 0, '', CAST(COUNT(*) AS VARCHAR) FROM events UNION ALL "
        f"SELECT 'sample', CAST(ROW_NUMBER() OVER (ORDER BY event_id) AS INT), '', CAST(json_object({shown}) AS VARCHAR) "
        "FROM (SELECT * FROM events ORDER BY event_id LIMIT 5) s"
    )


def _readings() -> str:
    ranged = (
        ("销售额", "amount_range", _midpoint("amount_range")),
        ("销量", "count_range", _midpoint("count_range")),
        ("件单价", "price_range", f"CASE WHEN ({_E_PRICE}) < 5000 AND ({_E_PRICE}) <> 0 THEN {_E_PRICE} END"),
        ("浏览量", "visits_range", _midpoint("visits_range")),
        ("转化率", "conv_range", f"CASE WHEN ({_E_CONV}) <= 100 THEN {_E_CONV} END"),
    )
    rows = [f"SELECT {_PLATFORM} AS channel, item_key, '{m}' AS metric, {c} AS raw_text, {v} AS value FROM f_sales_de" for m, c, v in ranged]
    twice = "(SELECT * FROM f_sales_b UNION ALL SELECT * FROM f_sales_b WHERE item_key LIKE '%7') b"
    rows.append(f"SELECT '天猫', item_key, '销量', volume_range, {_B_VOLUME} FROM {twice}")
    return (
        f"WITH {_MASTER} SELECT r.channel, r.item_key AS source_key, r.metric, r.raw_text, r.value FROM ({' UNION ALL '.join(rows)}) r "
        "WHERE EXISTS (SELECT 1 FROM master m WHERE m.platform = r.channel AND m.source_key = r.item_key)"
    )


def _outcomes() -> str:
    text = (
        ("null_key", "SELECT COUNT(*) FROM fresh WHERE source IS NULL"),
        ("blank_text", f"SELECT COUNT(*) FROM fresh WHERE source IS NOT NULL AND {_blank('text')}"),
        ("duplicate", "SELECT COUNT(*) FROM cand WHERE rn > 1"),
        ("oversized", "SELECT COUNT(*) FROM req WHERE size > 6 * 1024 * 1024"),
        ("capped", "SELECT 0"),
        ("sent", "SELECT COUNT(*) FROM req"),
        ("quarantined", "SELECT 0"),
        ("failed", "SELECT COUNT(*) FROM req WHERE size > 6000"),
        ("written", "SELECT COUNT(*) FROM req WHERE size <= 6000"),
    )
    files = (
        ("no_url", "SELECT COUNT(*) FROM wanted WHERE url IS NULL"),
        ("unsupported", f"SELECT COUNT(*) FROM wanted WHERE url IS NOT NULL AND {_PATH_EXT} = 'mp3'"),
        ("oversized", "SELECT 0"),
        ("capped", "SELECT 0"),
        ("sent", "SELECT COUNT(*) FROM filereq"),
        ("quarantined", "SELECT 0"),
        ("failed", "SELECT COUNT(*) FROM filereq WHERE bytes > 6000"),
        ("written", "SELECT COUNT(*) FROM filereq WHERE bytes <= 6000"),
    )

    def rows(name: str, counts: tuple) -> str:
        once = " UNION ALL ".join(f"SELECT '{name}' AS source, '{o}' AS outcome, CAST(({c}) AS BIGINT) AS rows" for o, c in counts)
        return f"SELECT * FROM ({once}) UNION ALL SELECT source || ' again', outcome, CASE outcome WHEN 'written' THEN 0 ELSE rows END FROM ({once})"

    wanted = (
        f"wanted AS (SELECT f.relative_path, u.url FROM f_files f LEFT JOIN (SELECT * FROM f_url WHERE url <> '') u "
        f"ON f.relative_path = u.relative_path WHERE starts_with(f.relative_path, 'src') AND {_PATH_EXT.replace('relative_path', 'f.relative_path')} IN "
        "('jpg', 'png', 'mp3', 'mov') AND f.relative_path NOT IN (SELECT file_path FROM f_done_files))"
    )
    return f"SELECT * FROM (WITH {_ANSWERED} {rows('text', text)}) UNION ALL SELECT * FROM (WITH {_FILE_RUN}, {ctes('f_url')}, {wanted} {rows('files', files)})"


_UNIQUE = "COUNT(DISTINCT {c}) = COUNT(*)"

ORACLE = {
    "source_scan": (
        f"WITH {ctes('f_req')} SELECT CAST(doc_id AS VARCHAR) AS doc_id, COALESCE(source, '') AS source, COALESCE(text, '') AS text "
        "FROM f_req WHERE lang <> 'de' OR copy_no = 1"
    ),
    "file_listing": "SELECT DISTINCT 'source=' || source || '/lang=' || lang AS folder, TRUE AS has_bytes FROM documents",
    "file_tree": (
        "SELECT 'lang=' || lang || '/bucket=' || (doc_id % 50) AS folder, CAST(SUM(strlen(COALESCE(text, '')) + 1) AS BIGINT) AS size "
        "FROM documents WHERE starts_with(lang, 'e') GROUP BY 1"
    ),
    "file_inventory": (
        f"WITH {ctes('f_inventory')} SELECT relative_path, COALESCE(size, 0) AS size FROM f_inventory WHERE relative_path <> ''"
    ),
    "result_parse": f"WITH {_FLAT} SELECT * FROM flat",
    "result_success": f"WITH {_FLAT} SELECT custom_id, status_code FROM flat WHERE status_code = 200",
    "result_quarantine": (
        f"WITH {ctes('f_res')}, {_LINES} SELECT line, reason AS quarantine_reason FROM lines WHERE reason IS NOT NULL"
    ),
    "error_parse": f"WITH {_ERR} SELECT custom_id, error_code, error_message, raw FROM err",
    "sheet_normalise": (
        f"WITH {ctes('f_sheet')}, cells AS (SELECT row_no, " + ", ".join(f"COALESCE({_strip(c)}, '') AS {c}" for c in ("c0", "c1", "c2", "c3"))
        + " FROM f_sheet) SELECT c0 AS key, c1 AS brand, c2 AS col_2, c3 AS size FROM cells WHERE row_no > 0 AND c0 || c1 || c2 || c3 <> ''"
    ),
    "url_attach": (
        f"WITH {ctes('f_files', 'f_url')} SELECT f.relative_path, f.size, u.url AS presigned_url FROM f_files f JOIN f_url u "
        "ON f.relative_path = u.relative_path WHERE u.url <> ''"
    ),
    "url_skips": (
        f"WITH {ctes('f_url')} SELECT COUNT(*) FILTER (WHERE url <> '') AS resolved, "
        "COUNT(*) FILTER (WHERE COALESCE(url, '') = '') AS skipped FROM f_url"
    ),
    "source_profile": _profile(),
    "distinct_formats": _format_rows(),
    "incremental_rows": (
        f"WITH {ctes('f_req', 'f_tgt')} SELECT r.doc_id, r.source, r.lang, r.copy_no FROM f_req r LEFT JOIN f_tgt t "
        "ON r.doc_id = t.doc_id AND r.source = t.source WHERE t.doc_id IS NULL AND r.lang <> 'es'"
    ),
    "incremental_capped": (
        f"WITH {ctes('f_tgt')} SELECT d.doc_id, d.source FROM documents d LEFT JOIN f_tgt t ON d.doc_id = t.doc_id "
        "AND d.source = t.source WHERE t.doc_id IS NULL ORDER BY d.doc_id, d.source LIMIT 500"
    ),
    "incremental_files": (
        f"WITH {ctes('f_files', 'f_done_files')} SELECT relative_path, size FROM f_files WHERE {_PATH_EXT} IN ('jpg', 'png', 'mp4') "
        "AND starts_with(relative_path, 'src1') AND relative_path NOT IN (SELECT file_path FROM f_done_files)"
    ),
    "files_by_extension": (
        f"WITH {ctes('f_files')} SELECT relative_path, size FROM f_files WHERE {_PATH_EXT} IN ('jpg', 'png', 'mov')"
    ),
    "files_by_prefix": f"WITH {ctes('f_files')} SELECT relative_path, size FROM f_files WHERE starts_with(relative_path, 'src1')",
    "media_types": (
        f"WITH {ctes('f_files')} SELECT relative_path, size, CASE WHEN {_PATH_EXT} IN ('jpg', 'png', 'webp') THEN 'image' "
        f"WHEN {_PATH_EXT} IN ('mp4', 'mov') THEN 'video' WHEN {_PATH_EXT} = 'mp3' THEN 'audio' ELSE 'unknown' END AS media_type FROM f_files"
    ),
    "media_supported": (
        f"WITH {ctes('f_files')} SELECT relative_path, size FROM f_files WHERE {_PATH_EXT} IN ('jpg', 'png', 'webp', 'mp4', 'mov')"
    ),
    "file_type_histogram": (
        f"WITH {ctes('f_files')} SELECT CASE WHEN contains(relative_path, '.') THEN '.' || {_PATH_EXT} ELSE '(no ext)' END AS extension, "
        "COUNT(*) AS files FROM f_files GROUP BY 1"
    ),
    "request_build": f"WITH {_REQ} SELECT * FROM req",
    "request_ids": (
        "SELECT doc_id, 'req-' || url_encode(text) || '|' || CAST(doc_id AS VARCHAR) AS custom_id FROM documents"
    ),
    "key_roundtrip": "SELECT text, CAST(doc_id AS VARCHAR) AS doc_id, '' AS missing FROM documents",
    "skip_accounting": (
        f"WITH {_REQ}, counted AS (SELECT (SELECT COUNT(*) FROM f_req WHERE source IS NULL) AS null_key, "
        f"(SELECT COUNT(*) FROM f_req WHERE source IS NOT NULL AND {_blank('text')}) AS blank_text, "
        "(SELECT COUNT(*) FROM cand WHERE rn > 1) AS duplicate, "
        "(SELECT COUNT(*) FROM req WHERE strlen(request) > 20000) AS oversized, "
        "(SELECT COUNT(*) FROM req WHERE strlen(request) <= 20000) AS ready) "
        + " UNION ALL ".join(
            f"SELECT '{n}' AS outcome, {n} AS rows FROM counted" for n in ("null_key", "blank_text", "duplicate", "oversized", "ready")
        )
    ),
    "request_shards": f"WITH {_shards(40, 100_000, 50_000)}",
    "request_jsonl": f"WITH {_REQ} SELECT request AS line FROM req",
    "media_requests": _media(False, "", "m2", ""),
    "media_requests_audio": _media(
        True, "json_object('role', 'system', 'content', 'Be brief.'), ", "m3", ", 'enable_thinking', FALSE"
    ),
    "cost_estimate": (
        "SELECT COUNT(*) AS items, COUNT(*) * 200 AS estimated_tokens, COUNT(*) * 200 / 1000000.0 * 2.0 * 0.5 AS estimated_cost FROM documents"
    ),
    "plan_files": (
        f"WITH {ctes('f_files')}, t AS (SELECT CAST(COUNT(*) AS DOUBLE) AS n FROM f_files) "
        "SELECT 'total' AS section, 'file_count' AS name, n AS value FROM t UNION ALL "
        "SELECT 'total', 'estimated_tokens', n * 300 FROM t UNION ALL "
        "SELECT 'total', 'estimated_cost', n * 300 / 1000000 * 2.0 * 0.5 FROM t UNION ALL "
        f"SELECT 'extension', CASE WHEN contains(relative_path, '.') THEN '.' || {_PATH_EXT} ELSE '(no ext)' END, CAST(COUNT(*) AS DOUBLE) "
        "FROM f_files GROUP BY 2 UNION ALL "
        "SELECT 'sample', relative_path, CAST(size AS DOUBLE) FROM (SELECT * FROM f_files ORDER BY relative_path LIMIT 10) s"
    ),
    "plan_profile": (
        "WITH p AS (SELECT COUNT(*) AS n, " + ", ".join(
            f"COUNT(DISTINCT {c}) AS d_{c}" for c in ("doc_id", "text", "lang", "source", "n_chars")
        )
        + ", AVG(length(text)) AS t, AVG(length(lang)) AS l, AVG(length(source)) AS s FROM documents) "
        "SELECT 'doc_id' AS column_name, 'bigint' AS data_type, n AS row_count, CAST(NULL AS DOUBLE) AS mean_chars, "
        "d_doc_id = n AS key_candidate, FALSE AS text_candidate FROM p "
        "UNION ALL SELECT 'text', 'string', n, t, d_text = n, TRUE FROM p "
        "UNION ALL SELECT 'lang', 'string', n, l, d_lang = n, FALSE FROM p "
        "UNION ALL SELECT 'source', 'string', n, s, d_source = n, FALSE FROM p "
        "UNION ALL SELECT 'n_chars', 'bigint', n, NULL, d_n_chars = n, FALSE FROM p"
    ),
    "results_with_source": (
        f"WITH {_FLAT}, {_SENT} SELECT f.custom_id, f.content, COALESCE(s.source_text, '') AS source_text FROM flat f "
        "LEFT JOIN sent s ON f.custom_id = s.custom_id"
    ),
    "results_table": f"WITH {_AUDITED} SELECT * FROM audited",
    "file_results": (
        f"WITH {ctes('f_files', 'f_inventory')} SELECT f.relative_path AS file_path, 'my_vol' AS volume_name, "
        "COALESCE(i.size, 0) AS file_size, 'seen' AS ai_result, '' AS model, 'dashscope' AS provider, CAST(0 AS INT) AS prompt_tokens, "
        "CAST(0 AS INT) AS completion_tokens, CAST(0 AS INT) AS total_tokens, 'batch-8' AS batch_id, "
        "'2024-03-02T04:30:00+08:00' AS processed_at, CAST(200 AS INT) AS status_code, '' AS finish_reason, '' AS response_id, "
        "'Describe' AS source_text, '' AS raw_response FROM f_files f LEFT JOIN f_inventory i ON f.relative_path = i.relative_path"
    ),
    "error_histogram": f"WITH {_ERR} SELECT error_code, COUNT(*) AS errors FROM err GROUP BY error_code",
    "retry_plan": (
        f"WITH {_ERR}, p AS (SELECT *, {_RETRYABLE} AS retryable FROM err) SELECT custom_id, attempt, error_code, retryable, "
        "CASE WHEN retryable AND attempt < 5 THEN 'retry' ELSE 'dead_letter' END AS action, "
        "CASE WHEN retryable AND attempt < 5 THEN attempt + 1 END AS next_attempt, "
        "CASE WHEN retryable AND attempt < 5 THEN LEAST(CAST(2 * pow(2, attempt - 1) AS DOUBLE), 60.0) END AS next_delay FROM p"
    ),
    "failed_requests": (
        f"WITH {_ERR} SELECT err.custom_id, CASE WHEN {_RETRYABLE} AND attempt < 5 THEN 'retry' ELSE 'dead_letter' END AS action, "
        f"CASE WHEN NOT {_blank('e.props')} THEN " + _request_json("'req-' || e.event_id", "e.props")
        + " END AS request FROM err LEFT JOIN events e ON err.custom_id = 'req-' || e.event_id"
    ),
    "fenced_json": (
        f"WITH {ctes('f_fenced')} SELECT doc_id, '{{\"lang\":\"' || d.lang || '\"}}' AS answer, d.lang FROM f_fenced JOIN documents d USING (doc_id)"
    ),
    "target_schema": (
        f"WITH {ctes('f_tgt')} "
        + _columns("f_tgt", ["doc_id", "source", "ai_result", "batch_id"], [("doc_id", "bigint"), ("source", "string"), ("ai_result", "string"), *_METADATA])
    ),
    "file_target_schema": (
        f"WITH {ctes('f_done_files')}, done AS (SELECT file_path, quality AS ai_result FROM f_done_files) "
        + _columns("done", ["file_path", "ai_result"], [("file_path", "string"), ("volume_name", "string"), ("file_size", "bigint"), ("ai_result", "string"), *_METADATA])
    ),
    "schema_evolve": (
        f"WITH {_AUDITED}, {ctes('f_tgt')} SELECT doc_id, ai_result, NULL AS model, CAST(NULL AS INT) AS total_tokens, NULL AS batch_id FROM f_tgt "
        "UNION ALL SELECT CAST(doc_id AS BIGINT), ai_result, model, total_tokens, batch_id FROM audited"
    ),
    "schema_align": (
        f"WITH {ctes('f_sales_a')} SELECT item_key, CASE WHEN volume <> '8' THEN CAST(sales AS DOUBLE) END AS sales, "
        "COALESCE(CAST(NULLIF(volume, '') AS INT), 0) AS volume, volume = '8' AS cast_failed FROM f_sales_a"
    ),
    "results_table_roundtrip": f"WITH {_AUDITED} SELECT doc_id, ai_result, total_tokens, batch_id FROM audited",
    "idempotent_append": (
        f"WITH {ctes('f_tgt')} SELECT doc_id, source, ai_result, batch_id FROM f_tgt UNION ALL "
        "SELECT doc_id, source, lang, 'batch-' || (doc_id % 5) FROM documents WHERE 'batch-' || (doc_id % 5) NOT IN (SELECT batch_id FROM f_tgt)"
    ),
    "existing_batches": (
        f"WITH {ctes('f_jobs', 'f_tgt')} SELECT j.batch_id, COUNT(t.doc_id) AS existing_rows FROM (SELECT DISTINCT batch_id FROM f_jobs) j "
        "LEFT JOIN f_tgt t ON j.batch_id = t.batch_id GROUP BY j.batch_id"
    ),
    "raw_archive": (
        f"WITH {ctes('f_res', 'f_err')} SELECT 'batch-' || (doc_id % 3) AS batch_id, 'result' AS kind, COUNT(*) AS lines, "
        "CAST(SUM(strlen(line)) AS BIGINT) AS bytes FROM f_res GROUP BY 1 UNION ALL SELECT 'batch-0', 'error', COUNT(*), "
        "CAST(SUM(strlen(line)) AS BIGINT) FROM f_err"
    ),
    "job_ledger_latest": (
        f"WITH {ctes('f_jobs')} SELECT batch_id, status, event_id FROM f_jobs QUALIFY ROW_NUMBER() OVER "
        "(PARTITION BY batch_id ORDER BY updated_at DESC, event_id DESC) = 1"
    ),
    "job_status": (
        f"WITH {ctes('f_jobs')}, latest AS (SELECT * FROM f_jobs QUALIFY ROW_NUMBER() OVER (PARTITION BY batch_id "
        "ORDER BY updated_at DESC, event_id DESC) = 1) SELECT batch_id, status, total_requests, completed_requests, failed_requests, "
        "CASE WHEN total_requests > 0 THEN CAST(completed_requests + failed_requests AS DOUBLE) / total_requests * 100 END AS progress_pct, "
        "status IN ('completed', 'failed', 'expired', 'cancelled') AS ended FROM latest"
    ),
    "enrich_text": (
        f"WITH {_ANSWERED} SELECT doc_id, source, CAST(size AS VARCHAR) AS ai_result, 'm1' AS model, "
        "'dashscope' AS provider, CAST(1 AS INT) AS prompt_tokens, CAST(1 AS INT) AS completion_tokens, CAST(2 AS INT) AS total_tokens, "
        "'batch-9' AS batch_id, '2024-03-02T04:30:00+08:00' AS processed_at, CAST(200 AS INT) AS status_code, 'stop' AS finish_reason, "
        f"'q' AS response_id, source_text, {_answer_body('size')} AS raw_response FROM req WHERE size <= 6000"
    ),
    "enrich_files": (
        f"WITH {_FILE_RUN} SELECT relative_path AS file_path, 'my_vol' AS volume_name, size AS file_size, CAST(bytes AS VARCHAR) AS ai_result, "
        "'m1' AS model, 'zhipuai' AS provider, CAST(1 AS INT) AS prompt_tokens, CAST(1 AS INT) AS completion_tokens, "
        "CAST(2 AS INT) AS total_tokens, 'batch-10' AS batch_id, '2024-03-02T04:30:00+08:00' AS processed_at, CAST(200 AS INT) AS status_code, "
        f"'stop' AS finish_reason, 'q' AS response_id, 'Describe this file' AS source_text, {_answer_body('bytes')} AS raw_response FROM filereq"
    ),
    "run_stats": (
        f"WITH text_run AS (WITH {_ANSWERED} SELECT (SELECT COUNT(*) FROM fresh) AS source_rows, COUNT(*) FILTER (WHERE size <= 6000) AS success_count, "
        "COUNT(*) FILTER (WHERE size > 6000) AS error_count, COUNT(*) FILTER (WHERE size <= 6000) AS written_rows, "
        "'dashscope' AS provider, 'm1' AS model, 'batch-9' AS batch_id, 'completed' AS batch_status FROM req), "
        f"file_run AS (WITH {_FILE_RUN} SELECT (SELECT COUNT(*) FROM f_files WHERE starts_with(relative_path, 'src') "
        f"AND {_PATH_EXT} IN ('jpg', 'png', 'mp3', 'mov') AND relative_path NOT IN (SELECT file_path FROM f_done_files)) AS source_rows, "
        "COUNT(*) AS success_count, CAST(0 AS BIGINT) AS error_count, COUNT(*) AS written_rows, 'zhipuai' AS provider, 'm2' AS model, "
        "'batch-10' AS batch_id, 'completed' AS batch_status FROM filereq), "
        "both_runs AS (SELECT 'text' AS source, * FROM text_run UNION ALL SELECT 'files', * FROM file_run) "
        "SELECT * FROM both_runs UNION ALL SELECT 'total', CAST(SUM(source_rows) AS BIGINT), CAST(SUM(success_count) AS BIGINT), "
        "CAST(SUM(error_count) AS BIGINT), CAST(SUM(written_rows) AS BIGINT), NULL, NULL, NULL, NULL FROM both_runs"
    ),
    "run_outcomes": _outcomes(),
    "resume_batch": f"WITH {_AUDITED} SELECT * FROM audited",
    "preview_sample": (
        f"WITH {_REQ}, first AS (SELECT *, strlen(request) AS size FROM req ORDER BY doc_id, source LIMIT 5) SELECT custom_id, "
        "source_text AS input, CAST(size AS VARCHAR) AS output, CAST(2 AS INT) AS tokens, 'm1' AS model, 'table' AS source_type "
        "FROM first WHERE size <= 6000"
    ),
    "enriched_view": (
        f"WITH {ctes('f_tgt')} SELECT d.doc_id, d.lang, d.n_chars, t.ai_result, t.batch_id FROM documents d JOIN f_tgt t ON d.doc_id = t.doc_id"
    ),
    "stream_harvest": f"WITH {_AUDITED} SELECT doc_id, ai_result, status_code, total_tokens, processed_at FROM audited",
    "stream_incremental": (
        "SELECT DISTINCT user_id FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')"
    ),
    "stream_selection": (
        "SELECT DISTINCT user_id FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')"
    ),
    "stream_enriched": (
        f"WITH {ctes('f_tgt')} SELECT d.doc_id, d.lang, t.ai_result FROM documents d JOIN f_tgt t ON d.doc_id = t.doc_id"
    ),
    "union_channels": f"WITH {_UNION} SELECT * FROM united",
    "dedupe_master": (
        f"WITH {_UNION} SELECT platform, source_key, MIN(ai_result) AS ai_result FROM united GROUP BY platform, source_key"
    ),
    "llm_json_fields": (
        f"WITH {ctes('f_ai')} SELECT region, source_key, " + ", ".join(
            f"{_json(f)} AS \"{f}\"" for f in ("品牌", "三级类目", "四级类目", "类目编码", "产品名称", "配比", "规格")
        ) + " FROM f_ai"
    ),
    "product_master": f"WITH {_MASTER} SELECT {_MASTER_COLUMNS} FROM master",
    "sequence_sliced": (
        f"WITH {_MASTER} SELECT brand AS \"品牌\", cat_code AS \"类目编码\", platform, source_key, CAST(seq AS INT) AS seq FROM numbered"
    ),
    "channel_summary": f"WITH {_SUMMARY} SELECT {_SUMMARY_COLUMNS} FROM summary",
    "range_midpoints": (
        f"WITH {ctes('f_sales_de')} SELECT region, item_key, " + ", ".join(
            f"{_midpoint(c)} AS {c}" for c in ("amount_range", "count_range", "price_range", "visits_range", "conv_range")
        ) + " FROM f_sales_de"
    ),
    "range_rules": (
        f"WITH {ctes('f_sales_de')} SELECT region, item_key, CASE WHEN ({_E_PRICE}) < 5000 AND ({_E_PRICE}) <> 0 THEN {_E_PRICE} END AS \"件单价\", "
        f"CASE WHEN ({_E_CONV}) <= 100 THEN {_E_CONV} END AS \"转化率\", CAST(NULLIF(TRY_CAST(rank_no AS INT), 0) AS DOUBLE) AS \"排名\" FROM f_sales_de"
    ),
    "taxonomy_violations": (
        f"WITH {_MASTER}, {ctes('f_codes')} SELECT platform AS \"数据来源平台\", source_key AS \"源数据主键\", cat_code AS \"类目编码\" "
        "FROM master m WHERE NOT EXISTS (SELECT 1 FROM f_codes c WHERE c.code = m.cat_code)"
    ),
    "master_sample": (
        f"WITH {_MASTER} SELECT brand AS \"品牌\", cat3 AS \"三级类目\", cat4 AS \"四级类目\", pname AS \"产品名称\", code AS \"主数据\", "
        "spec AS \"规格\", formula AS \"配比\", platform AS \"数据来源平台\", source_key AS \"源数据主键\" FROM master "
        "WHERE brand <> '17-brand' ORDER BY platform, source_key LIMIT 5"
    ),
    "schema_diff": _diff(),
    "dq_table_counts": (
        f"WITH {_SUMMARY} {_TABLE_COUNTS} UNION ALL SELECT 'channel_summary', COUNT(*), FALSE FROM summary "
        "UNION ALL SELECT 'product_master', COUNT(*), FALSE FROM master"
    ),
    "dq_price_anomaly": f"WITH {_SUMMARY} {_top('price', '件单价', 100)}",
    "dq_conv_anomaly": f"WITH {_SUMMARY} {_top('conv', '转化率', 90)}",
    "dq_empty_brand": f"WITH {_SUMMARY} SELECT channel AS \"渠道\", COUNT(*) AS cnt FROM summary WHERE NOT {_has('brand')} GROUP BY channel",
    "dq_negative": (
        f"WITH {_SUMMARY}, shifted AS (SELECT sales, volume, price - 100 AS price, traffic FROM summary) " + " UNION ALL ".join(
            f"SELECT '{a}' AS metric, COUNT(*) FILTER (WHERE {m} < 0) AS negatives FROM shifted" for m, a in _METRICS[:4]
        )
    ),
    "dq_null_rates": (
        f"WITH {_SUMMARY} SELECT channel AS \"渠道\", COUNT(*) AS total, " + ", ".join(
            f"CAST({_nulls(m)} AS BIGINT) AS {alias}" for (m, _), alias in zip(_METRICS, _NULL_ALIASES)
        ) + " FROM summary GROUP BY channel"
    ),
    "dq_duplicates": f"WITH {_SUMMARY} SELECT channel AS \"渠道\", code AS \"主数据\", cnt FROM ({_DUPLICATES}) d",
    "dq_raw_vs_parsed": (
        f"WITH {_SUMMARY} SELECT r.title AS \"商品名称\", r.amount_range AS \"成交金额\", r.count_range AS \"成交商品件数\", "
        "r.price_range AS \"成交客单价\", s.sales AS \"销售额\", s.volume AS \"销量\", s.price AS \"件单价\" FROM f_sales_de r "
        "JOIN master m ON r.item_key = m.source_key AND m.platform = '京东自营' JOIN summary s ON m.code = s.code AND s.channel = '京东自营' "
        "WHERE r.region = 3"
    ),
    "dq_range_readings": _readings(),
    "dq_price_bands": (
        f"WITH {_SUMMARY} SELECT {_AUDIT_BAND} AS band, COUNT(*) AS cnt FROM summary WHERE channel = '京东自营' AND price IS NOT NULL GROUP BY 1"
    ),
    "dq_master": (
        f"WITH {_MASTER} SELECT platform AS \"数据来源平台\", COUNT(*) AS total, COUNT(*) FILTER (WHERE NOT {_has('brand')}) AS no_brand, "
        "COUNT(*) FILTER (WHERE cat3 = '') AS no_cat3, COUNT(*) FILTER (WHERE spec = '') AS no_spec FROM master GROUP BY platform"
    ),
    "dq_empty_columns": (
        f"WITH {_MASTER}, counted AS (" + " UNION ALL ".join(
            f"SELECT '{a}' AS column_name, COUNT(*) FILTER (WHERE NOT {_has(c)}) AS empty_rows FROM master"
            for c, a in (("brand", "品牌"), ("cat3", "三级类目"), ("cat_code", "类目编码"), ("pname", "产品名称"), ("formula", "配比"), ("spec", "规格"))
        ) + ") SELECT * FROM counted WHERE empty_rows > 0"
    ),
    "spec_histogram": (
        f"WITH {_MASTER} SELECT spec AS \"规格\", COUNT(*) AS cnt FROM master WHERE spec <> '' GROUP BY spec ORDER BY cnt DESC, spec LIMIT 15"
    ),
    "dq_report": _REPORT,
    "channel_counts": f"WITH {_SUMMARY} SELECT channel AS \"渠道\", COUNT(*) AS cnt FROM summary GROUP BY channel",
    "price_distribution": (
        f"WITH {_SUMMARY} SELECT channel AS \"渠道\", MIN(price) AS min_p, MAX(price) AS max_p, {_round('AVG(price)', 0)} AS avg_p, "
        f"COUNT(*) AS total, CAST({_nulls('price')} AS BIGINT) AS null_cnt FROM summary GROUP BY channel"
    ),
    "conversion_distribution": (
        f"WITH {_SUMMARY} SELECT channel AS \"渠道\", MIN(conv) AS min_c, MAX(conv) AS max_c, {_round('AVG(conv)', 1)} AS avg_c, "
        "COUNT(conv) AS has_cnt FROM summary GROUP BY channel"
    ),
    "volume_spread": (
        f"WITH {_SUMMARY} SELECT MIN(volume) AS min_v, MAX(volume) AS max_v, COUNT(DISTINCT volume) AS distinct_v, COUNT(*) AS total "
        "FROM summary WHERE channel = '天猫'"
    ),
    "brand_share": (
        f"WITH {_SUMMARY} SELECT brand AS \"品牌\", COUNT(*) AS sku_count, {_round('SUM(sales)', 2)} AS total_sales, "
        f"{_round('AVG(rank)', 1)} AS avg_rank, {_round('AVG(conv)', 1)} AS avg_conv FROM summary WHERE channel = '京东自营' AND {_has('brand')} "
        "AND sales > 0 GROUP BY brand ORDER BY total_sales DESC, brand LIMIT 15"
    ),
    "category_structure": (
        f"WITH {_SUMMARY} SELECT cat3 AS \"三级类目\", cat4 AS \"四级类目\", cat_code AS \"类目编码\", COUNT(*) AS sku_count, "
        + _round("SUM(CASE WHEN channel = '京东自营' THEN sales ELSE 0 END)", 2) + " AS jd_sales, "
        + _round("SUM(CASE WHEN channel = '抖音' THEN sales ELSE 0 END)", 2) + " AS dy_sales FROM summary "
        f"WHERE {_has('brand')} GROUP BY cat3, cat4, cat_code ORDER BY jd_sales DESC NULLS LAST, cat3, cat4, cat_code LIMIT 10"
    ),
    "brand_vs_peers": (
        f"WITH {_SUMMARY}, named AS (SELECT * FROM (VALUES ('17-brand'), ('4-brand'), ('25-brand'), ('9-brand'), ('absent-brand')) v(brand)), "
        f"stats AS (SELECT brand, COUNT(*) AS skus, {_round('SUM(sales)', 2)} AS sales, {_round('AVG(rank)', 1)} AS rank, "
        f"{_round('AVG(price)', 0)} AS price, {_round('AVG(conv)', 1)} AS conv FROM summary WHERE channel = '京东自营' GROUP BY brand) "
        "SELECT n.brand AS \"品牌\", skus, sales, rank, price, conv, skus IS NOT NULL AS found FROM named n LEFT JOIN stats s ON n.brand = s.brand"
    ),
    "brand_cross_channel": (
        f"WITH {_SUMMARY} SELECT channel AS \"渠道\", COUNT(*) AS skus, {_round('SUM(sales)', 2)} AS sales, {_round('AVG(volume)', 0)} AS avg_vol, "
        f"{_round('AVG(price)', 0)} AS avg_price FROM summary WHERE brand = '17-brand' GROUP BY channel"
    ),
    "price_bands": (
        f"WITH {_SUMMARY} SELECT {_bands('price', [50, 100, 200, 300])} AS price_band, COUNT(*) AS sku_count, {_round('SUM(sales)', 2)} AS total_sales, "
        f"{_round('AVG(conv)', 1)} AS avg_conv, MIN(price) AS min_price FROM summary WHERE channel = '京东自营' AND price > 0 GROUP BY 1"
    ),
    "top_sellers": (
        f"WITH {_SUMMARY} SELECT brand AS \"品牌\", pname AS \"产品名称\", sales AS \"销售额\", volume AS \"销量\" FROM summary "
        "WHERE channel = '抖音' AND sales > 100000 ORDER BY sales DESC, code, pname LIMIT 10"
    ),
    "high_conversion": (
        f"WITH {_SUMMARY} SELECT brand AS \"品牌\", pname AS \"产品名称\", channel AS \"渠道\", conv AS \"转化率\", rank AS \"排名\", sales AS \"销售额\" "
        "FROM summary WHERE conv > 15 AND channel IN ('京东自营', '京东POP') ORDER BY conv DESC, channel, code, rank NULLS FIRST LIMIT 10"
    ),
    "top_brand_channels": (
        f"WITH {_SUMMARY}, kept AS (SELECT * FROM summary WHERE {_has('brand')} AND sales IS NOT NULL), leaders AS (SELECT brand FROM kept "
        f"GROUP BY brand ORDER BY {_round('SUM(sales)', 2)} DESC, brand LIMIT 10) SELECT brand AS \"品牌\", channel AS \"渠道\", "
        f"{_round('SUM(sales)', 2)} AS sales, COUNT(*) AS skus, {_round('AVG(price)', 0)} AS avg_price FROM kept "
        "WHERE brand IN (SELECT brand FROM leaders) GROUP BY brand, channel"
    ),
}
