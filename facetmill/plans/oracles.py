"""The same results in SQL, for checking on the test tables."""

from __future__ import annotations

_TARGETS = ["mana_cost", "type_line", "oracle_text", "bottomright_value"]
_DISPLAY = ["name", "image_link"]


def _trim(expr: str) -> str:
    return f"nullif(regexp_replace({expr}, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g'), '')"


def _clean(expr: str) -> str:
    return f"regexp_replace(replace({expr}, chr(10), ' '), '\\(.*?\\)', '', 'g')"


# One line per record, front and back values side by side.
_RECORDS = """
records AS (
  SELECT
    l_orderkey || '-' || l_linenumber AS oracle_id,
    l_orderkey, l_linenumber, l_quantity,
    l_returnflag = 'R' AS two_faced,
    CASE WHEN l_returnflag = 'R' THEN p_name || ' // ' || p_brand ELSE p_name END AS card_name,
    p_name AS front_name,
    '{' || l_linenumber || '}' AS front_mana_cost,
    p_type || ' ' || p_brand AS front_type_line,
    CASE WHEN p_size < 5 THEN ' (plain) '
      ELSE p_name || chr(10) || 'Gain (' || l_returnflag || ') ' || l_linestatus
        || CASE WHEN l_linenumber > 4 THEN ' (reminder' || chr(10) || 'text)' ELSE '' END
    END AS front_oracle_text,
    CASE WHEN l_linestatus = 'F' THEN CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS front_power,
    CASE WHEN l_returnflag <> 'N' THEN CAST(p_size AS VARCHAR) END AS front_toughness,
    CASE WHEN l_returnflag = 'N' THEN CAST(p_size AS VARCHAR) END AS front_loyalty,
    CASE WHEN l_discount >= 0.05 THEN CAST(p_size AS VARCHAR) END AS front_defense,
    'https://img.example.com/front/' || l_partkey || '.jpg' AS front_image_link,
    p_brand AS back_name,
    CASE WHEN l_linenumber > 3 THEN '{' || p_size || '}' END AS back_mana_cost,
    p_brand || ' ' || l_linestatus AS back_type_line,
    'Back of' || chr(10) || p_name || ' (see front)' AS back_oracle_text,
    CAST(NULL AS VARCHAR) AS back_power,
    CAST(l_linenumber AS VARCHAR) AS back_toughness,
    CASE WHEN l_linenumber <> 2 THEN CAST(l_linenumber AS VARCHAR) END AS back_loyalty,
    CAST(NULL AS VARCHAR) AS back_defense,
    'https://img.example.com/back/' || l_partkey || '.jpg' AS back_image_link,
    CASE WHEN o_orderstatus = 'F' THEN CAST(CAST(l_discount * 100 AS DECIMAL(12,2)) AS VARCHAR) END AS usd,
    CASE WHEN o_orderstatus = 'O' THEN CAST(CAST(l_tax * 100 AS DECIMAL(12,2)) AS VARCHAR) END AS usd_foil,
    CAST(o_orderdate AS DATE) AS released_at,
    l_tax > 0.02 AS reprint,
    o_orderpriority = '5-LOW' AS digital,
    CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'not_legal' ELSE 'legal' END AS legacy
  FROM lineitem
  LEFT JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN part ON l_partkey = p_partkey
)"""

_FACE_FIELDS = ["name", "image_link", "mana_cost", "type_line", "oracle_text", "power", "toughness", "loyalty", "defense"]


def _side(side: str, number: int, where: str) -> str:
    fields = ", ".join(f"{side}_{c} AS {c}" for c in _FACE_FIELDS)
    return f"SELECT oracle_id, '{number}' AS card_face_number, {fields}, usd, usd_foil FROM records WHERE {where}"


_FACES = f"""
faces AS (
  {_side('front', 0, 'true')}
  UNION ALL
  {_side('back', 1, 'two_faced')}
)"""

_SILVER_RAW = f"""
silver_raw AS (
  SELECT oracle_id, card_face_number, name, image_link, mana_cost, type_line,
    {_clean('oracle_text')} AS oracle_text,
    CASE WHEN power IS NOT NULL AND toughness IS NOT NULL THEN power || '/' || toughness
      WHEN loyalty IS NOT NULL THEN loyalty
      WHEN defense IS NOT NULL THEN defense END AS bottomright_value,
    CASE WHEN usd IS NOT NULL THEN usd ELSE usd_foil END AS price
  FROM faces
)"""

_SILVER_ALL = ["oracle_id", *_DISPLAY, "card_face_number", *_TARGETS, "price"]
_SILVER = f"""
silver AS (
  SELECT {', '.join(f'{_trim(c)} AS {c}' for c in _SILVER_ALL)} FROM silver_raw
)"""


def _targets(mode: str) -> list[str]:
    return (_DISPLAY if mode == "predict" else []) + _TARGETS


def _pivot(mode: str, source: str = "silver") -> str:
    """First row by value of every item and face, spread to columns."""
    columns = [*_targets(mode), "price"]
    order = ", ".join(f"{c} NULLS FIRST" for c in columns)
    front = ", ".join(f"max(CASE WHEN card_face_number = '0' THEN {c} END) AS {c}" for c in columns)
    back = ", ".join(f"max(CASE WHEN card_face_number = '1' THEN {c} END) AS second_{c}" for c in _targets(mode))
    return f"""
  SELECT oracle_id, {front}, {back}
  FROM (
    SELECT *, row_number() OVER (PARTITION BY oracle_id, card_face_number ORDER BY {order}) AS rn
    FROM {source}
  )
  WHERE rn = 1
  GROUP BY oracle_id"""


def _filled(mode: str) -> str:
    """Gold columns with the null token, over a relation ``wide``."""
    text = [*_TARGETS, *[f"second_{c}" for c in _TARGETS]]
    kept = ["oracle_id", "price"]
    if mode == "predict":
        kept += [*_DISPLAY, *[f"second_{c}" for c in _DISPLAY]]
    return f"SELECT {', '.join(kept)}, {', '.join(f'''coalesce({c}, '[Null]') AS {c}''' for c in text)} FROM wide"


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


_BASE = _with(_RECORDS, _FACES)
_TO_SILVER = _with(_RECORDS, _FACES, _SILVER_RAW, _SILVER)


def _gold_ctes(mode: str) -> str:
    return f"{_TO_SILVER}, wide AS ({_pivot(mode)}), gold AS ({_filled(mode)})"


_ROW_TEXT = "concat_ws(' ', " + ", ".join(
    f"coalesce({c}, 'None')" for c in [*_TARGETS, *[f"second_{c}" for c in _TARGETS]]
) + ")"
_BUCKET = "CASE WHEN TRY_CAST(price AS FLOAT) >= 3.0 THEN 1 ELSE 0 END"


_TOKENS = """
words AS (
  SELECT * FROM (
    SELECT doc_id, unnest(list) AS token, generate_subscripts(list, 1) AS pos
    FROM (SELECT doc_id, string_split_regex(lower(text), '[\\x09-\\x0D ]+') AS list FROM documents)
  ) WHERE token <> ''
),
vocabulary AS (
  SELECT token, n, CAST(row_number() OVER (ORDER BY n DESC, token) + 1 AS INTEGER) AS token_id
  FROM (SELECT token, count(*) AS n FROM words GROUP BY token)
)"""


def _page_ends(pages: str) -> str:
    return f"""
ends AS (
  SELECT request_id,
    min(CASE WHEN object = 'error' OR NOT has_data THEN page_no - 1
             WHEN NOT coalesce(has_more, false) THEN page_no END) AS last_page,
    min(CASE WHEN object = 'error' OR NOT has_data OR NOT coalesce(has_more, false) THEN page_no END) AS stop_page
  FROM {pages} GROUP BY request_id
)"""


_CONVERSATION_PAGES = """
pages_in AS (
  SELECT CAST(conv_id AS VARCHAR) AS request_id, CAST(turn AS INTEGER) AS page_no, role, CAST(length(text) AS INTEGER) AS chars,
    CASE WHEN role = 'assistant' AND length(text) > 1500 THEN 'error' ELSE 'list' END AS object,
    length(text) >= 30 AS has_data,
    CASE WHEN role = 'assistant' AND length(text) < 600 THEN false
         WHEN role <> 'assistant' OR length(text) < 1200 THEN true END AS has_more
  FROM conversations
)"""

_RECORD_PAGES = """
pages_in AS (
  SELECT *, CAST(l_orderkey AS VARCHAR) AS request_id, l_linenumber AS page_no,
    CASE WHEN l_quantity > 49 THEN 'error' ELSE 'list' END AS object,
    l_quantity > 2 AS has_data,
    l_linenumber < 7 AS has_more
  FROM records
)"""

_PREDICT_COHORT = "NOT reprint AND NOT digital AND released_at > DATE '2001-08-01' - 30"
_TRAIN_COHORT = (
    "legacy = 'legal' AND year(released_at) >= 1996 AND TRY_CAST(usd AS DOUBLE) > 0 "
    "AND released_at < DATE '2001-08-01' - 365"
)
# A nested record as plain columns.
_FLAT_RECORD = (
    "oracle_id, card_name AS name, CASE WHEN NOT two_faced THEN front_oracle_text END AS oracle_text, "
    "usd, usd_foil, released_at, CASE WHEN two_faced THEN 2 END AS n_faces, "
    "CASE WHEN two_faced THEN back_image_link END AS back_image"
)
_STATS = ["mana_cost", "type_line", "oracle_text", "power", "toughness", "loyalty", "defense"]


def _face_rows(side: str, number: int, where: str) -> str:
    fields = ", ".join(f"{side}_{c} AS {c}" for c in _STATS)
    return (
        f"{_with(_RECORDS)} SELECT oracle_id, '{number}' AS card_face_number, {fields}, usd, usd_foil "
        f"FROM records WHERE {where}"
    )


_SCORED = """
scored AS (
  SELECT doc_id, CASE WHEN length(text) >= 1000 THEN 'Above_3' ELSE 'Below_3' END AS label,
    CAST(CASE WHEN length(text) >= 1000 THEN 0.75 ELSE 0.5 END AS DOUBLE) AS score
  FROM documents
)"""

_LINE_VALUES = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount"]

_CONVERSATION_FACES = """
silver AS (
  SELECT CAST(conv_id AS VARCHAR) AS oracle_id, CAST(turn AS VARCHAR) AS card_face_number, role AS mana_cost,
    CAST(length(text) AS VARCHAR) AS type_line, text AS oracle_text, CAST(NULL AS VARCHAR) AS bottomright_value,
    CAST(length(text) / 100.0 > 3 AS VARCHAR) AS price
  FROM conversations
)"""

# Two turns in a row as the faces of an item.
_PAIRED_TURNS = _CONVERSATION_FACES.replace(
    "CAST(conv_id AS VARCHAR) AS oracle_id, CAST(turn AS VARCHAR) AS card_face_number",
    "conv_id || '-' || turn // 2 AS oracle_id, CAST(turn % 2 AS VARCHAR) AS card_face_number",
)

_JOINED_STATUS = """
  SELECT card, status, o_totalprice, l_suppkey, l_linenumber
  FROM (SELECT o_orderkey AS card, o_orderstatus AS status, o_totalprice FROM orders)
  FULL OUTER JOIN (SELECT l_orderkey AS card, l_linestatus AS status, l_suppkey, l_linenumber FROM lineitem)
  USING (card, status)"""

_DOCUMENT_LABELS = """
judged AS (
  SELECT quality AS label, n_chars / (n_chars + 2000.0) AS probability FROM labels JOIN documents USING (doc_id)
)"""


def _silver(mode: str) -> str:
    columns = ["oracle_id", *(_DISPLAY if mode == "predict" else []), "card_face_number", *_TARGETS, "price"]
    return f"{_TO_SILVER} SELECT {', '.join(columns)} FROM silver"


ORACLE_SQL: dict[str, str] = {
    # sources and sinks
    "json_field": "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events",
    "json_round_trip": f"{_with(_RECORDS)} SELECT {_FLAT_RECORD} FROM records",
    "csv_normalise": f"SELECT doc_id, {_trim(_clean('text'))} AS text FROM documents",
    "csv_round_trip": f"SELECT CAST(doc_id AS VARCHAR) AS doc_id, {_trim(_clean('text'))} AS text, lang FROM documents",
    "run_identifier": "SELECT event_id, strftime(ts, '%y%m%d%H%M%S') AS identifier FROM events",
    "latest_run": "SELECT event_type AS mode, arg_max(strftime(ts, '%y%m%d%H%M%S'), ts) AS identifier "
    "FROM events GROUP BY event_type",
    "latest_model_run": "SELECT event_type AS experiment, arg_max(CAST(event_id AS VARCHAR), ts) AS run_id, "
    "arg_max('models/' || event_id, ts) AS model_path FROM events GROUP BY event_type",
    "flatten_pages": f"{_with(_CONVERSATION_PAGES, _page_ends('pages_in'))} "
    "SELECT request_id, page_no, role, unnest([chars, chars + 1]) AS chars FROM pages_in JOIN ends USING (request_id) "
    "WHERE object <> 'error' AND has_data AND page_no <= coalesce(last_page, page_no)",
    "page_status": f"{_with(_CONVERSATION_PAGES, _page_ends('pages_in'))} "
    "SELECT ends.request_id, CASE WHEN stop_page IS NULL THEN 'open' WHEN object = 'error' THEN 'error' "
    "WHEN NOT has_data THEN 'invalid' ELSE 'complete' END AS status, last_page "
    "FROM ends LEFT JOIN pages_in ON ends.request_id = pages_in.request_id AND page_no = stop_page",
    "cohort_predict": f"{_with(_RECORDS)} SELECT oracle_id, card_name AS name, released_at FROM records WHERE {_PREDICT_COHORT}",
    "cohort_train": f"{_with(_RECORDS)} SELECT oracle_id, usd, released_at FROM records WHERE {_TRAIN_COHORT}",
    "cohort_test": f"{_with(_RECORDS)} SELECT oracle_id, card_name AS name FROM records "
    "WHERE contains(lower(card_name), 'ring')",
    # projections and generators
    "split_single": _face_rows("front", 0, "NOT two_faced"),
    "split_multi": f"{_face_rows('front', 0, 'two_faced')} UNION ALL "
    + _face_rows("back", 1, "two_faced").removeprefix(_with(_RECORDS)),
    "nested_fields": f"{_with(_RECORDS)} SELECT oracle_id, usd, usd_foil, "
    "CASE WHEN NOT two_faced THEN front_image_link END AS image_link, "
    "CASE WHEN two_faced THEN back_name END AS second_name FROM records",
    "select_or_null": "SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(NULL AS VARCHAR) AS loyalty, "
    "l_returnflag, CAST(NULL AS VARCHAR) AS defense FROM lineitem",
    "flat_cards": f"{_with(_RECORDS)} SELECT oracle_id, '0' AS card_face_number, "
    + ", ".join(f"CASE WHEN NOT two_faced THEN front_{c} END AS {c}" for c in _STATS)
    + ", usd, usd_foil FROM records",
    "explode_faces": f"{_with(_RECORDS)} SELECT oracle_id, 0 AS card_face_number, front_name AS name, usd, usd_foil "
    "FROM records WHERE two_faced UNION ALL "
    "SELECT oracle_id, 1, back_name, usd, usd_foil FROM records WHERE two_faced",
    # joins
    "faces_union": f"{_BASE} SELECT oracle_id, card_face_number, {', '.join(_STATS)}, usd, usd_foil FROM faces",
    "faces_one_pass": f"{_BASE} SELECT oracle_id, name, image_link, card_face_number, {', '.join(_STATS)}, usd, usd_foil "
    "FROM faces",
    "faces_outer_join": f"{_BASE} SELECT oracle_id, card_face_number, {', '.join(_STATS)}, usd, usd_foil FROM faces",
    "full_outer_using": _JOINED_STATUS,
    # aggregations
    "distinct_faces": f"{_BASE} SELECT DISTINCT card_face_number FROM faces",
    "first_by_order": "SELECT l_orderkey, l_linenumber, "
    + ", ".join(_LINE_VALUES)
    + " FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, "
    + ", ".join(_LINE_VALUES)
    + ") AS rn FROM lineitem) WHERE rn = 1",
    "pivot_faces": f"{_with(_PAIRED_TURNS)} {_pivot('train')}",
    "gold_auto_pivot": f"{_with(_PAIRED_TURNS)}, wide AS ({_pivot('train')}) {_filled('train')}",
    "gold_auto_pad": f"{_with(_CONVERSATION_FACES)}, wide AS (SELECT oracle_id, {', '.join(_TARGETS)}, "
    + ", ".join(f"CAST(NULL AS VARCHAR) AS second_{c}" for c in _TARGETS)
    + f", price FROM silver) {_filled('train')}",
    "pad_second_face": f"{_with(_CONVERSATION_FACES)} SELECT oracle_id, {', '.join(_TARGETS)}, "
    + ", ".join(f"CAST(NULL AS VARCHAR) AS second_{c}" for c in _TARGETS)
    + ", price FROM silver",
    "null_token": f"{_with(_PAIRED_TURNS)}, wide AS ({_pivot('train')}) {_filled('train')}",
    # scalar functions
    "strip_newlines": "SELECT doc_id, replace(text, chr(10), ' ') AS text FROM documents",
    "strip_parenthetical": f"SELECT doc_id, {_clean('text')} AS text FROM documents",
    "corner_value": f"{_with(_RECORDS, _FACES, _SILVER_RAW)} SELECT oracle_id, card_face_number, bottomright_value FROM silver_raw",
    "price_fallback": f"{_with(_RECORDS, _FACES, _SILVER_RAW)} SELECT oracle_id, card_face_number, price FROM silver_raw",
    "price_bucket": "SELECT event_id, CASE WHEN CAST(value AS FLOAT) >= 3.0 THEN 1 ELSE 0 END AS price FROM events",
    "label_name": "SELECT event_id, CASE WHEN CAST(value AS FLOAT) >= 3.0 THEN 'Above_3' ELSE 'Below_3' END AS label, "
    "CASE WHEN CAST(value AS FLOAT) >= 3.0 THEN 1 ELSE 0 END AS label_id FROM events",
    "row_text": f"{_TO_SILVER}, wide AS ({_pivot('train')}) SELECT oracle_id, {_ROW_TEXT} AS gameplay_text FROM wide",
    "score_unpack": "SELECT event_id, event_type AS label, value AS score FROM events",
    # features and model
    "training_set": f"{_gold_ctes('train')} SELECT {_ROW_TEXT} AS gameplay_text, {_BUCKET} AS price FROM gold",
    "token_vocab": f"{_with(_TOKENS)} SELECT token, n, token_id FROM vocabulary",
    "encoded_tokens": f"{_with(_TOKENS)}, ids AS (SELECT doc_id, count(*) AS n, "
    "string_agg(CAST(coalesce(token_id, 1) AS VARCHAR), ' ' ORDER BY pos) AS ids "
    "FROM words LEFT JOIN vocabulary USING (token) GROUP BY doc_id) "
    "SELECT doc_id, trim(coalesce(ids, '') || repeat(' 0', greatest(194 - coalesce(n, 0), 0))) AS input_ids, "
    "trim(repeat('1 ', coalesce(n, 0)) || repeat('0 ', greatest(194 - coalesce(n, 0), 0))) AS attention_mask "
    "FROM documents LEFT JOIN ids USING (doc_id)",
    "encoded_training": f"{_gold_ctes('train')}, texts AS (SELECT row_number() OVER () AS doc_id, {_ROW_TEXT} AS text, "
    f"{_BUCKET} AS label FROM gold), {_TOKENS.replace('FROM documents', 'FROM texts')}, "
    "ids AS (SELECT doc_id, count(*) AS n, string_agg(CAST(token_id AS VARCHAR), ' ' ORDER BY pos) AS ids "
    "FROM words JOIN vocabulary USING (token) GROUP BY doc_id) "
    "SELECT ids || repeat(' 0', greatest(32 - n, 0)) AS input_ids, "
    "trim(repeat('1 ', n) || repeat('0 ', greatest(32 - n, 0))) AS attention_mask, label FROM ids JOIN texts USING (doc_id)",
    "hash_split": "SELECT event_id, CASE WHEN substring(md5(CAST(event_id AS VARCHAR)), 1, 8) < '33333333' "
    "THEN 'test' ELSE 'train' END AS part FROM events",
    "eval_log_loss": f"{_with(_DOCUMENT_LABELS)} SELECT round(avg(-ln(CASE WHEN label = 1 THEN probability "
    "ELSE 1 - probability END)), 6) AS eval_loss FROM judged",
    "eval_confusion": f"{_with(_DOCUMENT_LABELS)} SELECT label, CASE WHEN probability >= 0.5 THEN 1 ELSE 0 END AS predicted, "
    "count(*) AS n FROM judged GROUP BY 1, 2",
    "udf_scorer": f"{_with(_SCORED)} SELECT doc_id, label, score FROM scored",
    "result_projection": f"{_gold_ctes('predict')} SELECT oracle_id, name, image_link, "
    f"CASE WHEN length({_ROW_TEXT}) >= 110 THEN 'Above_3' ELSE 'Below_3' END AS label, "
    f"CASE WHEN length({_ROW_TEXT}) >= 110 THEN '0.75' ELSE '0.5' END AS score, price FROM gold",
    # jobs
    "e2e_bronze": f"{_with(_RECORDS, _RECORD_PAGES, _page_ends('pages_in'))} SELECT {_FLAT_RECORD} "
    "FROM pages_in JOIN ends USING (request_id) "
    f"WHERE object <> 'error' AND has_data AND page_no <= coalesce(last_page, page_no) AND {_TRAIN_COHORT}",
    "e2e_silver": _silver("train"),
    "e2e_silver_predict": _silver("predict"),
    "e2e_gold": f"{_TO_SILVER}, wide AS ({_pivot('train')}) {_filled('train')}",
    "e2e_gold_predict": f"{_TO_SILVER}, wide AS ({_pivot('predict')}) {_filled('predict')}",
}
ORACLE_SQL["e2e_gold_text"] = ORACLE_SQL["e2e_gold"]
ORACLE_SQL["e2e_gold_bucketed"] = ORACLE_SQL["e2e_gold"]
_EVENT_LINE = """'{"event_id":' || event_id || ',"props":' || props || '}'"""
ORACLE_SQL["json_malformed"] = f"""SELECT CASE WHEN event_id % 11 <> 3 THEN event_id END AS event_id,
  CASE WHEN event_id % 11 <> 3 THEN CAST(json_extract_string(props, '$.k') AS INTEGER) END AS k,
  CASE WHEN event_id % 11 = 3 THEN left({_EVENT_LINE}, length({_EVENT_LINE}) - 2) END AS line FROM events"""
_RECORDED = """WITH log AS (SELECT event_type AS mode, strftime(date_trunc('day', ts), '%y%m%d%H%M%S') AS identifier,
  ['bronze', 'silver', 'gold'][user_id % 3 + 1] AS step, ['started', 'complete', 'failed'][event_id % 3 + 1] AS state, ts FROM events)"""
ORACLE_SQL["run_states"] = f"""{_RECORDED} SELECT mode, identifier, step, state FROM log
  QUALIFY row_number() OVER (PARTITION BY mode, identifier, step ORDER BY ts DESC, state DESC) = 1"""
ORACLE_SQL["current_runs"] = f"{_RECORDED} SELECT mode, step, max(identifier) AS identifier FROM log WHERE state = 'complete' GROUP BY 1, 2"
ORACLE_SQL["e2e_predict_scorer"] = ORACLE_SQL["result_projection"]

_COUNTED = f"object <> 'error' AND has_data AND page_no <= coalesce(last_page, page_no) AND {_TRAIN_COHORT}"
_ENDED = f"{_with(_RECORDS, _RECORD_PAGES, _page_ends('pages_in'))}"
ORACLE_SQL["bronze_status"] = f"""{_ENDED},
  counts AS (SELECT request_id, count(*) AS pages, count_if(page_no IS NULL) AS unnumbered_pages FROM pages_in GROUP BY request_id),
  stops AS (
    SELECT request_id, page_no, min(CASE WHEN object = 'error' THEN 'error' WHEN NOT has_data THEN 'invalid' ELSE 'z' END) AS why
    FROM pages_in WHERE object = 'error' OR NOT has_data OR NOT has_more GROUP BY request_id, page_no)
  SELECT ends.request_id, CASE WHEN stop_page IS NULL THEN 'open' WHEN why = 'z' THEN 'complete' ELSE why END AS status,
    last_page, pages, CAST(unnumbered_pages AS BIGINT) AS unnumbered_pages
  FROM ends JOIN counts USING (request_id)
  LEFT JOIN stops ON ends.request_id = stops.request_id AND stops.page_no = stop_page"""
# Every seventh line is no page; none of its fields can be read.
ORACLE_SQL["malformed_status"] = f"""{_with(_CONVERSATION_PAGES)},
  whole AS (SELECT * FROM pages_in WHERE (page_no + CAST(request_id AS INTEGER)) % 7 <> 0), {_page_ends('whole')},
  counts AS (SELECT request_id, count(*) AS pages FROM whole GROUP BY request_id),
  broken AS (SELECT count(*) AS quarantined FROM pages_in WHERE (page_no + CAST(request_id AS INTEGER)) % 7 = 0)
  SELECT ends.request_id, CASE WHEN stop_page IS NULL THEN 'open' WHEN object = 'error' THEN 'error' WHEN NOT has_data THEN 'invalid'
    ELSE 'complete' END AS status, last_page, pages, CAST(0 AS BIGINT) AS unnumbered_pages, quarantined
  FROM ends JOIN counts USING (request_id) LEFT JOIN whole ON ends.request_id = whole.request_id AND page_no = stop_page CROSS JOIN broken
  UNION ALL SELECT NULL, 'malformed', NULL, quarantined, quarantined, quarantined FROM broken WHERE quarantined > 0"""
ORACLE_SQL["silver_after_failed_load"] = f"""{_with(_RECORDS, _RECORD_PAGES, _page_ends('pages_in'))},
  {_FACES.replace("FROM records", "FROM pages_in JOIN ends USING (request_id)").replace("WHERE true", f"WHERE {_COUNTED}").replace("WHERE two_faced", f"WHERE two_faced AND {_COUNTED}")},
  {_SILVER_RAW}, {_SILVER} SELECT oracle_id, card_face_number, {', '.join(_TARGETS)}, price,
    true AS is_of_whole_load, CAST(1 AS BIGINT) AS complete, CAST(1 AS BIGINT) AS failed FROM silver"""
# Without an array of faces every record has one row, with what the record itself carries.
_BARE = [c for c in _STATS if c != "loyalty"]
ORACLE_SQL["e2e_silver_inferred"] = f"""{_with(_RECORDS)},
  faces AS (SELECT oracle_id, '0' AS card_face_number, CAST(NULL AS VARCHAR) AS name, CAST(NULL AS VARCHAR) AS image_link,
    {', '.join(f'CASE WHEN NOT two_faced THEN front_{c} END AS {c}' for c in _BARE)}, CAST(NULL AS VARCHAR) AS loyalty, usd, usd_foil FROM records),
  {_SILVER_RAW}, {_SILVER} SELECT oracle_id, card_face_number, {', '.join(_TARGETS)}, price FROM silver"""

# Labelled gold rows in the part that the reproducible split leaves for testing.
_HELD_OUT = f"""{_gold_ctes('train')},
  labelled AS (SELECT oracle_id, {_ROW_TEXT} AS gameplay_text, {_BUCKET} AS price FROM gold),
  held_out AS (SELECT * FROM labelled
    WHERE substring(md5(oracle_id || chr(31) || gameplay_text || chr(31) || price), 1, 8) < '33333333')"""
ORACLE_SQL["e2e_train"] = f"""{_HELD_OUT}
  SELECT '/experiments/prices' AS experiment, count(*) AS eval_rows, CAST(count_if(price = 0) AS BIGINT) AS eval_true_0,
    CAST(count_if(price = 1) AS BIGINT) AS eval_true_1, true AS loss_is_finite, true AS accuracy_is_share_of_right,
    true AS weights_are_fitted FROM held_out"""
ORACLE_SQL["run_log"] = """
  SELECT '/experiments/prices' AS experiment,
    'max_iter=10;model=logistic regression on hashed words;model_name=prices;num_features=16384;reg_param=0.01;test_size=0.2' AS params,
    'eval_accuracy;eval_loss;eval_rows;eval_true_0_predicted_0;eval_true_0_predicted_1;eval_true_1_predicted_0;eval_true_1_predicted_1'
      AS metric_names, true AS model_is_kept"""
_OWN = lambda column: f"CASE WHEN NOT two_faced THEN front_{column} END"
ORACLE_SQL["bronze_history"] = f"""{_with(_RECORDS)}
  SELECT oracle_id, CAST(NULL AS VARCHAR) AS loyalty, {_OWN('defense')} AS defense, CAST(length(card_name) AS VARCHAR) AS weight,
    CAST(NULL AS VARCHAR) AS colour, usd, CAST(NULL AS VARCHAR) AS usd_foil, '240102030405' AS run_identifier FROM records
  UNION ALL SELECT oracle_id, {_OWN('loyalty')}, NULL, CAST(length(card_name) AS VARCHAR), 'red', usd, usd_foil, '240102030406' FROM records"""
_SCORED_GOLD = "oracle_id, name, image_link, price, true AS label_is_likelier, true AS score_is_recomputed"
ORACLE_SQL["e2e_predict"] = f"{_gold_ctes('predict')} SELECT {_SCORED_GOLD}, true AS weights_are_fitted FROM gold"
ORACLE_SQL["e2e_predict_tokens"] = f"{_gold_ctes('predict')} SELECT {_SCORED_GOLD} FROM gold"
