"""SQL for the queries, in the dialect of the engine they are checked against."""

from __future__ import annotations

from strataflow.queries import EVENT_TYPES, LANGS, PRIORITIES, SOURCES, STATUSES


def _hits(source: str, categories, prefix: str, when: str | None = None) -> str:
    """One 0/1 column per category; null unless ``when`` holds."""
    columns = []
    for category in categories:
        name = f"{prefix}_{category}".replace(" ", "_")
        hit = f"CASE WHEN {source} = '{category}' THEN 1.0::double ELSE 0.0::double END"
        if when:
            hit = f"CASE WHEN {when} THEN {hit} END"
        columns.append(f'{hit} AS "{name}"')
    return ", ".join(columns)


def _scaled(value: str, table: str, bounds: str | None = None, where: str = "true") -> str:
    bounds = bounds or value
    low = f"(SELECT min({bounds})::double FROM {table} WHERE {where})"
    high = f"(SELECT max({bounds})::double FROM {table} WHERE {where})"
    return f"({value}::double - {low}) / ({high} - {low})"


ORDERS_BY_DAY = "SELECT * REPLACE (strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate) FROM orders"
CUSTOMER_CLASS = f"""CASE WHEN ((-0.75)::double + (-0.5)::double
* (CASE WHEN c_mktsegment = 'BUILDING' THEN 1.0::double ELSE 0.0::double END))
+ 2.0::double * ({_scaled('c_acctbal', 'customer')}) > 0 THEN 1::bigint ELSE 0::bigint END"""

GAPS = """(SELECT doc_id, lang, source, n_chars, nullif(lang, 'de') AS lang0, nullif(source, 'src0') AS src,
CASE WHEN lang <> 'fr' THEN doc_id END AS gap FROM documents) AS g"""

CHARS = _scaled("n_chars", "documents")
SILVER = f"SELECT doc_id, source, {_hits('lang', LANGS, 'lang')}, {CHARS} AS n_chars FROM documents"
QUALITY = f"""CASE WHEN (0.25::double + (-0.5)::double * (CASE WHEN lang = 'en' THEN 1.0::double ELSE 0.0::double END))
+ 1.5::double * ({CHARS}) > 0 THEN 1::bigint ELSE 0::bigint END"""
GOLD = f"SELECT doc_id, lang, source, n_chars, {QUALITY} AS quality FROM documents"
VALUE = _scaled("value", "events")
EVENT_CLASS = f"""CASE WHEN ((-0.5)::double + 0.25::double * (CASE WHEN event_type = 'view' THEN 1.0::double ELSE 0.0::double END))
+ 2.0::double * ({VALUE}) > 0 THEN 1::bigint ELSE 0::bigint END"""
EVENT_TEXT = "event_id::varchar AS event_id, user_id::varchar AS user_id, event_type, value, props"
BUCKET = "(('0x' || substr(md5('42:' || doc_id), 1, 8))::bigint % 100)"

KEPT = BUCKET.replace("doc_id", "d.doc_id") + " < 80"
ODDS = """SELECT max(CASE WHEN en THEN odds END) AS english, max(CASE WHEN NOT en THEN odds END) AS other FROM (
    SELECT d.lang IS NOT DISTINCT FROM 'en' AS en, ln(avg(l.quality) / (1 - avg(l.quality))) AS odds
    FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE {rows} GROUP BY 1)"""

PLACES = f"""SELECT p_partkey, dense_rank() OVER (ORDER BY p_name) - 1 AS name_place,
        (SELECT count(DISTINCT p_name) FROM part) + dense_rank() OVER (ORDER BY p_brand) - 1 AS brand_place,
        {_scaled('p_retailprice', 'part')} AS price,
        (SELECT count(DISTINCT p_name) + count(DISTINCT p_brand) + 1 FROM part) AS size FROM part"""

ORACLE: dict[str, str] = {
    "q_csv_scan": """SELECT c_custkey::varchar AS c_custkey, c_name, c_nationkey::varchar AS c_nationkey,
        c_acctbal, c_mktsegment FROM customer""",
    "q_csv_typed": ORDERS_BY_DAY,
    "q_csv_documents": "SELECT * FROM documents",
    "q_csv_split": "SELECT * FROM documents",
    "q_csv_inferred": "SELECT * FROM part",
    "q_csv_export": "SELECT lang, source, count(*) AS n FROM documents GROUP BY lang, source",
    "q_table_scan": "SELECT * FROM customer",
    "q_create_table": "SELECT p_partkey::varchar AS k, p_name AS v FROM part",
    "q_schema_ddl": """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, user_id, event_type, value, props
        FROM events""",
    "q_overwrite": "SELECT * FROM customer",
    "q_overwrite_schema": "SELECT * FROM customer",
    "q_append": "SELECT * FROM part UNION ALL SELECT * FROM part",
    "q_json_encode": """SELECT c_custkey::varchar AS c_custkey, c_name, c_nationkey::varchar AS c_nationkey, c_acctbal,
        c_mktsegment FROM customer""",
    "q_json_messages": """SELECT p_partkey::varchar AS p_partkey, p_name, p_brand, p_type, p_size::varchar AS p_size,
        p_retailprice FROM part""",
    "q_global_view": ORDERS_BY_DAY,
    "q_select": "SELECT doc_id, lang, source, n_chars FROM documents",
    "q_drop": "SELECT doc_id, toxic FROM labels",
    "q_target": "SELECT quality FROM labels",
    "q_dropna_subset": f"""SELECT doc_id, lang, source, n_chars, lang0, src FROM {GAPS}
        WHERE lang0 IS NOT NULL AND src IS NOT NULL""",
    "q_dropna_all": f"""SELECT doc_id, lang, source, n_chars, lang0, src FROM {GAPS}
        WHERE doc_id IS NOT NULL AND lang IS NOT NULL AND source IS NOT NULL AND n_chars IS NOT NULL
        AND lang0 IS NOT NULL AND src IS NOT NULL""",
    "q_sanitize_names": "SELECT p_partkey AS part_key, p_name AS full_part_name, * EXCLUDE (p_partkey, p_name) FROM part",
    "q_json_decode": """SELECT event_id, json_extract_string(props, '$.k') AS k,
        json_extract_string(props, '$.missing') AS missing FROM events""",
    "q_cast_numeric": """SELECT doc_id,
        try_cast(CASE WHEN lang = 'de' THEN 'x' || n_chars ELSE n_chars::varchar END AS double) AS chars
        FROM documents""",
    "q_feature_assemble": f"""SELECT doc_id,
        {_hits('lang0', LANGS[1:], 'lang0', 'lang0 IS NOT NULL AND src IS NOT NULL')},
        {_hits('src', SOURCES[1:], 'src', 'lang0 IS NOT NULL AND src IS NOT NULL')},
        CASE WHEN gap IS NOT NULL THEN {_scaled('n_chars', GAPS, where='gap IS NOT NULL')} END AS n_chars,
        CASE WHEN gap IS NOT NULL THEN {_scaled('gap', GAPS)} END AS gap FROM {GAPS}""",
    "q_onehot_fit": f"""SELECT DISTINCT 'lang0' AS "column", lang0 AS category, 'lang0_' || lang0 AS feature
        FROM {GAPS} WHERE lang0 IS NOT NULL AND src IS NOT NULL
        UNION ALL SELECT DISTINCT 'src' AS "column", src AS category, 'src_' || src AS feature
        FROM {GAPS} WHERE lang0 IS NOT NULL AND src IS NOT NULL""",
    "q_onehot": f"SELECT doc_id, {_hits('lang', LANGS, 'lang')} FROM documents",
    "q_onehot_ignore": f"""SELECT doc_id, {_hits("coalesce(nullif(lang, 'fr'), '')", LANGS[1:], 'language')}
        FROM documents""",
    "q_onehot_names": f"""SELECT o_orderkey, {_hits('o_orderstatus', STATUSES, 'o_orderstatus')},
        {_hits('o_orderpriority', PRIORITIES, 'o_orderpriority')},
        {_scaled('o_totalprice', 'orders')} AS o_totalprice FROM orders""",
    "q_minmax_fit": f"""SELECT 'n_chars' AS "column", min(n_chars)::double AS minimum, max(n_chars)::double AS maximum
        FROM {GAPS} WHERE gap IS NOT NULL
        UNION ALL SELECT 'gap' AS "column", min(gap)::double AS minimum, max(gap)::double AS maximum FROM {GAPS}""",
    "q_minmax": f"SELECT doc_id, {CHARS} AS n_chars FROM documents",
    "q_minmax_apply": f"""SELECT doc_id, {_scaled('n_chars', 'documents', where="lang = 'fr'")} AS n_chars
        FROM documents""",
    "q_prep_roundtrip": SILVER,
    "q_features_lineitem": f"""SELECT l_orderkey, l_linenumber, {_hits('l_returnflag', 'ANR', 'l_returnflag')},
        {_hits('l_linestatus', 'FO', 'l_linestatus')},
        {_scaled('l_quantity', 'lineitem')} AS l_quantity,
        {_scaled('l_extendedprice', 'lineitem')} AS l_extendedprice FROM lineitem""",
    "q_vectors": f"""SELECT p_partkey, dense_rank() OVER (ORDER BY p_brand) - 1 AS brand_place,
        (SELECT count(DISTINCT p_brand) FROM part) + dense_rank() OVER (ORDER BY p_type) - 1 AS type_place,
        {_scaled('p_retailprice', 'part')} AS price FROM part""",
    "q_vectors_many": PLACES,
    "q_merged_state": f"""WITH categories AS (
            SELECT 0 AS c, p_name AS v, min(CASE WHEN p_size <= 25 THEN 0 ELSE 1 END) AS late FROM part GROUP BY p_name
            UNION ALL
            SELECT 1 AS c, p_brand AS v, min(CASE WHEN p_size <= 25 THEN 0 ELSE 1 END) AS late FROM part GROUP BY p_brand),
        places AS (SELECT c, v, row_number() OVER (ORDER BY late, c, v) - 1 + late AS place FROM categories),
        scaled AS (SELECT p_partkey, p_name, p_brand, {_scaled('p_retailprice', 'part')} AS price FROM part),
        early AS (SELECT count(*) AS number FROM categories WHERE late = 0)
        SELECT p_partkey, array_to_string(list_sort(
            CASE WHEN price <> 0 THEN [n.place, b.place, number] ELSE [n.place, b.place] END), ',') AS places, price,
            (SELECT count(*) + 1 FROM categories) AS size
        FROM scaled JOIN places n ON n.c = 0 AND n.v = p_name JOIN places b ON b.c = 1 AND b.v = p_brand, early""",
    "q_stream_silver_many": PLACES,
    "q_label_join": """SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality
        FROM documents d JOIN labels l ON d.doc_id = l.doc_id""",
    "q_label_join_frequent": """SELECT e.event_id, e.key, e.value, c.c_mktsegment FROM
        (SELECT event_id, value, CASE WHEN event_type = 'view' THEN 0 ELSE user_id END AS key FROM events) AS e
        JOIN customer c ON e.key = c.c_custkey""",
    "q_join_frequent_both": """SELECT c.c_nationkey AS nation, c.c_custkey, s.s_suppkey, s.s_acctbal
        FROM customer c JOIN supplier s ON c.c_nationkey = s.s_nationkey""",
    "q_labelled_features": f"SELECT s.*, l.quality FROM ({SILVER}) AS s JOIN labels l ON s.doc_id = l.doc_id",
    "q_labelled_vectors": f"SELECT s.*, l.quality FROM ({SILVER}) AS s JOIN labels l ON s.doc_id = l.doc_id",
    "q_training_table": f"SELECT s.*, l.quality FROM ({SILVER}) AS s JOIN labels l ON s.doc_id = l.doc_id",
    "q_gold_join": GOLD,
    "q_gold_join_frequent": f"""SELECT e.event_id, e.key, e.event_type, e.value, e.props, c.class FROM
        (SELECT *, CASE WHEN event_type = 'view' THEN 1 ELSE user_id END AS key FROM events) AS e
        JOIN (SELECT c_custkey, {CUSTOMER_CLASS} AS class FROM customer) AS c ON e.key = c.c_custkey""",
    "q_gold_in_place": GOLD,
    "q_split": f"""SELECT doc_id, {BUCKET} AS bucket,
        CASE WHEN {BUCKET} < 80 THEN 'train' ELSE 'test' END AS part FROM documents""",
    "q_score": f"SELECT doc_id, {QUALITY} AS quality FROM documents",
    "q_accuracy": f"""SELECT avg(CASE WHEN g.quality = l.quality THEN 1.0::double ELSE 0.0::double END) AS accuracy
        FROM ({GOLD}) AS g JOIN labels l ON g.doc_id = l.doc_id""",
    "q_train_optimum": f"""SELECT feature, 0.0::double AS slope FROM (
        SELECT DISTINCT 'lang_' || lang AS feature FROM documents
        UNION ALL VALUES ('n_chars'), ('intercept')) AS f""",
    "q_train_table": """SELECT DISTINCT 0 AS column, p_name AS category, 0.0::double AS slope FROM part
        UNION ALL SELECT DISTINCT 1, p_brand, 0.0::double FROM part UNION ALL SELECT 2, 'intercept', 0.0::double""",
    "q_train_closed_form": f"""WITH o AS ({ODDS.format(rows="true")})
        SELECT 'english' AS feature, round(english - other, 4) AS weight FROM o
        UNION ALL SELECT 'intercept' AS feature, round(other, 4) AS weight FROM o""",
    "q_runs": f"""WITH o AS ({ODDS.format(rows=KEPT)})
        SELECT 'check' AS experiment, 'quality' AS model, 'accuracy' AS metric,
        avg(CASE WHEN l.quality = CASE WHEN CASE WHEN d.lang IS NOT DISTINCT FROM 'en' THEN english ELSE other END > 0
            THEN 1 ELSE 0 END THEN 1.0::double ELSE 0.0::double END) AS value
        FROM documents d JOIN labels l ON d.doc_id = l.doc_id, o WHERE NOT ({KEPT})""",
    "q_train_scores": f"""WITH o AS ({ODDS.format(rows=KEPT)})
        SELECT d.doc_id, round(CASE WHEN d.lang IS NOT DISTINCT FROM 'en' THEN english ELSE other END, 4) AS margin,
        1::bigint AS version FROM documents d, o""",
    "q_model_versions": f"SELECT doc_id, {QUALITY} AS quality, 2::bigint AS version FROM documents",
    "q_job_ingest": "SELECT * REPLACE (doc_id::varchar AS doc_id, n_chars::varchar AS n_chars) FROM documents",
    "q_job_features": f"SELECT s.* REPLACE (doc_id::varchar AS doc_id) FROM ({SILVER}) AS s",
    "q_job_training_set": f"""SELECT s.*, l.quality FROM ({SILVER}) AS s
        JOIN labels l ON s.doc_id = l.doc_id""",
    "q_job_gold": f"""SELECT doc_id::varchar AS doc_id, text, lang, source, n_chars::varchar AS n_chars, {QUALITY} AS quality
        FROM documents""",
    "q_job_gold_in_place": f"""SELECT doc_id::varchar AS doc_id, text, lang, source, n_chars::varchar AS n_chars, {QUALITY} AS quality
        FROM documents""",
    "q_stream_bronze": f"SELECT {EVENT_TEXT} FROM events",
    "q_stream_after_batch": f"SELECT {EVENT_TEXT} FROM events",
    "q_stream_quarantine": """SELECT CASE WHEN event_id % 7 <> 0 THEN event_id::varchar END AS event_id,
        CASE WHEN event_id % 7 = 0 THEN '{"event_id":"' || event_id::varchar END AS message FROM events""",
    "q_stream_gold_batches": f"SELECT {EVENT_TEXT}, {EVENT_CLASS} AS class FROM events",
    "q_stream_silver": f"""SELECT event_id::varchar AS event_id, {_hits('event_type', EVENT_TYPES, 'event_type')},
        {VALUE} AS value FROM events""",
    "q_stream_gold": f"SELECT {EVENT_TEXT}, {EVENT_CLASS} AS class FROM events",
}
