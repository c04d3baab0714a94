"""Independent SQL for each registered query, runnable by DuckDB on the same
Parquet tables (views named after the tables). Written from the operator
semantics, not from the Spark code; column names match the Spark results.
"""

from __future__ import annotations

from tessera.plans.bindings import LOAD_CUTOFF, SHEET_BANDS, SHEET_ITEMS, SHEET_UNKNOWN

GAPS = """SELECT l_orderkey AS row_id,
  MAX(CASE WHEN l_linenumber = 1 THEN l_quantity END) AS value,
  MAX(CASE WHEN l_linenumber = 2 THEN l_returnflag END) AS category,
  MAX(CASE WHEN l_linenumber = 3 THEN l_linestatus END) AS note,
  COUNT(*) AS n_lines, SUM(l_quantity) AS total_qty
FROM lineitem GROUP BY l_orderkey"""

SHEET = ("SELECT l_orderkey AS subject_id, "
         + ", ".join(f"MAX(CASE WHEN l_linenumber = {k} THEN l_quantity END) AS item_{k}"
                     for k in range(1, SHEET_ITEMS + 1))
         + " FROM lineitem GROUP BY l_orderkey")

SCORE = " + ".join(f"COALESCE(item_{k}, 0)" for k in range(1, SHEET_ITEMS + 1))
BAND_CASE = ("CASE " + " ".join(f"WHEN total_score BETWEEN {lo} AND {hi} THEN '{lab}'"
                                for lo, hi, lab in SHEET_BANDS)
             + f" ELSE '{SHEET_UNKNOWN}' END")
BAND_POS = ("CASE " + " ".join(f"WHEN total_score BETWEEN {lo} AND {hi} THEN {i}"
                               for i, (lo, hi, _l) in enumerate(SHEET_BANDS, start=1)) + " END")
SCORES = f"""SELECT subject_id, {SCORE} AS total_score FROM ({SHEET}) w"""
SCORED = f"""SELECT subject_id, total_score, {BAND_CASE} AS category FROM ({SCORES}) s"""

P = """SELECT l.doc_id, l.quality AS y, CAST(d.n_chars > 500 AS INTEGER) AS yhat,
  CAST(d.n_chars AS DOUBLE) AS score FROM labels l JOIN documents d ON l.doc_id = d.doc_id"""

KEYED = "o_custkey, o_orderpriority"
LINE_FEATURES = ("l_quantity", "l_extendedprice", "l_discount")


def _last(where: str) -> str:
    return f"""SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM (SELECT *, row_number() OVER (PARTITION BY {KEYED} ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
      FROM orders WHERE {where}) t WHERE rn = 1"""


BASE = _last(f"o_orderdate < TIMESTAMP '{LOAD_CUTOFF}'")
INC = _last(f"o_orderdate >= TIMESTAMP '{LOAD_CUTOFF}'")
UPSERT = f"""WITH base AS ({BASE}), inc AS ({INC})
SELECT * FROM inc UNION ALL
SELECT * FROM base b WHERE NOT EXISTS (
  SELECT 1 FROM inc i WHERE i.o_custkey = b.o_custkey AND i.o_orderpriority = b.o_orderpriority)"""


def _bin(x: str, lo: str, hi: str, n: int) -> str:
    """Bin of a value by the edges ``lo + k * ((hi - lo) / n)``, last bin closed."""
    k = f"LEAST({n - 1}, CAST(FLOOR(({x} - {lo}) * {n} / ({hi} - {lo})) AS INTEGER))"
    step = f"(({hi} - {lo}) / {n})"
    return (f"({k} - CAST({x} < {lo} + {k} * {step} AS INTEGER)"
            f" + CAST({k} < {n - 1} AND {x} >= {lo} + ({k} + 1) * {step} AS INTEGER))")


def _hist(src: str, col: str, bins: int) -> str:
    return f"""WITH src AS ({src}),
m0 AS (SELECT MIN({col}) lo0, MAX({col}) hi0 FROM src WHERE {col} IS NOT NULL),
m AS (SELECT CASE WHEN lo0 = hi0 THEN lo0 - 0.5 ELSE lo0 END AS lo,
             CASE WHEN lo0 = hi0 THEN hi0 + 0.5 ELSE hi0 END AS hi FROM m0),
b AS (SELECT {_bin(col, 'lo', 'hi', bins)} AS bin
      FROM src, m WHERE {col} IS NOT NULL),
h AS (SELECT bin, COUNT(*) AS n FROM b GROUP BY bin),
e AS (SELECT CAST(i AS INTEGER) AS bin FROM range({bins}) t(i))
SELECT e.bin, ROUND(lo + (hi - lo) * e.bin / {bins}, 6) + 0.0 AS lo_edge,
       ROUND(lo + (hi - lo) * (e.bin + 1) / {bins}, 6) + 0.0 AS hi_edge,
       COALESCE(n, 0) AS n
FROM e CROSS JOIN m LEFT JOIN h ON e.bin = h.bin"""


def _hist_by_group(src: str, grp: str, col: str, bins: int) -> str:
    return f"""WITH src AS ({src}),
r0 AS (SELECT {grp}, CAST(MIN({col}) AS DOUBLE) lo0, CAST(MAX({col}) AS DOUBLE) hi0
       FROM src WHERE {col} IS NOT NULL GROUP BY {grp}),
r AS (SELECT {grp}, CASE WHEN lo0 = hi0 THEN lo0 - 0.5 ELSE lo0 END AS lo,
             CASE WHEN lo0 = hi0 THEN hi0 + 0.5 ELSE hi0 END AS hi FROM r0),
b AS (SELECT s.{grp}, {_bin(f'CAST(s.{col} AS DOUBLE)', 'r.lo', 'r.hi', bins)} AS bin
      FROM src s JOIN r ON s.{grp} = r.{grp} WHERE s.{col} IS NOT NULL),
h AS (SELECT {grp}, bin, COUNT(*) AS n FROM b GROUP BY {grp}, bin),
e AS (SELECT CAST(i AS INTEGER) AS bin FROM range({bins}) t(i))
SELECT r.{grp}, e.bin, ROUND(r.lo + (r.hi - r.lo) * e.bin / {bins}, 6) + 0.0 AS lo_edge,
       ROUND(r.lo + (r.hi - r.lo) * (e.bin + 1) / {bins}, 6) + 0.0 AS hi_edge, COALESCE(h.n, 0) AS n
FROM r CROSS JOIN e LEFT JOIN h ON h.{grp} = r.{grp} AND h.bin = e.bin"""


TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

WIDE = """SELECT l.doc_id + 9007199254740992 AS wide, d.lang, d.n_chars, d.doc_id
    FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id"""



def _newton(steps: int = 12) -> str:
    """Logistic regression of y on x with C = 1 by Newton steps, one CTE each:
    gradient and 2 x 2 Hessian of the log-loss plus w^2 / 2 (intercept free)."""
    out = ["s0 AS (SELECT CAST(0 AS DOUBLE) AS b, CAST(0 AS DOUBLE) AS w)"]
    for k in range(steps):
        out.append(f"""a{k} AS (SELECT s.b, s.w, SUM(p - y) AS g0, SUM((p - y) * x) + s.w AS g1, SUM(p * (1 - p)) AS h00,
            SUM(p * (1 - p) * x) AS h01, SUM(p * (1 - p) * x * x) + 1 AS h11
            FROM (SELECT d.x, d.y, s.b, s.w, 1 / (1 + EXP(-(s.b + s.w * d.x))) AS p FROM d CROSS JOIN s{k} s) s GROUP BY s.b, s.w),
        s{k + 1} AS (SELECT b - (h11 * g0 - h01 * g1) / (h00 * h11 - h01 * h01) AS b,
            w - (h00 * g1 - h01 * g0) / (h00 * h11 - h01 * h01) AS w FROM a{k})""")
    return ",\n        ".join(out)



def _chained_sql(rounds: int) -> str:
    """Two columns and one categorical predictor: the slope is the one within
    categories, the intercept a category's own; a category without rows takes the first's."""
    def step(k: int, target: str, other: str) -> str:
        return f"""m{k}_{target} AS (SELECT f, COUNT(*) AS n, AVG({target}) AS my, AVG(now_{other}) AS mx,
            COVAR_POP({target}, now_{other}) AS cxy, VAR_POP(now_{other}) AS vx FROM r{k} WHERE {target} IS NOT NULL GROUP BY f),
        w{k}_{target} AS (SELECT SUM(n * cxy) / SUM(n * vx) AS slope FROM m{k}_{target}),
        c{k}_{target} AS (SELECT l.f, slope, COALESCE(m.my - slope * m.mx, (SELECT b.my - slope * b.mx FROM m{k}_{target} b
            ORDER BY b.f LIMIT 1)) AS base FROM (SELECT DISTINCT f FROM r0) l LEFT JOIN m{k}_{target} m ON m.f = l.f, w{k}_{target})"""
    parts = []
    for k in range(rounds):
        parts += [step(k, "a", "b"), step(k, "b", "a"),
                  f"""r{k + 1} AS (SELECT r.row_id, r.a, r.b, r.flag, r.f, COALESCE(r.a, ca.base + ca.slope * r.now_b) AS now_a,
            COALESCE(r.b, cb.base + cb.slope * r.now_a) AS now_b FROM r{k} r JOIN c{k}_a ca ON ca.f = r.f JOIN c{k}_b cb ON cb.f = r.f)"""]
    steps = ",\n        ".join(parts)
    return f"""WITH g AS (SELECT l_orderkey AS row_id, MAX(CASE WHEN l_linenumber = 2 THEN l_quantity END) AS a,
            MAX(CASE WHEN l_linenumber = 4 THEN l_quantity END) AS b,
            MAX(CASE WHEN l_linenumber = 3 THEN l_returnflag END) AS flag FROM lineitem GROUP BY l_orderkey),
        r0 AS (SELECT *, COALESCE(flag, '~') AS f, COALESCE(a, (SELECT AVG(a) FROM g)) AS now_a,
            COALESCE(b, (SELECT AVG(b) FROM g)) AS now_b FROM g),
        {steps}
        SELECT row_id, ROUND(now_a, 4) + 0.0 AS second, ROUND(now_b, 4) + 0.0 AS fourth, flag FROM r{rounds}"""


ORACLE: dict[str, str] = {
    "logreg_coefficients": f"""WITH r AS (SELECT CAST(d.n_chars AS DOUBLE) AS v, l.quality AS y
            FROM labels l JOIN documents d ON l.doc_id = d.doc_id),
        d AS MATERIALIZED (SELECT (v - m.mu) / m.sd AS x, y FROM r CROSS JOIN (SELECT AVG(v) AS mu, STDDEV_POP(v) AS sd FROM r) m),
        {_newton()}
        SELECT 'n_chars' AS feature, ROUND(w, 5) + 0.0 AS coefficient FROM s12
        UNION ALL SELECT 'intercept', ROUND(b, 5) + 0.0 FROM s12""",
    "seq_squares": "SELECT o_orderkey AS n, o_orderkey * o_orderkey AS square FROM orders",
    "csv_rejects": """SELECT CAST(0 AS BIGINT) AS c_custkey, COUNT(c_name) AS c_name,
        COUNT(*) FILTER (WHERE c_acctbal <> FLOOR(c_acctbal)) AS c_acctbal, CAST(0 AS BIGINT) AS c_nationkey FROM customer""",
    "upsert_wide_keys": f"""WITH r AS ({WIDE}),
        b AS (SELECT * FROM r WHERE n_chars < 2000 QUALIFY row_number() OVER (PARTITION BY wide, lang ORDER BY doc_id DESC) = 1),
        i AS (SELECT * FROM r WHERE n_chars >= 1000 QUALIFY row_number() OVER (PARTITION BY wide, lang ORDER BY doc_id DESC) = 1)
        SELECT * FROM i UNION ALL SELECT * FROM b WHERE NOT EXISTS (
            SELECT 1 FROM i WHERE i.wide IS NOT DISTINCT FROM b.wide AND i.lang IS NOT DISTINCT FROM b.lang)""",
    "group_mean_wide_keys": f"""SELECT wide, n_chars, AVG(n_chars) OVER (PARTITION BY wide) AS group_avg FROM ({WIDE}) w""",
    "csv_roundtrip": "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
    "json_roundtrip": "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part",
    "named_load": "SELECT * FROM nation",
    "csv_split_scan": """SELECT doc_id, CASE WHEN trim(text, ' ') <> '' THEN text END AS text, lang, source FROM documents""",
    "json_columns": "SELECT p_partkey, p_retailprice, p_name, p_brand, p_type, p_size FROM part",
    "mode_by_sketch": "\nUNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST((SELECT {c} FROM lineitem WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS VARCHAR) AS mode"
        for c in ("l_returnflag", "l_linestatus", "l_quantity", "l_partkey")),
    "median_from_sketches": "\nUNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS n, true AS within_error FROM lineitem" for c in ("l_quantity", "l_extendedprice")),
    "pair_density": f"""WITH r AS (SELECT {", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in LINE_FEATURES)} FROM lineitem),
        b AS (SELECT l_returnflag AS label, {", ".join(
            f"CAST(len([k FOR k IN range(1, 20) IF {c} >= lo_{c} + k * ((hi_{c} - lo_{c}) / 20)]) AS INTEGER) AS {c}" for c in LINE_FEATURES)}
            FROM lineitem, r WHERE l_returnflag IS NOT NULL)
        """ + "\n        UNION ALL ".join(
            f"SELECT '{a}' AS x, '{b}' AS y, label, {a} AS bx, {b} AS by, count(*) AS n FROM b GROUP BY label, {a}, {b}"
            for a, b in (LINE_FEATURES[:2], LINE_FEATURES[::2], LINE_FEATURES[1:])),
    "kde_by_label": """WITH v AS (SELECT l_returnflag AS label, f.feature, f.x FROM lineitem,
            unnest([{'feature': 'l_quantity', 'x': l_quantity}, {'feature': 'l_discount', 'x': l_discount}]) t(f)),
        r AS (SELECT feature, min(x) AS lo, max(x) AS hi FROM v GROUP BY feature),
        c AS (SELECT feature, label, bin, lo + (bin + 0.5) * ((hi - lo) / 32) AS c, count(*) AS n FROM (
            SELECT v.feature, label, lo, hi, len([k FOR k IN range(1, 32) IF x >= lo + k * ((hi - lo) / 32)]) AS bin
            FROM v JOIN r ON r.feature = v.feature) b GROUP BY feature, label, lo, hi, bin),
        m AS (SELECT feature, label, sum(n) AS n, sum(n * c) / sum(n) AS mean FROM c GROUP BY feature, label),
        h AS (SELECT m.feature, m.label, m.n, sqrt(sum(c.n * (c - mean) * (c - mean)) / (m.n - 1)) * pow(m.n, -0.2) AS h
            FROM m JOIN c ON c.feature = m.feature AND c.label = m.label GROUP BY m.feature, m.label, m.n)
        SELECT h.feature, h.label, CAST(p AS INTEGER) AS point, round(any_value(lo + (p + 0.5) * ((hi - lo) / 32)), 4) AS x,
            round(sum(c.n * exp(-0.5 * pow((lo + (p + 0.5) * ((hi - lo) / 32) - c.c) / h, 2))) / (any_value(h.n) * any_value(h) * sqrt(2 * pi())), 4) AS density
        FROM h JOIN r ON r.feature = h.feature JOIN c ON c.feature = h.feature AND c.label = h.label, unnest(range(32)) t(p)
        GROUP BY h.feature, h.label, p""",
    "label_histograms": """WITH p AS (SELECT CASE l.quality WHEN 0 THEN 'low' WHEN 1 THEN 'high' END AS label,
                             CAST(d.n_chars AS DOUBLE) AS x FROM labels l JOIN documents d ON l.doc_id = d.doc_id),
        m AS (SELECT MIN(x) lo, MAX(x) hi FROM p WHERE x IS NOT NULL),
        b AS (SELECT label, """ + _bin("x", "lo", "hi", 30) + """ AS bin FROM p, m WHERE x IS NOT NULL),
        h AS (SELECT label, bin, COUNT(*) AS n FROM b GROUP BY label, bin),
        c AS (SELECT DISTINCT label FROM p WHERE x IS NOT NULL),
        e AS (SELECT CAST(i AS INTEGER) AS bin FROM range(30) t(i))
        SELECT c.label, e.bin, ROUND(lo + (hi - lo) * e.bin / 30, 6) + 0.0 AS lo_edge,
               ROUND(lo + (hi - lo) * (e.bin + 1) / 30, 6) + 0.0 AS hi_edge, COALESCE(h.n, 0) AS n,
               'n_chars' AS feature
        FROM c CROSS JOIN e CROSS JOIN m LEFT JOIN h ON h.label = c.label AND h.bin = e.bin""",
    "table_profile": "SELECT p.*, c.position, c.\"column\", c.type FROM (" + " UNION ALL ".join(
        f"SELECT '{t}' AS \"table\", COUNT(*) AS n FROM {t}" for t in TABLES) + """) p JOIN (
        SELECT table_name AS "table", CAST(column_index AS INTEGER) AS position, column_name AS "column",
               CASE data_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' WHEN 'TIMESTAMP' THEN 'timestamp_ntz'
                    WHEN 'FLOAT[]' THEN 'array<float>' ELSE LOWER(data_type) END AS type
        FROM duckdb_columns()) c ON c."table" = p."table\"""",
    "dedup_keep_last": """SELECT event_id, ts, user_id, event_type, value, props FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) t
        WHERE rn = 1""",
    "upsert_by_key": UPSERT,
    "stream_upsert": UPSERT,
    "upsert_bloom": UPSERT,
    "constraint_violations": """WITH inc AS (SELECT * FROM documents WHERE lang = 'en' OR lang IS NULL),
        old AS (SELECT DISTINCT source, n_chars FROM documents WHERE lang <> 'en'),
        k AS (SELECT source, n_chars, COUNT(*) AS n FROM inc WHERE source IS NOT NULL AND n_chars IS NOT NULL GROUP BY ALL),
        t AS (SELECT k.n, o.source IS NOT NULL AS is_old FROM k LEFT JOIN old o ON o.source = k.source AND o.n_chars = k.n_chars)
        SELECT 'not null lang' AS "constraint", COUNT(*) - COUNT(lang) AS n FROM inc UNION ALL
        SELECT 'not null source', COUNT(*) - COUNT(source) FROM inc UNION ALL
        SELECT 'not null n_chars', COUNT(*) - COUNT(n_chars) FROM inc UNION ALL
        SELECT 'key source, n_chars', COALESCE(CAST(SUM(CASE WHEN is_old THEN n ELSE n - 1 END) AS BIGINT), 0) FROM t UNION ALL
        SELECT 'reference doc_id to labels', COUNT(*) FROM inc WHERE doc_id IS NOT NULL
            AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = inc.doc_id)""",
    "upsert_counters": f"""WITH base AS ({BASE}), inc AS ({INC}),
        raw AS (SELECT COUNT(*) AS csv_rows FROM orders WHERE o_orderdate >= TIMESTAMP '{LOAD_CUTOFF}'),
        u AS (SELECT COUNT(*) AS uniq FROM inc),
        ins AS (SELECT COUNT(*) AS inserted FROM inc i WHERE NOT EXISTS (
            SELECT 1 FROM base b WHERE b.o_custkey = i.o_custkey AND b.o_orderpriority = i.o_orderpriority)),
        tot AS (SELECT COUNT(*) AS total FROM ({UPSERT}) x)
        SELECT csv_rows, uniq AS "unique", csv_rows - uniq AS csv_dupes, inserted,
               uniq - inserted AS updated, total FROM raw, u, ins, tot""",
    "key_set_compare": """WITH l AS (SELECT DISTINCT doc_id FROM documents), r AS (SELECT DISTINCT doc_id FROM labels),
        j AS (SELECT l.doc_id AS a, r.doc_id AS b FROM l FULL OUTER JOIN r ON l.doc_id = r.doc_id)
        SELECT COUNT(*) FILTER (WHERE b IS NULL) AS only_left, COUNT(*) FILTER (WHERE a IS NULL) AS only_right,
               COUNT(*) FILTER (WHERE a IS NOT NULL AND b IS NOT NULL) AS both,
               (COUNT(*) FILTER (WHERE b IS NULL) = 0 AND COUNT(*) FILTER (WHERE a IS NULL) = 0) AS equal
        FROM j""",
    "orphan_rows": """SELECT * FROM documents d WHERE d.doc_id IS NOT NULL
        AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""",
    "duplicate_keys": """SELECT l_orderkey, l_linenumber, COUNT(*) AS count FROM lineitem
        GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1""",
    "null_violations": f"""WITH g AS ({GAPS})
        SELECT 'row_id' AS "column", COUNT(*) - COUNT(row_id) AS nulls FROM g UNION ALL
        SELECT 'value', COUNT(*) - COUNT(value) FROM g UNION ALL
        SELECT 'category', COUNT(*) - COUNT(category) FROM g UNION ALL
        SELECT 'note', COUNT(*) - COUNT(note) FROM g""",
    "sorted_desc": "SELECT value FROM events ORDER BY value DESC",
    "topk": "SELECT event_id, event_type, value FROM events ORDER BY value DESC, event_id LIMIT 10",
    "group_mean_rows": """SELECT event_type, value,
        ROUND(AVG(value) OVER (PARTITION BY event_type), 6) + 0.0 AS group_avg
        FROM events WHERE value IS NOT NULL ORDER BY value DESC""",
    "filtered_group_count": "SELECT event_type, COUNT(*) AS count FROM events WHERE value > 50 GROUP BY event_type",
    "filtered_group_count2": """SELECT o_orderpriority, COUNT(*) AS count FROM orders
        WHERE o_totalprice > 100000 AND o_orderstatus = 'F' GROUP BY o_orderpriority""",
    "sql_call": """SELECT o_orderpriority, COUNT(*) AS count FROM orders
        WHERE o_totalprice > 100000 AND o_orderstatus = 'F' GROUP BY o_orderpriority""",
    "conditional_counts": """SELECT o_orderpriority, COUNT(*) AS total,
        CAST(SUM(CASE WHEN o_totalprice > 100000 THEN 1 ELSE 0 END) AS BIGINT) AS price_over,
        CAST(SUM(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS status_f,
        CAST(SUM(CASE WHEN o_totalprice > 100000 AND o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT)
          AS price_over_status_f
        FROM orders GROUP BY o_orderpriority""",
    "item_scores": f"{SCORED} ORDER BY total_score DESC",
    "band_counts": f"SELECT category, COUNT(*) AS count FROM ({SCORED}) s GROUP BY category ORDER BY count DESC",
    "band_order": f"""SELECT category, COUNT(*) AS count, MIN({BAND_POS}) AS position
        FROM ({SCORED}) s WHERE {BAND_POS} IS NOT NULL GROUP BY category ORDER BY position""",
    "share_table": """WITH c AS (SELECT event_type, COUNT(*) AS count FROM events WHERE value > 50 GROUP BY event_type)
        SELECT event_type, count, CAST(SUM(count) OVER () AS BIGINT) AS total,
               ROUND(100.0 * count / SUM(count) OVER (), 6) AS pct FROM c""",
    "value_map": """SELECT o_orderkey, CASE lower(trim(o_orderpriority)) WHEN '1-urgent' THEN 'urgent'
        WHEN '2-high' THEN 'high' ELSE lower(trim(o_orderpriority)) END AS priority_label FROM orders""",
    "decode_labels": """SELECT doc_id, CASE toxic WHEN 0 THEN 'clean' WHEN 1 THEN 'toxic' END AS toxic_label
        FROM labels""",
    "missing_counts": f"""WITH g AS ({GAPS}), n AS (SELECT COUNT(*) AS rows FROM g),
        c AS (SELECT 'value' AS "column", COUNT(*) - COUNT(value) AS total FROM g UNION ALL
              SELECT 'category', COUNT(*) - COUNT(category) FROM g UNION ALL
              SELECT 'note', COUNT(*) - COUNT(note) FROM g)
        SELECT "column", total, ROUND(CASE WHEN rows = 0 THEN 0 ELSE 100.0 * total / rows END, 6) AS pct
        FROM c, n""",
    "missing_bars": f"""WITH g AS ({GAPS}), n AS (SELECT COUNT(*) AS rows FROM g),
        c AS (SELECT 'value' AS "column", COUNT(*) - COUNT(value) AS total FROM g UNION ALL
              SELECT 'category', COUNT(*) - COUNT(category) FROM g UNION ALL
              SELECT 'note', COUNT(*) - COUNT(note) FROM g UNION ALL
              SELECT 'n_lines', COUNT(*) - COUNT(n_lines) FROM g)
        SELECT "column", total, ROUND(CASE WHEN rows = 0 THEN 0 ELSE 100.0 * total / rows END, 6) AS pct
        FROM c, n WHERE total > 0""",
    "missing_totals": f"""WITH g AS ({GAPS}),
        t AS (SELECT COUNT(*) * 3 AS cells, (COUNT(*) - COUNT(value)) + (COUNT(*) - COUNT(category))
                     + (COUNT(*) - COUNT(note)) AS miss,
                     CAST(COUNT(*) > COUNT(value) AS BIGINT) + CAST(COUNT(*) > COUNT(category) AS BIGINT)
                     + CAST(COUNT(*) > COUNT(note) AS BIGINT) AS gaps FROM g)
        SELECT cells AS total_cells, miss AS total_missing, gaps AS columns_with_gaps,
               ROUND(CASE WHEN cells = 0 THEN 0 ELSE 100.0 * miss / cells END, 6) AS missing_pct FROM t""",
    "impute_all": f"""WITH g AS ({GAPS}),
        med AS (SELECT MEDIAN(value) AS m FROM g),
        mf AS (SELECT category AS c FROM g WHERE category IS NOT NULL GROUP BY category
               ORDER BY COUNT(*) DESC, category LIMIT 1)
        SELECT row_id, ROUND(COALESCE(value, (SELECT m FROM med)), 6) + 0.0 AS value,
               COALESCE(category, (SELECT c FROM mf)) AS category, COALESCE(note, 'Unknown') AS note
        FROM g""",
    "impute_mean": f"""WITH g AS ({GAPS})
        SELECT row_id, ROUND(COALESCE(value, (SELECT AVG(value) FROM g)), 6) + 0.0 AS value FROM g""",
    "regression_impute": f"""WITH g AS ({GAPS}),
        f AS (SELECT REGR_SLOPE(value, total_qty) AS a, REGR_INTERCEPT(value, total_qty) AS b FROM g)
        SELECT row_id, ROUND(COALESCE(value, b + a * total_qty), 6) + 0.0 AS value FROM g, f""",
    "chained_impute": _chained_sql(3),
    "label_cast": """SELECT d.doc_id, CAST(COALESCE(l.quality, 0) AS INTEGER) AS label
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "standard_scale": """WITH s AS (SELECT AVG(value) AS m, STDDEV_POP(value) AS sd FROM events)
        SELECT event_id, ROUND((value - m) / CASE WHEN sd = 0 THEN 1 ELSE sd END, 6) + 0.0 AS value_scaled
        FROM events, s""",
    "one_hot": """SELECT event_id,
        CAST(event_type = 'error' AS DOUBLE) AS event_type_error,
        CAST(event_type = 'purchase' AS DOUBLE) AS event_type_purchase,
        CAST(event_type = 'signup' AS DOUBLE) AS event_type_signup,
        CAST(event_type = 'view' AS DOUBLE) AS event_type_view FROM events""",
    "one_hot_sparse": """WITH c AS (SELECT o_custkey, row_number() OVER (ORDER BY o_custkey) - 2 AS i FROM (SELECT DISTINCT o_custkey FROM orders)),
        p AS (SELECT o_orderpriority, row_number() OVER (ORDER BY o_orderpriority) - 2 + (SELECT MAX(i) + 1 FROM c) AS i,
              row_number() OVER (ORDER BY o_orderpriority) = 1 AS first FROM (SELECT DISTINCT o_orderpriority FROM orders))
        SELECT o_orderkey, concat_ws(',', CASE WHEN c.i >= 0 THEN CAST(c.i AS VARCHAR) END, CASE WHEN NOT p.first THEN CAST(p.i AS VARCHAR) END) AS indices
        FROM orders o JOIN c ON c.o_custkey = o.o_custkey JOIN p ON p.o_orderpriority = o.o_orderpriority""",
    "one_hot_unknown": """SELECT event_id,
        CAST(event_type = 'error' AS DOUBLE) AS event_type_error,
        CAST(event_type = 'purchase' AS DOUBLE) AS event_type_purchase,
        CAST(event_type = 'signup' AS DOUBLE) AS event_type_signup FROM events""",
    "one_hot_strict": """SELECT 'event_type' AS "column", value FROM (
        SELECT DISTINCT event_type AS value FROM events
        EXCEPT SELECT DISTINCT event_type FROM events WHERE event_type <> 'view') t""",
    "preprocess": f"""WITH g AS ({GAPS}),
        med AS (SELECT MEDIAN(value) AS m FROM g),
        mf AS (SELECT category AS c FROM g WHERE category IS NOT NULL GROUP BY category
               ORDER BY COUNT(*) DESC, category LIMIT 1),
        i AS (SELECT row_id, COALESCE(value, (SELECT m FROM med)) AS value,
                     COALESCE(category, (SELECT c FROM mf)) AS category, COALESCE(note, 'Unknown') AS note FROM g),
        s AS (SELECT AVG(value) AS mu, STDDEV_POP(value) AS sd FROM i)
        SELECT row_id, ROUND((value - mu) / CASE WHEN sd = 0 THEN 1 ELSE sd END, 6) + 0.0 AS num__value,
               CAST(category = 'N' AS DOUBLE) AS cat_f__category_N,
               CAST(category = 'R' AS DOUBLE) AS cat_f__category_R,
               CAST(note = 'O' AS DOUBLE) AS cat_c__note_O,
               CAST(note = 'Unknown' AS DOUBLE) AS cat_c__note_Unknown
        FROM i, s""",
    "preprocess_strict": """WITH s AS (SELECT AVG(p_size) AS m1, STDDEV_POP(p_size) AS s1,
                                AVG(p_retailprice) AS m2, STDDEV_POP(p_retailprice) AS s2 FROM part)
        SELECT p_partkey,
               ROUND((p_size - m1) / CASE WHEN s1 = 0 THEN 1 ELSE s1 END, 6) + 0.0 AS num__p_size,
               ROUND((p_retailprice - m2) / CASE WHEN s2 = 0 THEN 1 ELSE s2 END, 6) + 0.0 AS num__p_retailprice,
               CAST(p_type = 'LARGE' AS DOUBLE) AS cat__p_type_LARGE,
               CAST(p_type = 'MEDIUM' AS DOUBLE) AS cat__p_type_MEDIUM,
               CAST(p_type = 'PROMO' AS DOUBLE) AS cat__p_type_PROMO,
               CAST(p_type = 'SMALL' AS DOUBLE) AS cat__p_type_SMALL,
               CAST(p_type = 'STANDARD' AS DOUBLE) AS cat__p_type_STANDARD
        FROM part, s""",
    "stratified_split": """WITH n AS (SELECT event_type, COUNT(*) AS nc FROM events GROUP BY event_type),
        t AS (SELECT SUM(nc) AS n, CAST(CEIL(SUM(nc) * 0.2) AS BIGINT) AS nt FROM n),
        f AS (SELECT event_type, nc, nt, (nc * nt - (nc * nt) % t.n) / t.n AS base, (nc * nt) % t.n AS rem
              FROM n CROSS JOIN t),
        g AS (SELECT event_type, nt, base, row_number() OVER (ORDER BY rem DESC, event_type) AS rk,
                     SUM(base) OVER () AS sb FROM f),
        quota AS (SELECT event_type, base + CASE WHEN rk <= nt - sb THEN 1 ELSE 0 END AS q FROM g),
        r AS (SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type
                ORDER BY md5(concat('42:', CAST(event_id AS VARCHAR))), event_id) AS rn FROM events)
        SELECT r.event_id, r.event_type, CASE WHEN rn <= q THEN 'test' ELSE 'train' END AS split
        FROM r JOIN quota ON r.event_type = quota.event_type""",
    "confusion_matrix": f"""WITH p AS ({P}), c AS (SELECT y AS v FROM p UNION SELECT yhat FROM p),
        cnt AS (SELECT y, yhat, COUNT(*) AS n FROM p GROUP BY y, yhat)
        SELECT a.v AS y, b.v AS yhat, COALESCE(cnt.n, 0) AS n
        FROM c a CROSS JOIN c b LEFT JOIN cnt ON cnt.y = a.v AND cnt.yhat = b.v""",
    "classification_report": f"""WITH p AS ({P}), c AS (SELECT y AS v FROM p UNION SELECT yhat FROM p),
        k AS (SELECT c.v,
                (SELECT COUNT(*) FROM p WHERE y = c.v AND yhat = c.v) AS tp,
                (SELECT COUNT(*) FROM p WHERE y = c.v) AS support,
                (SELECT COUNT(*) FROM p WHERE yhat = c.v) AS predicted FROM c),
        m AS (SELECT v, tp, support,
                CASE WHEN predicted = 0 THEN 0.0 ELSE tp * 1.0 / predicted END AS precision,
                CASE WHEN support = 0 THEN 0.0 ELSE tp * 1.0 / support END AS recall FROM k),
        f AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0.0
                        ELSE 2 * precision * recall / (precision + recall) END AS f1 FROM m)
        SELECT CAST(v AS VARCHAR) AS label, ROUND(precision, 6) + 0.0 AS precision, ROUND(recall, 6) + 0.0 AS recall,
               ROUND(f1, 6) + 0.0 AS f1, support FROM f
        UNION ALL SELECT 'accuracy', NULL, NULL, ROUND(SUM(tp) * 1.0 / SUM(support), 6) + 0.0,
                         CAST(SUM(support) AS BIGINT) FROM f
        UNION ALL SELECT 'macro avg', ROUND(AVG(precision), 6) + 0.0, ROUND(AVG(recall), 6) + 0.0,
                         ROUND(AVG(f1), 6) + 0.0, CAST(SUM(support) AS BIGINT) FROM f
        UNION ALL SELECT 'weighted avg', ROUND(SUM(precision * support) / SUM(support), 6) + 0.0,
                         ROUND(SUM(recall * support) / SUM(support), 6) + 0.0,
                         ROUND(SUM(f1 * support) / SUM(support), 6) + 0.0, CAST(SUM(support) AS BIGINT) FROM f""",
    "roc_points": f"""WITH p AS ({P}),
        g AS (SELECT score AS threshold, SUM(y) AS tp, SUM(1 - y) AS fp FROM p GROUP BY score),
        w AS (SELECT threshold, SUM(tp) OVER (ORDER BY threshold DESC) AS ctp,
                     SUM(fp) OVER (ORDER BY threshold DESC) AS cfp,
                     SUM(tp) OVER () AS pos, SUM(fp) OVER () AS neg FROM g)
        SELECT threshold, CAST(ctp AS BIGINT) AS tp, CAST(cfp AS BIGINT) AS fp,
               ROUND(CASE WHEN pos = 0 THEN 0 ELSE ctp * 1.0 / pos END, 6) + 0.0 AS tpr,
               ROUND(CASE WHEN neg = 0 THEN 0 ELSE cfp * 1.0 / neg END, 6) + 0.0 AS fpr FROM w""",
    "roc_vertices": f"""WITH p AS ({P}),
        g AS (SELECT score AS threshold, SUM(y) AS tp, SUM(1 - y) AS fp FROM p GROUP BY score),
        w AS (SELECT threshold, tp, fp, SUM(tp) OVER o AS ctp, SUM(fp) OVER o AS cfp, SUM(tp) OVER () AS pos, SUM(fp) OVER () AS neg,
                     LEAD(tp) OVER o AS ntp, LEAD(fp) OVER o AS nfp FROM g WINDOW o AS (ORDER BY threshold DESC))
        SELECT CAST(NULL AS DOUBLE) AS threshold, CAST(0 AS BIGINT) AS tp, CAST(0 AS BIGINT) AS fp, 0.0::DOUBLE AS tpr, 0.0::DOUBLE AS fpr
        UNION ALL SELECT threshold, CAST(ctp AS BIGINT), CAST(cfp AS BIGINT),
               ROUND(CASE WHEN pos = 0 THEN 0 ELSE ctp * 1.0 / pos END, 6) + 0.0,
               ROUND(CASE WHEN neg = 0 THEN 0 ELSE cfp * 1.0 / neg END, 6) + 0.0 FROM w WHERE ntp IS NULL OR tp * nfp <> ntp * fp""",
    "roc_auc": f"""WITH p AS ({P}),
        g AS (SELECT score, SUM(y) AS tp, SUM(1 - y) AS fp FROM p GROUP BY score),
        w AS (SELECT fp, tp, SUM(tp) OVER (ORDER BY score DESC) AS ctp, SUM(tp) OVER () AS tpos,
                     SUM(fp) OVER () AS tneg FROM g)
        SELECT ROUND(CAST(SUM(fp * (2 * ctp - tp)) AS DOUBLE) / CAST(2 * MAX(tpos) * MAX(tneg) AS DOUBLE), 6)
               + 0.0 AS auc FROM w""",
    "linreg_fit": """WITH m AS (SELECT VAR_POP(l_quantity) v1, VAR_POP(l_discount) v2, COVAR_POP(l_quantity, l_discount) c12,
          COVAR_POP(l_extendedprice, l_quantity) c1y, COVAR_POP(l_extendedprice, l_discount) c2y,
          AVG(l_quantity) m1, AVG(l_discount) m2, AVG(l_extendedprice) my FROM lineitem),
        b AS (SELECT (c1y * v2 - c2y * c12) / (v1 * v2 - c12 * c12) b1,
                     (c2y * v1 - c1y * c12) / (v1 * v2 - c12 * c12) b2, m1, m2, my FROM m)
        SELECT ROUND(my - b1 * m1 - b2 * m2, 3) + 0.0 AS intercept, ROUND(b1, 4) + 0.0 AS coef_quantity,
               ROUND(b2, 3) + 0.0 AS coef_discount FROM b""",
    "linreg_metrics": """WITH f AS (SELECT REGR_SLOPE(l_extendedprice, l_quantity) a,
                                  REGR_INTERCEPT(l_extendedprice, l_quantity) b FROM lineitem),
        e AS (SELECT l_extendedprice AS y, l_extendedprice - (b + a * l_quantity) AS err FROM lineitem, f)
        SELECT ROUND(AVG(err * err), 2) + 0.0 AS mse,
               ROUND(1 - SUM(err * err) / (VAR_POP(y) * COUNT(*)), 6) + 0.0 AS r2 FROM e""",
    "predictions_head": """WITH f AS (SELECT REGR_SLOPE(p_retailprice, p_size) a, REGR_INTERCEPT(p_retailprice, p_size) b FROM part)
        SELECT p_partkey, ROUND(p_retailprice, 6) + 0.0 AS y_true, ROUND(b + a * p_size, 6) + 0.0 AS y_pred
        FROM part, f ORDER BY p_partkey LIMIT 20""",
    "histogram": _hist("SELECT value FROM events", "value", 30),
    "histogram_by_group": _hist_by_group("SELECT event_type, value FROM events", "event_type", "value", 30),
    "histogram_stacked": """WITH m AS (SELECT MIN(value) lo, MAX(value) hi FROM events WHERE value IS NOT NULL),
        b AS (SELECT event_type, """ + _bin("value", "lo", "hi", 30) + """ AS bin
              FROM events, m WHERE value IS NOT NULL),
        h AS (SELECT event_type, bin, COUNT(*) AS n FROM b GROUP BY event_type, bin),
        c AS (SELECT DISTINCT event_type FROM events WHERE value IS NOT NULL),
        e AS (SELECT CAST(i AS INTEGER) AS bin FROM range(30) t(i))
        SELECT c.event_type, e.bin, ROUND(lo + (hi - lo) * e.bin / 30, 6) + 0.0 AS lo_edge,
               ROUND(lo + (hi - lo) * (e.bin + 1) / 30, 6) + 0.0 AS hi_edge, COALESCE(h.n, 0) AS n
        FROM c CROSS JOIN e CROSS JOIN m LEFT JOIN h ON h.event_type = c.event_type AND h.bin = e.bin""",
    "histogram_facets": f"""WITH s AS ({SCORED}),
        pos AS (SELECT * FROM (VALUES {", ".join(f"('{lab}', {i})" for i, (_a, _b, lab) in enumerate(SHEET_BANDS, start=1))}) v(category, position)),
        sp AS (SELECT s.* FROM s WHERE category IN (SELECT category FROM pos)),
        hist AS ({_hist_by_group("SELECT * FROM sp", "category", "total_score", 15)}),
        sizes AS (SELECT category, COUNT(*) AS facet_n FROM sp GROUP BY category)
        SELECT pos.position, hist.category, sizes.facet_n, hist.bin, hist.lo_edge, hist.hi_edge, hist.n
        FROM hist JOIN sizes ON hist.category = sizes.category JOIN pos ON pos.category = hist.category""",
    "density_2d": """WITH m AS (SELECT MIN(l_quantity) xlo0, MAX(l_quantity) xhi0, MIN(l_extendedprice) ylo0,
                             MAX(l_extendedprice) yhi0 FROM lineitem),
        e AS (SELECT CASE WHEN xlo0 = xhi0 THEN xlo0 - 0.5 ELSE xlo0 END xlo, CASE WHEN xlo0 = xhi0 THEN xhi0 + 0.5 ELSE xhi0 END xhi,
                     CASE WHEN ylo0 = yhi0 THEN ylo0 - 0.5 ELSE ylo0 END ylo, CASE WHEN ylo0 = yhi0 THEN yhi0 + 0.5 ELSE yhi0 END yhi FROM m)
        SELECT l_returnflag, """ + _bin("l_quantity", "xlo", "xhi", 20) + """ AS bx,
               """ + _bin("l_extendedprice", "ylo", "yhi", 20) + """ AS "by",
               COUNT(*) AS n
        FROM lineitem, e GROUP BY ALL""",
    "hash_sample": """SELECT event_id, event_type, value, md5(concat('42:', CAST(event_id AS VARCHAR))) AS sample_hash
        FROM events ORDER BY sample_hash, event_id LIMIT 100""",
    "hash_sample_by_group": """SELECT event_id, event_type, value, md5(concat('42:', CAST(event_id AS VARCHAR))) AS sample_hash
        FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY sample_hash, event_id) <= 25""",
    "pairwise_corr": """WITH c AS (SELECT CORR(l_quantity, l_extendedprice) a, CORR(l_quantity, l_discount) b,
                             CORR(l_extendedprice, l_discount) c FROM lineitem)
        SELECT 'l_quantity' AS x, 'l_extendedprice' AS y, ROUND(a, 6) + 0.0 AS corr FROM c UNION ALL
        SELECT 'l_quantity', 'l_discount', ROUND(b, 6) + 0.0 FROM c UNION ALL
        SELECT 'l_extendedprice', 'l_discount', ROUND(c, 6) + 0.0 FROM c""",
}
