"""Registry of runnable queries and their independent SQL oracles.

``QUERIES``: name -> (spark, sf_dir) -> DataFrame.  ``ORACLE_SQL``: the same
result written as plain SQL over the driver's tables (DuckDB dialect), used
to check the Spark operators.  Queries whose output depends on randomness
or model fitting (SMOTE, trained models) have no oracle entry; their
properties are checked by invariant tests instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lodestar.plans import evaluation as E
from lodestar.plans import features as Fe
from lodestar.plans import reports as Rp
from lodestar.plans.tasks import TASK_ORACLE_SQL, TASK_QUERIES

Query = Callable[[SparkSession, str], DataFrame]


# the word definition of functions.exprs.WORD_PATTERN, as an RE2 pattern
_WORDRE = "[^ \\t\\n\\r\\f]+"


def _enc(expr: str) -> str:
    """SQL label code: 0-based dense rank in string order."""
    return f"CAST(dense_rank() OVER (ORDER BY {expr}) - 1 AS INTEGER)"


# ---------------------------------------------------------------- F7 / F6
_MP_ROWS = """
WITH first_src AS (
  SELECT c.c_name AS name, c.c_acctbal AS price, n.n_name AS state,
         lower(c.c_mktsegment) AS area_type,
         least(greatest(c.c_acctbal / 1000.0, 0.0), 5.0) AS lot, 'C' AS country_flag
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  WHERE c.c_acctbal > 0 AND c.c_acctbal < 9000 AND c.c_nationkey BETWEEN 1 AND 23
    AND n.n_name IS NOT NULL AND c.c_mktsegment IS NOT NULL
),
lot_med AS (SELECT median(lot) AS lot FROM first_src),
second_src AS (
  SELECT s.s_name AS name, s.s_acctbal AS price, n.n_name AS state,
         CASE WHEN s.s_acctbal >= 5000 THEN 'urban' WHEN s.s_acctbal >= 1000 THEN 'suburban' ELSE 'rural' END AS area_type,
         (SELECT lot FROM lot_med) AS lot, 'S' AS country_flag
  FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
  WHERE s.s_acctbal > -500 AND s.s_acctbal < 9500 AND s.s_nationkey BETWEEN 0 AND 24 AND n.n_name IS NOT NULL
),
combined AS (SELECT * FROM first_src UNION ALL SELECT * FROM second_src),
med AS (SELECT state, median(price) AS state_median FROM combined WHERE price IS NOT NULL GROUP BY state),
flagged AS (
  SELECT c.*, m.state_median, CAST(coalesce(c.price > m.state_median, false) AS INTEGER) AS above_market
  FROM combined c LEFT JOIN med m ON c.state = m.state
),
mp_rows AS (
  SELECT name, country_flag, state, price, round(lot, 6) AS lot, area_type,
         round(state_median, 4) AS state_median, above_market,
         """ + _enc("coalesce(area_type, 'suburban')") + """ AS area_enc,
         """ + _enc("coalesce(state, 'Unknown')") + """ AS state_enc
  FROM flagged
)
"""

SQL_MARKET_POSITION = _MP_ROWS + "SELECT * FROM mp_rows"

SQL_MARKET_POSITION_SUMMARY = _MP_ROWS + """
SELECT state, count(*) AS n_rows,
       CAST(sum(CASE WHEN country_flag = 'C' THEN 1 ELSE 0 END) AS BIGINT) AS n_first,
       max(state_median) AS state_median,
       round(avg(CAST(above_market AS DOUBLE)) * 100.0, 4) AS above_pct
FROM mp_rows GROUP BY state ORDER BY state
"""

SQL_MARKET_POSITION_SINGLE = """
WITH listings AS (
  SELECT o.o_orderkey, o.o_totalprice AS price, n.n_name AS state, o.o_orderpriority,
         least(greatest(o.o_totalprice / 100000.0, 0.0), 4.0) AS lot
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  WHERE o.o_totalprice > 10000 AND o.o_totalprice < 450000 AND n.n_name IS NOT NULL
),
med AS (SELECT state, median(price) AS m FROM listings GROUP BY state),
f AS (SELECT l.*, CAST(coalesce(l.price > med.m, false) AS INTEGER) AS above_market
      FROM listings l LEFT JOIN med ON l.state = med.state)
SELECT o_orderkey, state, price, lot, above_market,
       """ + _enc("coalesce(state, 'Unknown')") + """ AS state_enc,
       """ + _enc("o_orderpriority") + """ AS priority_enc
FROM f
"""

# ---------------------------------------------------------------- F1
SQL_CHURN = """
WITH per_order AS (
  SELECT l_orderkey, count(*) AS n_lines, sum(l_quantity) AS qty, avg(l_discount) AS disc
  FROM lineitem GROUP BY l_orderkey
),
monthly AS (SELECT o.*, p.n_lines, p.qty, p.disc FROM orders o LEFT JOIN per_order p ON o.o_orderkey = p.l_orderkey),
agg AS (
  SELECT o_custkey AS customer_id, avg(n_lines) AS avg_calls, avg(qty) AS avg_views, avg(disc) AS avg_discount,
         avg(o_totalprice) AS avg_revenue, CAST(coalesce(sum(n_lines), 0) AS BIGINT) AS total_deals,
         count(o_orderkey) AS months_active, max(o_orderstatus = 'F') AS churned_b
  FROM monthly WHERE o_custkey IS NOT NULL GROUP BY o_custkey
),
df AS (SELECT a.*, c.c_mktsegment, c.c_nationkey, c.c_acctbal FROM agg a LEFT JOIN customer c ON a.customer_id = c.c_custkey)
SELECT customer_id,
       CAST(CASE WHEN lower(CAST(churned_b AS VARCHAR)) = 'true' THEN 1
                 WHEN lower(CAST(churned_b AS VARCHAR)) = 'false' THEN 0 END AS INTEGER) AS churned,
       """ + _enc("coalesce(c_mktsegment, 'End-User')") + """ AS segment_enc,
       coalesce(c_nationkey, 0) AS nation,
       round(coalesce(avg_calls, 0.0), 6) AS avg_calls,
       round(coalesce(avg_views, 0.0), 6) AS avg_views,
       round(coalesce(avg_discount, 0.0), 6) AS avg_discount,
       round(coalesce(avg_revenue, 0.0), 6) AS avg_revenue,
       round(coalesce(c_acctbal, 0.0), 6) AS c_acctbal,
       total_deals, months_active
FROM df
"""

# ---------------------------------------------------------------- F2
SQL_CONTENT = """
SELECT o_orderkey,
       CAST(coalesce(o_orderpriority IN ('1-URGENT', '2-HIGH'), false) AS INTEGER) AS target,
       coalesce(""" + _enc("coalesce(o_orderstatus, 'O')") + """, 0) AS status_enc,
       CAST(coalesce(isodow(o_orderdate) - 1, 0) AS INTEGER) AS order_dow,
       CAST(month(o_orderdate) AS INTEGER) AS order_month,
       coalesce(o_totalprice, 0.0) AS o_totalprice
FROM orders
"""


def _impute(cols: list[str], src: str) -> str:
    """SQL median imputation of each column (cast to double)."""
    sel = ",\n       ".join(f"coalesce(CAST({c} AS DOUBLE), median(CAST({c} AS DOUBLE)) OVER ()) AS {c}" for c in cols)
    return sel


def _num(expr: str) -> str:
    return f"TRY_CAST(trim(CAST({expr} AS VARCHAR)) AS DOUBLE)"


# ---------------------------------------------------------------- F3
SQL_LISTING = """
WITH j AS (
  SELECT l.l_orderkey, l.l_linenumber,
         CASE WHEN l.l_linestatus = 'F' THEN 1 ELSE 0 END AS sold,
         """ + _num("split_part(p.p_brand, '#', 2)") + """ AS brand_no,
         """ + _num("p.p_size") + """ AS p_size,
         """ + _num("p.p_retailprice") + """ AS p_retailprice,
         """ + _num("l.l_quantity") + """ AS l_quantity,
         """ + _num("l.l_extendedprice") + """ AS l_extendedprice,
         CASE WHEN p.p_size > 25 THEN 1 ELSE 0 END AS big_part,
         """ + _enc("coalesce(p.p_type, 'STANDARD')") + """ AS type_enc,
         """ + _enc("coalesce(l.l_returnflag, 'N')") + """ AS flag_enc
  FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey
)
SELECT l_orderkey, l_linenumber, CAST(sold AS INTEGER) AS sold,
       """ + _impute(["type_enc", "flag_enc", "brand_no", "p_size", "p_retailprice", "l_quantity", "l_extendedprice", "big_part"], "j") + """
FROM j
"""

# ---------------------------------------------------------------- F4
SQL_AD = """
WITH m AS (SELECT median(value) AS mv FROM events),
b AS (
  SELECT event_id,
         CAST(coalesce(value > (SELECT mv FROM m), false) AS INTEGER) AS target,
         """ + _enc("coalesce(event_type, 'view')") + """ AS type_enc,
         CAST(coalesce(hour(ts), 12) AS INTEGER) AS hour,
         CAST(coalesce(isodow(ts) - 1, 0) AS INTEGER) AS dow,
         """ + _num("regexp_extract(props, '(-?\\d+)', 1)") + """ AS props_k,
         CAST(user_id AS DOUBLE) AS user_id,
         value
  FROM events
)
SELECT event_id, target,
       """ + _impute(["type_enc", "hour", "dow", "props_k", "user_id", "value"], "b") + """
FROM b
"""

# ---------------------------------------------------------------- F5
SQL_SALE_VS_ASK = """
WITH r AS (
  SELECT l_orderkey, l_linenumber,
         CASE WHEN l_quantity * 1000.0 = 0 THEN NULL ELSE l_extendedprice / (l_quantity * 1000.0) END AS ratio,
         l_returnflag, l_linestatus, l_quantity
  FROM lineitem
),
f AS (SELECT * FROM r WHERE coalesce(ratio BETWEEN 0.5 AND 2.0, false)),
g AS (
  SELECT l_orderkey, l_linenumber, ratio, CAST(coalesce(ratio >= 1.0, false) AS INTEGER) AS target,
         """ + _enc("coalesce(l_returnflag, 'N')") + """ AS type_enc,
         """ + _enc("coalesce(l_linestatus, '')") + """ AS sub_type_enc,
         l_quantity
  FROM f
)
SELECT l_orderkey, l_linenumber, ratio, target,
       """ + _impute(["type_enc", "sub_type_enc", "l_quantity"], "g") + """
FROM g
"""

# ---------------------------------------------------------------- F8
_CATEGORY_VALUES = ", ".join(
    "(" + str(k) + ", '" + v.replace("'", "''") + "')" for k, v in sorted(Fe.CATEGORY_NAMES.items())
)

SQL_VIDEO = """
WITH d AS (
  SELECT d.doc_id, d.lang AS country, d.source AS title, d.n_chars AS views,
         coalesce(len(regexp_extract_all(d.text, '""" + _WORDRE + """')), 0) AS likes,
         length(d.text) - length(replace(d.text, chr(10), '')) + 1 AS comments,
         CASE WHEN d.text IS NULL OR d.text = '' OR d.text = '[none]' THEN 0
              ELSE length(d.text) - length(replace(d.text, '.', '')) + 1 END AS tag_count,
         TRY_CAST(CAST(e.ts AS VARCHAR) AS TIMESTAMP) AS publish_time,
         CAST(d.n_chars % 30 AS INTEGER) AS category_id
  FROM documents d LEFT JOIN events e ON d.doc_id = e.event_id
  WHERE coalesce(d.n_chars > 0, false)
),
f AS (
  SELECT doc_id, country, category_id,
         CASE WHEN views = 0 THEN NULL ELSE CAST(likes AS DOUBLE) / CAST(views AS DOUBLE) END AS like_rate,
         CASE WHEN views = 0 THEN NULL ELSE CAST(comments AS DOUBLE) / CAST(views AS DOUBLE) END AS comment_rate,
         ln(1 + CAST(views AS DOUBLE)) AS log_views,
         length(coalesce(title, '')) AS title_length,
         CAST(tag_count AS INTEGER) AS tag_count,
         CAST(coalesce(hour(publish_time), 12) AS INTEGER) AS publish_hour,
         CAST(coalesce(isodow(publish_time) - 1, 0) AS INTEGER) AS publish_dow
  FROM d
),
t AS (
  SELECT f.*, CAST(coalesce(like_rate > (SELECT median(like_rate) FROM f), false) AS INTEGER) AS target,
         coalesce(cat.name, 'Category ' || CAST(f.category_id AS VARCHAR)) AS category,
         """ + _enc("coalesce(CAST(f.category_id AS VARCHAR), '24')") + """ AS cat_enc,
         """ + _enc("f.country") + """ AS country_enc
  FROM f LEFT JOIN (VALUES """ + _CATEGORY_VALUES + """) AS cat(id, name) ON f.category_id = cat.id
),
i AS (
  SELECT doc_id, country, category, target, like_rate,
         """ + _impute(["cat_enc", "country_enc", "title_length", "tag_count", "publish_hour", "publish_dow", "log_views", "comment_rate"], "t") + """
  FROM t
)
SELECT doc_id, country, category, cat_enc, country_enc, title_length, tag_count, publish_hour, publish_dow,
       round(log_views, 8) AS log_views, round(comment_rate, 8) AS comment_rate,
       round(like_rate, 8) AS like_rate, target
FROM i
"""

# ---------------------------------------------------------------- F9
SQL_ML_READY = """
WITH base AS (
  SELECT l.doc_id, l.quality, l.toxic, trim(d.lang) AS lang, trim(d.source) AS source, d.n_chars
  FROM labels l LEFT JOIN documents d ON l.doc_id = d.doc_id
),
dd AS (SELECT DISTINCT * FROM base)
SELECT doc_id, quality, CAST(toxic AS INTEGER) AS churn,
       """ + _enc("lang") + """ AS lang,
       """ + _enc("source") + """ AS source,
       n_chars
FROM dd
"""


# ---------------------------------------------------------------- profiles
def _profile_sql(table: str, cols: list[tuple[str, str]]) -> str:
    parts = []
    for i, (c, t) in enumerate(cols):
        numeric = t in ("bigint", "int", "double")
        med = f"round(median(CAST({c} AS DOUBLE)), 6)" if numeric else "CAST(NULL AS DOUBLE)"
        std = f"round(stddev_samp(CAST({c} AS DOUBLE)), 6)" if numeric else "CAST(NULL AS DOUBLE)"
        mode = (
            f"(SELECT {c} FROM {table} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"
            if t == "string"
            else "CAST(NULL AS VARCHAR)"
        )
        parts.append(
            f"SELECT '{c}' AS \"column\", '{t}' AS dtype, CAST({i} AS INTEGER) AS ordinal, count(*) AS n_rows, "
            f"count({c}) AS non_null, count(DISTINCT {c}) AS n_distinct, {med} AS median, {std} AS std, {mode} AS mode FROM {table}"
        )
    return "\nUNION ALL\n".join(parts)


SQL_PROFILE_CUSTOMER = _profile_sql(
    "customer",
    [("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"), ("c_acctbal", "double"), ("c_mktsegment", "string")],
)
SQL_PROFILE_EVENTS = _profile_sql(
    "events",
    [("event_id", "bigint"), ("ts", "timestamp_ntz"), ("user_id", "bigint"), ("event_type", "string"), ("value", "double"), ("props", "string")],
)

SQL_VALUE_COUNTS_LANG = "SELECT lang, count(*) AS count FROM documents GROUP BY lang ORDER BY count DESC, lang"

SQL_CLASS_BALANCE = """
WITH long AS (
  SELECT 'quality' AS task, quality AS class FROM labels
  UNION ALL SELECT 'toxic' AS task, toxic AS class FROM labels
)
SELECT task, class, count(*) AS n,
       round(count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY task), 4) AS pct
FROM long GROUP BY task, class
"""

_LF = Rp.LINE_FEATURES
SQL_CORR_LINEITEM = "\nUNION ALL\n".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 2) + 0.0 AS r FROM lineitem"
    for i, a in enumerate(_LF)
    for b in _LF[i + 1 :]
)

SQL_LABEL_CODES = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", label, {_enc('label')} AS code "
    f"FROM (SELECT DISTINCT CAST({c} AS VARCHAR) AS label FROM orders WHERE {c} IS NOT NULL)"
    for c in ["o_orderstatus", "o_orderpriority"]
)

SQL_MINMAX = (
    "WITH b AS (SELECT "
    + ", ".join(f"min({c}) AS {c}_lo, max({c}) AS {c}_hi" for c in _LF)
    + " FROM lineitem)\nSELECT l_orderkey, l_linenumber, "
    + ", ".join(
        f"round(CASE WHEN {c}_hi - {c}_lo = 0 THEN 0.0 ELSE ({c} - {c}_lo) / ({c}_hi - {c}_lo) END, 6) AS {c}" for c in _LF
    )
    + "\nFROM lineitem, b"
)

SQL_SPLIT_SIZES = """
WITH c AS (SELECT quality, count(*) AS n FROM labels GROUP BY quality),
t AS (SELECT sum(n) AS total FROM c),
a AS (SELECT c.quality, c.n, t.total, CAST(ceil(0.2 * t.total) AS BIGINT) AS n_test_all FROM c, t),
b AS (SELECT *, total - n_test_all AS n_train_all FROM a),
f AS (SELECT *, floor(CAST(n AS DOUBLE) / total * n_train_all) AS fl,
             CAST(n AS DOUBLE) / total * n_train_all - floor(CAST(n AS DOUBLE) / total * n_train_all) AS rem FROM b),
g AS (SELECT *, n_train_all - sum(fl) OVER () AS need,
             row_number() OVER (ORDER BY rem DESC, CAST(quality AS VARCHAR)) AS rk FROM f)
SELECT quality, n,
       CAST(n - (fl + CASE WHEN rk <= need THEN 1 ELSE 0 END) AS BIGINT) AS n_test,
       CAST(fl + CASE WHEN rk <= need THEN 1 ELSE 0 END AS BIGINT) AS n_train
FROM g
"""

SQL_SAMPLE_SIZE = "SELECT CAST(least(500, count(*)) AS BIGINT) AS n_sampled FROM lineitem"

_TABLE_COLS = {
    "region": 2, "nation": 3, "customer": 5, "supplier": 4, "part": 6, "orders": 6, "lineitem": 11,
    "events": 6, "documents": 5, "embeddings": 3, "pages": 3, "benchmark": 2, "labels": 3, "conversations": 4,
}
_REGISTRY = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, count(*) AS rows, CAST({n} AS BIGINT) AS n_cols FROM {t}" for t, n in _TABLE_COLS.items()
)
SQL_TABLE_REGISTRY = _REGISTRY
SQL_LARGEST_TABLE = (
    "SELECT table_name, rows, n_cols, rows * n_cols AS area FROM (" + _REGISTRY + ") ORDER BY area DESC, table_name LIMIT 1"
)

SQL_TAGGED_SCAN = "\nUNION ALL\n".join(f"SELECT '{t}' AS tag, count(*) AS n_rows FROM {t}" for t in Rp.TAGGED)

SQL_CANDIDATES = """
WITH best AS (SELECT lang, source, min(doc_id) AS pos FROM documents GROUP BY lang, source),
q0 AS (SELECT lang, source, pos, 0 AS query_rank, row_number() OVER (ORDER BY pos, source) AS slot
       FROM best WHERE lang = 'de' QUALIFY slot <= 2),
q1 AS (SELECT lang, source, pos, 1 AS query_rank, row_number() OVER (ORDER BY pos, source) AS slot
       FROM best WHERE lang = 'en' AND source NOT IN (SELECT source FROM q0) QUALIFY slot <= 2),
q2 AS (SELECT lang, source, pos, 2 AS query_rank, row_number() OVER (ORDER BY pos, source) AS slot
       FROM best WHERE lang = 'es' AND source NOT IN (SELECT source FROM q0 UNION ALL SELECT source FROM q1) QUALIFY slot <= 2),
q3 AS (SELECT lang, source, pos, 3 AS query_rank, row_number() OVER (ORDER BY pos, source) AS slot
       FROM best WHERE lang = 'fr' AND source NOT IN (SELECT source FROM q0 UNION ALL SELECT source FROM q1 UNION ALL SELECT source FROM q2)
       QUALIFY slot <= 2),
allq AS (SELECT * FROM q0 UNION ALL SELECT * FROM q1 UNION ALL SELECT * FROM q2 UNION ALL SELECT * FROM q3)
SELECT lang, source, pos AS doc_id, CAST(query_rank AS INTEGER) AS query_rank, CAST(slot AS INTEGER) AS slot FROM allq
"""

SQL_TOP_PARTS = """
SELECT p_brand, p_partkey, p_retailprice, rank FROM (
  SELECT p_brand, p_partkey, p_retailprice,
         CAST(row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS INTEGER) AS rank
  FROM part) WHERE rank <= 5
"""

SQL_RUNNING_BEST = """
SELECT event_type, day, max(value) AS iter_value,
       max(max(value)) OVER (PARTITION BY event_type ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS best_value
FROM (SELECT event_type, CAST(day(ts) AS INTEGER) AS day, value FROM events)
GROUP BY event_type, day
"""

_PF = _LF + ["returned"]
SQL_PRUNED = (
    "WITH li AS (SELECT *, CAST(l_returnflag = 'R' AS INTEGER) AS returned FROM lineitem),\n"
    "imp AS (\n"
    + "\nUNION ALL\n".join(f"SELECT '{c}' AS feature, round(abs(corr({c}, returned)), 6) AS importance FROM li" for c in _LF)
    + "),\npairs AS (\n"
    + "\nUNION ALL\n".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 2) AS r FROM li" for i, a in enumerate(_PF) for b in _PF[i + 1 :]
    )
    + """),
strong AS (
  SELECT p.a, p.b, ia.importance AS imp_a, ib.importance AS imp_b
  FROM pairs p LEFT JOIN imp ia ON p.a = ia.feature LEFT JOIN imp ib ON p.b = ib.feature
  WHERE abs(p.r) > 0.95
),
losers AS (SELECT DISTINCT CASE WHEN coalesce(imp_a, 0.0) < coalesce(imp_b, 0.0) THEN a ELSE b END AS feature FROM strong),
kept AS (SELECT * FROM imp WHERE importance > 0.001 AND feature NOT IN (SELECT feature FROM losers))
SELECT feature, importance, CAST(row_number() OVER (ORDER BY importance DESC, feature) AS INTEGER) AS rank FROM kept
"""
)

# ---------------------------------------------------------------- evaluation
_WORDS = "coalesce(len(regexp_extract_all(d.text, '" + _WORDRE + "')), 0)"
_SCORED = """
WITH base AS (
  SELECT l.doc_id, l.quality, l.toxic, CAST(d.n_chars AS DOUBLE) AS n_chars,
         CAST(""" + _WORDS + """ AS DOUBLE) AS words,
         CAST(length(d.text) - length(replace(d.text, chr(10), '')) + 1 AS DOUBLE) AS lines
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id
),
tasks AS (
  SELECT doc_id, 'quality' AS task, quality AS label, n_chars, words, lines FROM base
  UNION ALL SELECT doc_id, 'toxic' AS task, toxic AS label, n_chars, words, lines FROM base
),
scored AS (
""" + "\n  UNION ALL\n".join(
    f"  SELECT doc_id, task, label, '{m}' AS model, {o} AS model_order, {c} / ({c} + {k}) AS score FROM tasks"
    for m, o, c, k in E.SCORERS
) + """
),
s AS (SELECT *, CAST(coalesce(score >= 0.5, false) AS INTEGER) AS prediction FROM scored)
"""

SQL_HEURISTIC_SCORES = _SCORED + """
SELECT doc_id, task, model, label, prediction, round(score, 8) AS score,
       CASE WHEN prediction = 0 THEN 'Negative' WHEN prediction = 1 THEN 'Positive' END AS prediction_label,
       round(score * 100.0, 1) AS probability_pct
FROM s
"""

_COUNTS = """,
c AS (
  SELECT task, model, model_order,
         CAST(sum(CASE WHEN label = 1 AND prediction = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
         CAST(sum(CASE WHEN label = 0 AND prediction = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
         CAST(sum(CASE WHEN label = 0 AND prediction = 0 THEN 1 ELSE 0 END) AS BIGINT) AS tn,
         CAST(sum(CASE WHEN label = 1 AND prediction = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fn
  FROM s GROUP BY task, model, model_order
),
bm AS (
  SELECT task, model, model_order, tp, fp, tn, fn,
         round(CASE WHEN tp + fp + tn + fn = 0 THEN 0.0 ELSE CAST(tp + tn AS DOUBLE) / (tp + fp + tn + fn) END, 4) AS accuracy,
         round(CASE WHEN tp + fp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END, 4) AS precision,
         round(CASE WHEN tp + fn = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fn) END, 4) AS recall,
         round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn) END, 4) AS f1
  FROM c
),
hist AS (
  SELECT task, model, model_order, score,
         sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS pos, sum(CASE WHEN label = 0 THEN 1 ELSE 0 END) AS neg
  FROM s GROUP BY task, model, model_order, score
),
cum AS (
  SELECT *, coalesce(sum(neg) OVER (PARTITION BY task, model ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
  FROM hist
),
auc AS (
  SELECT task, model, model_order,
         CASE WHEN sum(pos) = 0 OR sum(neg) = 0 THEN NULL
              ELSE sum(pos * (below + neg * 0.5)) / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) END AS auc_raw
  FROM cum GROUP BY task, model, model_order
),
scores AS (
  SELECT bm.task, bm.model, bm.model_order, accuracy, precision, recall, f1, round(auc_raw, 4) AS roc_auc
  FROM bm JOIN auc ON bm.task = auc.task AND bm.model = auc.model
)
"""

SQL_BINARY_METRICS = _SCORED + _COUNTS + "SELECT task, model, tp, fp, tn, fn, accuracy, precision, recall, f1 FROM bm"

SQL_CONFUSION = _SCORED + _COUNTS + """
SELECT task, model, actual, predicted, count FROM (
  SELECT task, model, 0 AS actual, 0 AS predicted, tn AS count FROM c
  UNION ALL SELECT task, model, 0, 1, fp FROM c
  UNION ALL SELECT task, model, 1, 0, fn FROM c
  UNION ALL SELECT task, model, 1, 1, tp FROM c)
"""

SQL_AUC = _SCORED + _COUNTS + "SELECT task, model, round(auc_raw, 6) AS roc_auc FROM auc"

SQL_ROC = _SCORED + _COUNTS + """,
pts AS (
  SELECT task, model, score,
         sum(pos) OVER (PARTITION BY task, model ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cp,
         sum(neg) OVER (PARTITION BY task, model ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cn,
         sum(pos) OVER (PARTITION BY task, model) AS tp_all,
         sum(neg) OVER (PARTITION BY task, model) AS tn_all
  FROM hist
)
SELECT task, model, round(score, 8) AS threshold,
       round(CASE WHEN tn_all = 0 THEN 0.0 ELSE CAST(cn AS DOUBLE) / tn_all END, 6) AS fpr,
       round(CASE WHEN tp_all = 0 THEN 0.0 ELSE CAST(cp AS DOUBLE) / tp_all END, 6) AS tpr
FROM pts
""".replace("\n,\npts AS", ",\npts AS")

SQL_RANKING = _SCORED + _COUNTS + """
SELECT task, model, accuracy, precision, recall, f1, roc_auc,
       CAST(row_number() OVER (PARTITION BY task ORDER BY f1 DESC, model) AS INTEGER) AS rank
FROM scores
"""

SQL_BEST = _SCORED + _COUNTS + """
SELECT task, model, accuracy, precision, recall, f1, roc_auc FROM (
  SELECT *, row_number() OVER (PARTITION BY task ORDER BY f1 DESC, model_order) AS k FROM scores) WHERE k = 1
"""

SQL_BEST_MEAN = _SCORED + _COUNTS + """
SELECT task, model, accuracy, precision, recall, f1, roc_auc FROM (
  SELECT *, row_number() OVER (PARTITION BY task ORDER BY (0.0 + f1 + roc_auc) / 2 DESC, model_order) AS k FROM scores) WHERE k = 1
"""

SQL_SCORE_CARDS = _SCORED + _COUNTS + """
SELECT task, max(f1) AS best_f1, arg_max(model, f1 * 100 - model_order * 0.0001) AS best_f1_model,
       max(roc_auc) AS best_roc_auc, arg_max(model, roc_auc * 100 - model_order * 0.0001) AS best_roc_auc_model,
       round(avg(accuracy), 4) AS avg_accuracy, count(*) AS n_models
FROM scores GROUP BY task
"""

SQL_METRIC_LONG = _SCORED + _COUNTS + """
SELECT task, model, metric, value FROM (
  SELECT task, model, 'accuracy' AS metric, accuracy AS value FROM scores
  UNION ALL SELECT task, model, 'precision', precision FROM scores
  UNION ALL SELECT task, model, 'recall', recall FROM scores
  UNION ALL SELECT task, model, 'f1', f1 FROM scores
  UNION ALL SELECT task, model, 'roc_auc', roc_auc FROM scores)
"""

SQL_F1_PIVOT = _SCORED + _COUNTS + """
SELECT model, max(CASE WHEN task = 'quality' THEN f1 END) AS quality, max(CASE WHEN task = 'toxic' THEN f1 END) AS toxic
FROM scores GROUP BY model
"""


SQL_CSV_ROUNDTRIP = """
SELECT c_mktsegment, count(*) AS n, round(sum(c_acctbal), 2) AS acctbal_sum, max(c_custkey) AS max_key
FROM customer GROUP BY c_mktsegment
"""

SQL_CSV_HARD = f"SELECT doc_id, lang, md5(nullif({Rp.HARD_TEXT}, 'NA')) AS digest FROM documents"

_PN = [*Rp.LINE_FEATURES, *Rp.DERIVED]
SQL_PRUNED_CORRELATED = (
    f"WITH li AS (SELECT {', '.join(Rp.LINE_FEATURES)}, {', '.join(f'{e} AS {c}' for c, e in Rp.DERIVED.items())}, "
    "CAST(l_returnflag = 'R' AS INTEGER) AS returned FROM lineitem),\npairs AS (\n"
    + "\nUNION ALL\n".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM li" for i, a in enumerate(_PN) for b in _PN[i + 1 :])
    + "),\nimp AS (\n"
    + "\nUNION ALL\n".join(f"SELECT '{c}' AS feature, round(abs(corr({c}, returned)), 6) AS importance FROM li" for c in _PN)
    + """),
losers AS (SELECT DISTINCT CASE WHEN ia.importance < ib.importance THEN p.a ELSE p.b END AS feature
           FROM pairs p JOIN imp ia ON p.a = ia.feature JOIN imp ib ON p.b = ib.feature WHERE abs(p.r) > 0.95),
kept AS (SELECT * FROM imp WHERE importance > 0.0 AND feature NOT IN (SELECT feature FROM losers))
SELECT feature, importance, CAST(row_number() OVER (ORDER BY importance DESC, feature) AS INTEGER) AS rank FROM kept"""
)

# the largest table is lineitem; its last column with two values is the target
SQL_ML_READY_ALL = """
SELECT DISTINCT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
  CAST(dense_rank() OVER (ORDER BY l_returnflag) - 1 AS INTEGER) AS l_returnflag,
  CAST(dense_rank() OVER (ORDER BY l_linestatus) - 1 AS INTEGER) AS churn, l_shipdate
FROM lineitem
"""

SQL_CATALOG_LOAD = "\nUNION ALL\n".join(
    f"SELECT 'raw_{t}_data' AS \"table\", count(*) AS rows, CAST({_TABLE_COLS[t]} AS BIGINT) AS n_cols, count(*) AS scanned FROM {t}"
    for t in Rp.LOADED
)

SQL_LABEL_LISTS = SQL_LABEL_CODES

SQL_DESCRIBE = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, "
    f"min({c}) + 0.0 AS min, max({c}) + 0.0 AS max FROM lineitem"
    for c in _LF
)

SQL_USER_UNITS = """
SELECT doc_id, round(ln(1 + CAST(n_chars AS DOUBLE)), 8) AS log_views, CAST(n_chars % 97 AS DOUBLE) / 1000.0 AS comment_rate
FROM documents
"""

QUERIES: dict[str, Query] = {
    # F7/F6 and the flagship
    "market_position_summary": Fe.market_position_summary,
    "market_position_rows": Fe.market_position,
    "market_position_single_source": Fe.market_position_single,
    # feature tables
    "churn_features": Fe.churn_features,
    "content_features": Fe.content_features,
    "listing_sold_features": Fe.listing_sold_features,
    "ad_conversion_features": Fe.ad_conversion_features,
    "sale_vs_ask_features": Fe.sale_vs_ask_features,
    "video_engagement_features": Fe.video_engagement_features,
    "generic_ml_ready": Fe.generic_ml_ready,
    # profiling and statistics
    "profile_customer": Rp.profile_customer,
    "profile_events": Rp.profile_events,
    "value_counts_lang": Rp.value_counts_lang,
    "class_balance": Rp.class_balance,
    "corr_lineitem": Rp.corr_lineitem,
    "label_codes_orders": Rp.label_codes_orders,
    "minmax_lineitem": Rp.minmax_lineitem,
    "stratified_split_sizes": Rp.split_sizes,
    "exact_sample_size": Rp.sample_size,
    "pruned_features": Rp.pruned_features,
    # catalog and sources
    "table_registry": Rp.table_registry,
    "largest_table": Rp.largest_table,
    "tagged_scan": Rp.tagged_scan,
    "candidate_manifest": Rp.candidate_manifest,
    "csv_roundtrip": Rp.csv_roundtrip,
    "csv_hard_roundtrip": Rp.csv_hard_roundtrip,
    "pruned_correlated_features": Rp.pruned_correlated_features,
    "generic_ml_ready_all": Fe.generic_ml_ready_all,
    "catalog_load": Rp.catalog_load,
    "label_lists_json": Rp.label_lists_json,
    "describe_lineitem": Rp.describe_lineitem,
    "user_unit_conversion": Rp.user_unit_conversion,
    # ranking
    "top_parts_per_brand": Rp.top_parts_per_brand,
    "running_best_daily": Rp.running_best_daily,
    # evaluation
    "heuristic_scores": E.heuristic_scores,
    "binary_metrics": E.binary_metrics_table,
    "confusion_matrix": E.confusion_table,
    "roc_auc": E.auc_table,
    "roc_points": E.roc_table,
    "model_ranking": E.model_ranking,
    "best_models": E.best_models,
    "best_models_mean": E.best_models_mean,
    "score_cards": E.score_cards,
    "metric_long": E.metric_long,
    "f1_pivot": E.f1_pivot,
    # feature tables on their own columns
    **TASK_QUERIES,
}

ORACLE_SQL: dict[str, str] = {
    "market_position_summary": SQL_MARKET_POSITION_SUMMARY,
    "market_position_rows": SQL_MARKET_POSITION,
    "market_position_single_source": SQL_MARKET_POSITION_SINGLE,
    "churn_features": SQL_CHURN,
    "content_features": SQL_CONTENT,
    "listing_sold_features": SQL_LISTING,
    "ad_conversion_features": SQL_AD,
    "sale_vs_ask_features": SQL_SALE_VS_ASK,
    "video_engagement_features": SQL_VIDEO,
    "generic_ml_ready": SQL_ML_READY,
    "profile_customer": SQL_PROFILE_CUSTOMER,
    "profile_events": SQL_PROFILE_EVENTS,
    "value_counts_lang": SQL_VALUE_COUNTS_LANG,
    "class_balance": SQL_CLASS_BALANCE,
    "corr_lineitem": SQL_CORR_LINEITEM,
    "label_codes_orders": SQL_LABEL_CODES,
    "minmax_lineitem": SQL_MINMAX,
    "stratified_split_sizes": SQL_SPLIT_SIZES,
    "exact_sample_size": SQL_SAMPLE_SIZE,
    "pruned_features": SQL_PRUNED,
    "table_registry": SQL_TABLE_REGISTRY,
    "largest_table": SQL_LARGEST_TABLE,
    "tagged_scan": SQL_TAGGED_SCAN,
    "candidate_manifest": SQL_CANDIDATES,
    "csv_roundtrip": SQL_CSV_ROUNDTRIP,
    "csv_hard_roundtrip": SQL_CSV_HARD,
    "pruned_correlated_features": SQL_PRUNED_CORRELATED,
    "generic_ml_ready_all": SQL_ML_READY_ALL,
    "catalog_load": SQL_CATALOG_LOAD,
    "label_lists_json": SQL_LABEL_LISTS,
    "describe_lineitem": SQL_DESCRIBE,
    "user_unit_conversion": SQL_USER_UNITS,
    "top_parts_per_brand": SQL_TOP_PARTS,
    "running_best_daily": SQL_RUNNING_BEST,
    "heuristic_scores": SQL_HEURISTIC_SCORES,
    "binary_metrics": SQL_BINARY_METRICS,
    "confusion_matrix": SQL_CONFUSION,
    "roc_auc": SQL_AUC,
    "roc_points": SQL_ROC,
    "model_ranking": SQL_RANKING,
    "best_models": SQL_BEST,
    "best_models_mean": SQL_BEST_MEAN,
    "score_cards": SQL_SCORE_CARDS,
    "metric_long": SQL_METRIC_LONG,
    "f1_pivot": SQL_F1_PIVOT,
    **TASK_ORACLE_SQL,
}
