"""The SQL that states each query's result, for DuckDB over the same tables."""

from __future__ import annotations

C360 = """
WITH b AS (SELECT CAST('2001-02-01' AS TIMESTAMP) AS cut),
o AS (SELECT o_custkey, COUNT(*) AS usage_frequency, SUM(o_totalprice) AS total_spend,
             MIN(o_orderdate) AS first_o, MAX(o_orderdate) AS last_o
      FROM orders CROSS JOIN b WHERE o_orderdate <= cut GROUP BY o_custkey),
d AS (SELECT o_custkey,
             AVG(CAST(date_diff('day', o_orderdate, l_shipdate) AS DOUBLE)) AS payment_delay
      FROM orders JOIN lineitem ON l_orderkey = o_orderkey CROSS JOIN b
      WHERE o_orderdate <= cut AND l_shipdate <= cut GROUP BY o_custkey),
e AS (SELECT user_id,
             CAST(SUM(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS support_calls
      FROM events GROUP BY user_id),
f AS (SELECT DISTINCT o_custkey FROM orders CROSS JOIN b WHERE o_orderdate > cut),
c AS (SELECT c_custkey AS customer_id, c_acctbal AS balance, c_mktsegment AS segment,
             r_name AS region,
             CAST(date_diff('day', first_o, cut) // 30 AS INTEGER) AS tenure,
             CAST(o.usage_frequency AS BIGINT) AS usage_frequency,
             e.support_calls, d.payment_delay, o.total_spend,
             CAST(date_diff('day', last_o, cut) AS INTEGER) AS last_interaction,
             CASE WHEN f.o_custkey IS NULL THEN 1 ELSE 0 END AS churn
      FROM customer JOIN nation ON n_nationkey = c_nationkey
      JOIN region ON r_regionkey = n_regionkey CROSS JOIN b
      JOIN o ON o.o_custkey = c_custkey LEFT JOIN d ON d.o_custkey = c_custkey
      LEFT JOIN e ON e.user_id = c_custkey LEFT JOIN f ON f.o_custkey = c_custkey)
"""

SCORED = """
WITH s AS (SELECT doc_id, lang, source, CAST(quality AS DOUBLE) AS label,
                  CAST(toxic AS DOUBLE) AS prediction, CAST(n_chars AS DOUBLE) AS score
           FROM labels JOIN documents USING (doc_id))
"""

LAST_EVENT = """
SELECT user_id, event_id, event_type, value
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
      FROM events) WHERE rn = 1
"""

TENURE_CASE = """CASE WHEN {0} < 3 THEN 'New' WHEN {0} BETWEEN 3 AND 12 THEN 'Early-Stage'
    WHEN {0} BETWEEN 12 AND 24 THEN 'Mid-term' WHEN {0} > 24 THEN 'Loyal' END"""
AGE_CASE = """CASE WHEN {0} < 40 THEN 'Young' WHEN {0} BETWEEN 40 AND 65 THEN 'Middle-Aged'
    WHEN {0} > 65 THEN 'Senior' END"""

MEASURES = ["balance", "tenure", "usage_frequency", "payment_delay", "total_spend"]
MEASURES += ["last_interaction"]
NUMBERS = ["balance", "tenure", "usage_frequency", "support_calls", "payment_delay", "total_spend"]
NUMBERS += ["last_interaction"]
COLUMNS = ["customer_id", "balance", "segment", "region", "tenure", "usage_frequency"]
COLUMNS += ["support_calls", "payment_delay", "total_spend", "last_interaction", "churn"]


def union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


def counts(*keys: str) -> str:
    columns = ", ".join([*keys, "churn"])
    return f'{C360} SELECT {columns}, COUNT(*) AS "count" FROM c GROUP BY {columns}'


def describe() -> str:
    def one(name: str) -> str:
        if name in ("segment", "region"):
            return f"""SELECT '{name}' AS "column", COUNT({name}) AS "count",
                CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS stddev,
                CAST(NULL AS DOUBLE) AS min_value, CAST(NULL AS DOUBLE) AS max_value,
                MIN({name}) AS min_text, MAX({name}) AS max_text FROM c"""
        return f"""SELECT '{name}' AS "column", COUNT({name}) AS "count",
            ROUND(AVG({name}), 6) AS mean, ROUND(STDDEV_SAMP({name}), 6) AS stddev,
            ROUND(CAST(MIN({name}) AS DOUBLE), 6) AS min_value,
            ROUND(CAST(MAX({name}) AS DOUBLE), 6) AS max_value,
            CAST(NULL AS VARCHAR) AS min_text, CAST(NULL AS VARCHAR) AS max_text FROM c"""

    return C360 + union([one(c) for c in COLUMNS])


def null_profile() -> str:
    def one(name: str) -> str:
        gap = f"{name} IS NULL"
        if name in ("segment", "region"):
            gap += f" OR {name} IN ('', 'NULL', 'null')"
        return f"""SELECT '{name}' AS "column", COUNT(*) FILTER (WHERE {gap}) AS null_count,
            ROUND(COUNT(*) FILTER (WHERE {gap}) / COUNT(*) * 100.0, 6) AS null_percent FROM c"""

    return C360 + union([one(c) for c in COLUMNS])


def rate_by_category() -> str:
    return C360 + union(
        f"""SELECT '{k}' AS "column", {k} AS category, ROUND(AVG(churn), 6) AS churn_rate,
            COUNT(*) AS "count" FROM c GROUP BY {k}"""
        for k in ("segment", "region")
    )


def corr_with_label() -> str:
    return C360 + union(
        f"SELECT '{m}' AS \"column\", ROUND(ABS(CORR({m}, churn)), 6) AS abs_corr FROM c"
        for m in [*MEASURES, "support_calls"]
    )


def corr_matrix() -> str:
    names = [*MEASURES, "churn"]
    return C360 + union(
        f"SELECT '{x}' AS x, '{y}' AS y, ROUND(CORR({x}, {y}), 6) AS r FROM c"
        for x in names
        for y in names
    )


def box_stats() -> str:
    long = union(
        f"SELECT churn, '{m}' AS \"column\", CAST({m} AS DOUBLE) AS v FROM c WHERE {m} IS NOT NULL"
        for m in MEASURES
    )
    return f"""{C360}, v AS ({long}),
    q AS (SELECT churn, "column", QUANTILE_CONT(v, 0.25) AS q1, QUANTILE_CONT(v, 0.5) AS median,
                 QUANTILE_CONT(v, 0.75) AS q3 FROM v GROUP BY 1, 2),
    w AS (SELECT v.*, q1, median, q3,
                 v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
          FROM v JOIN q USING (churn, "column"))
    SELECT churn, "column", ROUND(q1, 6) AS q1, ROUND(median, 6) AS median, ROUND(q3, 6) AS q3,
           ROUND(MIN(v) FILTER (WHERE inside), 6) AS whisker_low,
           ROUND(MAX(v) FILTER (WHERE inside), 6) AS whisker_high,
           COUNT(*) FILTER (WHERE NOT inside) AS outliers
    FROM w GROUP BY churn, "column", w.q1, w.median, w.q3"""


def hist_by_label() -> str:
    parts = union(
        f"""SELECT churn, '{m}' AS "column", LEAST(COALESCE(
              CAST(FLOOR((CAST({m} AS DOUBLE) - lo) / NULLIF((hi - lo) / 10, 0)) AS INTEGER), 0), 9)
              AS bin
            FROM c CROSS JOIN (SELECT CAST(MIN({m}) AS DOUBLE) AS lo, CAST(MAX({m}) AS DOUBLE) AS hi
                               FROM c) WHERE {m} IS NOT NULL"""
        for m in ("tenure", "usage_frequency", "balance", "last_interaction")
    )
    return f"""{C360}, h AS ({parts})
    SELECT churn, "column", CAST(bin AS INTEGER) AS bin, COUNT(*) AS "count"
    FROM h GROUP BY ALL"""


def panels() -> str:
    return C360 + union(
        f"""SELECT '{k}' AS panel, CAST({k} AS VARCHAR) AS value, churn, COUNT(*) AS "count"
            FROM c GROUP BY ALL"""
        for k in ("segment", "region", "tenure", "support_calls", "usage_frequency")
    )


ENGAGEMENT = """
WITH log AS (SELECT user_id, CAST(ts AS DATE) AS day, event_type, c_mktsegment AS segment
             FROM events LEFT JOIN customer ON c_custkey = user_id WHERE user_id IS NOT NULL),
u AS (SELECT segment, user_id, COUNT(DISTINCT event_type) AS types FROM log
      WHERE segment IS NOT NULL GROUP BY ALL),
a AS (SELECT segment, AVG(CAST(types AS DOUBLE)
                          / (SELECT COUNT(DISTINCT event_type) FROM events)) AS adoption
      FROM u GROUP BY segment),
ud AS (SELECT DISTINCT segment, user_id, day FROM log WHERE segment IS NOT NULL),
dau AS (SELECT segment, AVG(n) AS dau FROM (SELECT segment, day, COUNT(*) AS n FROM ud GROUP BY ALL)
        GROUP BY segment),
wau AS (SELECT segment, AVG(n) AS wau
        FROM (SELECT segment, date_trunc('week', day) AS w, COUNT(DISTINCT user_id) AS n
              FROM ud GROUP BY ALL) GROUP BY segment),
g AS (SELECT ud.segment,
             COUNT(*) FILTER (WHERE p.day IS NULL) AS started,
             COUNT(*) FILTER (WHERE n.day IS NULL
                              AND ud.day < (SELECT MAX(CAST(ts AS DATE)) FROM events)) AS gone
      FROM ud LEFT JOIN ud p ON p.user_id = ud.user_id AND p.day = ud.day - 1
      LEFT JOIN ud n ON n.user_id = ud.user_id AND n.day = ud.day + 1 GROUP BY ud.segment),
x AS (SELECT segment, adoption, dau / wau AS stickiness,
             CAST(started AS DOUBLE) / CASE WHEN gone = 0 THEN 1 ELSE gone END AS growth
      FROM a JOIN dau USING (segment) JOIN wau USING (segment) JOIN g USING (segment))
"""

# Feature slots in long form: categories by training frequency, then numbers.


def index_of(column: str, rows: str) -> str:
    return f"""(SELECT {column}, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, {column}) - 1 AS idx
               FROM {rows} WHERE {column} IS NOT NULL GROUP BY {column})"""


def one_hot(column: str, rows: str, fitted_on: str, offset: str = "0", keep: str = "") -> str:
    index = index_of(column, fitted_on)
    return f"""SELECT customer_id, {keep} CAST(i.idx + {offset} AS INTEGER) AS slot,
        CAST(CASE WHEN r.{column} = i.{column} THEN 1 ELSE 0 END AS DOUBLE) AS value
        FROM {rows} r CROSS JOIN {index} i"""


SPLIT_CTE = """, t AS (SELECT *, CASE WHEN
    CAST('0x' || substr(md5(CAST(customer_id AS VARCHAR) || ':42'), 1, 8) AS BIGINT) < 3435973837
    THEN 'train' ELSE 'test' END AS part FROM c)"""


def assemble() -> str:
    size = "(SELECT COUNT(DISTINCT segment) FROM c)"
    return f"""{C360} {one_hot("segment", "c", "c")}
    UNION ALL SELECT customer_id, CAST({size} AS INTEGER), CAST(support_calls AS DOUBLE) FROM c
    UNION ALL SELECT customer_id, CAST({size} + 1 AS INTEGER), CAST(tenure AS DOUBLE) FROM c"""


def standard_scale() -> str:
    return C360 + union(
        f"""SELECT customer_id, {i} AS slot,
            ROUND(({m} - (SELECT AVG({m}) FROM c)) / (SELECT STDDEV_SAMP({m}) FROM c), 6) AS value
            FROM c"""
        for i, m in enumerate(("tenure", "balance", "last_interaction"))
    )


def scaled_slots() -> str:
    """CTE ``z``: every feature slot of every row, scaled as fitted on the training part."""
    tr = "(SELECT * FROM t WHERE part = 'train')"
    keep = "part, CAST(churn AS DOUBLE) AS label,"
    n1 = f"(SELECT COUNT(DISTINCT segment) FROM {tr})"
    n2 = f"(SELECT COUNT(DISTINCT region) FROM {tr})"
    slots = [one_hot("segment", "t", tr, keep=keep), one_hot("region", "t", tr, n1, keep)]
    slots += [
        f"""SELECT customer_id, {keep} CAST({n1} + {n2} + {i} AS INTEGER) AS slot,
            CAST(COALESCE({m}, (SELECT AVG({m}) FROM {tr})) AS DOUBLE) AS value FROM t"""
        for i, m in enumerate(NUMBERS)
    ]
    return f"""{C360} {SPLIT_CTE}, x AS ({union(slots)}),
    st AS (SELECT slot, AVG(value) AS mean, STDDEV_SAMP(value) AS dev FROM x
           WHERE part = 'train' GROUP BY slot),
    z AS (SELECT customer_id, part, label, slot, (value - mean) / dev AS value
          FROM x JOIN st USING (slot))"""


def ml_features() -> str:
    return f"""{scaled_slots()}
    SELECT customer_id, label, slot, ROUND(value, 6) AS value FROM z"""


def naive_bayes(rows: str) -> str:
    """Gaussian naive Bayes fitted on the training part, predicting ``rows``."""
    return f"""{scaled_slots()},
    n AS (SELECT label, LN(COUNT(DISTINCT customer_id)) AS log_n FROM z WHERE part = 'train'
          GROUP BY label),
    eps AS (SELECT 1e-9 * MAX(v) AS e FROM (SELECT VAR_POP(value) AS v FROM z
            WHERE part = 'train' GROUP BY slot)),
    g AS (SELECT label, slot, AVG(value) AS mean, VAR_POP(value) + (SELECT e FROM eps) AS var
          FROM z WHERE part = 'train' GROUP BY label, slot),
    l AS (SELECT z.customer_id, z.label, n.label AS class,
                 MAX(log_n) - SUM((z.value - mean) ** 2 / var + LN(var)) / 2 AS score
          FROM z JOIN g USING (slot) JOIN n ON n.label = g.label
          WHERE {rows} GROUP BY z.customer_id, z.label, n.label)
    SELECT customer_id, label, ARG_MAX(class, score) AS prediction
    FROM l GROUP BY customer_id, label"""


EVAL_METRICS = (
    SCORED
    + """, k AS (SELECT k, COUNT(*) FILTER (WHERE label = k) AS lab,
                   COUNT(*) FILTER (WHERE prediction = k) AS pred,
                   COUNT(*) FILTER (WHERE label = k AND prediction = k) AS hit
            FROM s CROSS JOIN (SELECT DISTINCT label AS k FROM s) GROUP BY k),
m AS (SELECT *, COALESCE(hit / NULLIF(CAST(pred AS DOUBLE), 0), 0) AS p,
             COALESCE(hit / NULLIF(CAST(lab AS DOUBLE), 0), 0) AS r FROM k)
SELECT ROUND(SUM(hit) / CAST(SUM(lab) AS DOUBLE), 6) AS accuracy,
       ROUND(SUM(p * lab) / SUM(lab), 6) AS "weightedPrecision",
       ROUND(SUM(r * lab) / SUM(lab), 6) AS "weightedRecall",
       ROUND(SUM(CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END * lab) / SUM(lab), 6) AS f1
FROM m"""
)

EVAL_AUC = (
    SCORED
    + """, g AS (SELECT score, SUM(label) AS pos, SUM(1 - label) AS neg FROM s GROUP BY score),
cum AS (SELECT score, SUM(pos) OVER w AS tp, SUM(neg) OVER w AS fp,
               SUM(pos) OVER () AS p, SUM(neg) OVER () AS n
        FROM g WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING)),
pt AS (SELECT score, tp / p AS recall, fp / n AS fall, tp / (tp + fp) AS prec,
              LAG(tp / p, 1, 0) OVER o AS recall0, LAG(fp / n, 1, 0) OVER o AS fall0,
              COALESCE(LAG(tp / (tp + fp)) OVER o, tp / (tp + fp)) AS prec0
       FROM cum WINDOW o AS (ORDER BY score DESC))
SELECT ROUND(SUM((fall - fall0) * (recall + recall0) / 2), 6) AS "areaUnderROC",
       ROUND(SUM((recall - recall0) * (prec + prec0) / 2), 6) AS "areaUnderPR" FROM pt"""
)

RUNS = (
    SCORED
    + """, r AS (SELECT lang AS name, lang || '/' || source AS run_id,
                   AVG(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END) AS metric,
                   COUNT(*) AS n FROM s GROUP BY ALL),
reg AS (SELECT name, CAST(ROW_NUMBER() OVER (PARTITION BY name ORDER BY run_id) AS INTEGER)
               AS version, run_id FROM r),
latest AS (SELECT name, version, run_id FROM reg
           QUALIFY ROW_NUMBER() OVER (PARTITION BY name ORDER BY version DESC) = 1)
"""
)


def density() -> str:
    """Kernel densities on 100 points, from values shared out to the points beside them."""
    long = union(
        f"SELECT churn, '{m}' AS \"column\", CAST({m} AS DOUBLE) AS v FROM c WHERE {m} IS NOT NULL"
        for m in ("tenure", "balance", "last_interaction")
    )
    return f"""{C360}, v AS ({long}),
    g AS (SELECT churn, "column", COUNT(*) AS n, STDDEV_SAMP(v) * POW(COUNT(*), -0.2) AS h,
                 MIN(v) AS lo, MAX(v) AS hi FROM v GROUP BY 1, 2 HAVING STDDEV_SAMP(v) > 0),
    s AS (SELECT *, lo - 2 * h AS start, (hi - lo + 4 * h) / 99 AS step FROM g),
    p AS (SELECT v.churn, v."column", (v - start) / step AS spot FROM v JOIN s USING (churn, "column")),
    w AS (SELECT churn, "column", node, SUM(weight) AS weight FROM (
            SELECT churn, "column", FLOOR(spot) AS node, 1 - (spot - FLOOR(spot)) AS weight FROM p
            UNION ALL SELECT churn, "column", FLOOR(spot) + 1, spot - FLOOR(spot) FROM p) GROUP BY ALL)
    SELECT churn, "column", CAST(i AS INTEGER) AS point, ROUND(start + i * step, 6) AS x,
           ROUND(SUM(weight * EXP(-0.5 * POW((i - node) * step / h, 2))) / (n * h * SQRT(2 * PI())), 12) AS density
    FROM s JOIN w USING (churn, "column") CROSS JOIN range(100) r(i) GROUP BY churn, "column", i, start, step, n, h"""


def sparse_slots() -> str:
    """Categories by frequency in the training part, then scaled numbers; zeros left out."""
    index = """SELECT {0} AS value, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, {0}) - 1 AS idx
               FROM tr GROUP BY {0}"""
    first, second = "(SELECT COUNT(*) FROM o)", "(SELECT COUNT(*) FROM st)"
    numbers = union(
        f"""SELECT line, CAST({first} + {second} + {i} AS INTEGER) AS slot,
                   ({m} - (SELECT AVG({m}) FROM tr)) / (SELECT STDDEV_SAMP({m}) FROM tr) AS value FROM t"""
        for i, m in enumerate(("quantity", "price"))
    )
    return f"""{LINES}, o AS ({index.format('"order"')}), st AS ({index.format("status")})
    SELECT line, slot, ROUND(value, 6) AS value FROM (
        SELECT line, CAST(idx AS INTEGER) AS slot, 1.0::DOUBLE AS value FROM t JOIN o ON o.value = t."order"
        UNION ALL SELECT line, CAST({first} + idx AS INTEGER), 1.0 FROM t JOIN st ON st.value = t.status
        UNION ALL {numbers}) WHERE value <> 0"""


def cv_scores_nb(result: str) -> str:
    """Each fold of the training part scored by the others' statistics; ``result`` reads the predictions ``p``."""
    return f"""{scaled_slots()},
    fo AS (SELECT *, CAST(CAST('0x' || substr(md5(CAST(customer_id AS VARCHAR) || ':42'), 1, 8) AS BIGINT) % 3
                         AS INTEGER) AS fold FROM z WHERE part = 'train'),
    k AS (SELECT DISTINCT fold AS k FROM fo),
    n AS (SELECT k, label, LN(COUNT(DISTINCT customer_id)) AS log_n FROM fo JOIN k ON fold <> k GROUP BY ALL),
    eps AS (SELECT k, 1e-9 * MAX(v) AS e FROM (SELECT k, slot, VAR_POP(value) AS v FROM fo JOIN k ON fold <> k
            GROUP BY ALL) GROUP BY k),
    g AS (SELECT k, label, slot, AVG(value) AS mean, VAR_POP(value) + ANY_VALUE(e) AS var
          FROM fo JOIN k ON fold <> k JOIN eps USING (k) GROUP BY ALL),
    l AS (SELECT fo.fold, fo.customer_id, fo.label, n.label AS class,
                 MAX(log_n) - SUM((fo.value - mean) ** 2 / var + LN(var)) / 2 AS score
          FROM fo JOIN g ON g.k = fo.fold AND g.slot = fo.slot JOIN n ON n.k = fo.fold AND n.label = g.label
          GROUP BY ALL),
    p AS (SELECT fold, label, ARG_MAX(class, score) AS prediction FROM l GROUP BY fold, customer_id, label)
    {result}"""


def permutation_importance() -> str:
    """Naive Bayes on the test part with one slot at a time taken from a row j + 1 places before."""
    return f"""{scaled_slots()},
    n AS (SELECT label, LN(COUNT(DISTINCT customer_id)) AS log_n FROM z WHERE part = 'train' GROUP BY label),
    eps AS (SELECT 1e-9 * MAX(v) AS e FROM (SELECT VAR_POP(value) AS v FROM z
            WHERE part = 'train' GROUP BY slot)),
    g AS (SELECT label, slot, AVG(value) AS mean, VAR_POP(value) + (SELECT e FROM eps) AS var
          FROM z WHERE part = 'train' GROUP BY label, slot),
    rk AS (SELECT customer_id, ROW_NUMBER() OVER (ORDER BY
               CAST('0x' || substr(md5(CAST(customer_id AS VARCHAR) || ':42'), 1, 8) AS BIGINT), customer_id) - 1 AS r
           FROM t WHERE part = 'test'),
    ranked AS (SELECT r, customer_id, label, slot, value FROM z JOIN rk USING (customer_id)),
    m AS (SELECT COUNT(*) AS rows FROM rk),
    part_of AS (SELECT x.customer_id, x.label, x.slot, x.r, g.label AS class,
               (x.value - mean) ** 2 / var + LN(var) AS plain,
               (d.value - mean) ** 2 / var + LN(var) AS altered
          FROM ranked x JOIN g USING (slot) CROSS JOIN m
          JOIN ranked d ON d.slot = x.slot AND (d.r + d.slot + 1) % m.rows = x.r),
    l AS (SELECT customer_id, label, class, SUM(plain) AS plain FROM part_of GROUP BY ALL),
    s AS (SELECT p.customer_id, p.label, p.class, p.slot, log_n - (l.plain - p.plain + p.altered) / 2 AS score
          FROM l JOIN part_of p ON p.customer_id = l.customer_id AND p.class = l.class JOIN n ON n.label = p.class),
    a AS (SELECT slot, AVG(CASE WHEN label = prediction THEN 1.0::DOUBLE ELSE 0 END) AS accuracy
          FROM (SELECT customer_id, label, slot, ARG_MAX(class, score) AS prediction FROM s GROUP BY ALL) GROUP BY slot),
    base AS (SELECT AVG(CASE WHEN label = prediction THEN 1.0::DOUBLE ELSE 0 END) AS accuracy
          FROM (SELECT customer_id, l.label AS label, ARG_MAX(class, log_n - plain / 2) AS prediction
                FROM l JOIN n ON n.label = class GROUP BY customer_id, l.label))
    SELECT slot, ROUND(a.accuracy, 6) AS accuracy, ROUND(base.accuracy - a.accuracy, 6) AS importance FROM a CROSS JOIN base"""


LINES = """
WITH t AS (SELECT l_orderkey * 8 + l_linenumber AS line, CAST(l_orderkey AS VARCHAR) AS "order",
                  l_linestatus AS status, CAST(l_quantity AS DOUBLE) AS quantity,
                  CAST(l_extendedprice AS DOUBLE) AS price FROM lineitem),
tr AS (SELECT * FROM t WHERE
       CAST('0x' || substr(md5(CAST(line AS VARCHAR) || ':42'), 1, 8) AS BIGINT) < 3435973837)
"""

SPLITS = f"""{C360},
r AS (SELECT * FROM c WHERE tenure IS NOT NULL AND usage_frequency IS NOT NULL AND support_calls IS NOT NULL),
v AS (SELECT 'tenure' AS "column", CAST(tenure AS DOUBLE) AS value, churn FROM r
      UNION ALL SELECT 'usage_frequency', CAST(usage_frequency AS DOUBLE), churn FROM r
      UNION ALL SELECT 'support_calls', CAST(support_calls AS DOUBLE), churn FROM r),
k AS (SELECT "column", value, COUNT(*) AS n, SUM(churn) AS hits FROM v GROUP BY 1, 2),
q AS (SELECT "column", (value + LEAD(value) OVER o) / 2 AS threshold,
             SUM(n) OVER o AS ln, SUM(hits) OVER o AS lh,
             SUM(n) OVER w AS rows, SUM(hits) OVER w AS hits
      FROM k WINDOW o AS (PARTITION BY "column" ORDER BY value), w AS (PARTITION BY "column")),
split AS (SELECT "column", threshold, CAST(ln AS BIGINT) AS left_rows, CAST(rows - ln AS BIGINT) AS right_rows,
      2 * (hits / rows) * (1 - hits / rows) - (ln * 2 * (lh / ln) * (1 - lh / ln)
        + (rows - ln) * 2 * ((hits - lh) / (rows - ln)) * (1 - (hits - lh) / (rows - ln))) / rows AS gain
      FROM q WHERE threshold IS NOT NULL)
"""

GROUPED_AUC = (
    SCORED
    + """, g AS (SELECT lang, source, score, SUM(label) AS pos, SUM(1 - label) AS neg FROM s GROUP BY ALL),
cum AS (SELECT *, SUM(pos) OVER w AS tp, SUM(neg) OVER w AS fp,
               SUM(pos) OVER a AS p, SUM(neg) OVER a AS n
        FROM g WINDOW w AS (PARTITION BY lang, source ORDER BY score DESC ROWS UNBOUNDED PRECEDING),
                      a AS (PARTITION BY lang, source)),
pt AS (SELECT *, tp / NULLIF(p, 0) AS recall, fp / NULLIF(n, 0) AS fall, tp / (tp + fp) AS prec,
              COALESCE((tp - pos) / NULLIF(tp + fp - pos - neg, 0), tp / (tp + fp)) AS prec0 FROM cum)
SELECT lang, source, CAST(SUM(pos + neg) AS BIGINT) AS rows,
       ROUND(SUM(neg / NULLIF(n, 0) * (recall + recall - pos / NULLIF(p, 0)) / 2), 6) AS "areaUnderROC",
       ROUND(SUM(pos / NULLIF(p, 0) * (prec + prec0) / 2), 6) AS "areaUnderPR" FROM pt GROUP BY lang, source"""
)

SPOILT = """
WITH k AS (SELECT *, c_custkey % 25 = 7 AS short, c_custkey % 25 <> 7 AND c_custkey % 90 = 45 AS long,
       CASE WHEN c_custkey % 40 = 11 THEN 'none' ELSE CAST(c_nationkey AS VARCHAR) END AS nation,
       CASE WHEN c_custkey % 10 = 3 THEN '12,5' ELSE CAST(c_acctbal AS VARCHAR) END AS balance FROM customer)
"""


# Share of right predictions.
HIT = "AVG(CASE WHEN label = prediction THEN 1.0::DOUBLE ELSE 0 END)"


def oracles() -> dict[str, str]:
    return {
        "scan_csv": "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
        "scan_csv_rejects": f"""{SPOILT}
            SELECT c_custkey, CAST(NULL AS VARCHAR) AS "column", CASE WHEN short THEN c_custkey || ',' || c_name
                ELSE c_custkey || ',' || c_name || ',' || nation || ',"' || balance || '",more' END AS text, 'line' AS reason
            FROM k WHERE short OR long
            UNION ALL SELECT c_custkey, 'c_nationkey', nation, 'field' FROM k WHERE NOT short AND c_custkey % 40 = 11
            UNION ALL SELECT c_custkey, 'c_acctbal', balance, 'field' FROM k WHERE NOT short AND c_custkey % 10 = 3""",
        "scan_csv_checked": f"""{SPOILT} SELECT c_custkey, c_name,
            CASE WHEN NOT short AND c_custkey % 40 <> 11 THEN CAST(c_nationkey AS INTEGER) END AS c_nationkey,
            CASE WHEN NOT short AND c_custkey % 10 <> 3 THEN c_acctbal END AS c_acctbal FROM k""",
        "scan_table": "SELECT event_id, user_id, event_type, value FROM events",
        "write_partitioned": f"""{C360} SELECT segment, region, COUNT(*) AS customers,
            CAST(SUM(churn) AS BIGINT) AS churned FROM c GROUP BY segment, region""",
        "write_repartitioned": "SELECT 5::BIGINT AS files, COUNT(*) AS rows_written FROM orders",
        "write_overwrite": "SELECT c_custkey, c_acctbal, c_mktsegment FROM customer",
        "write_with_count": "SELECT COUNT(*) AS rows_written FROM orders",
        "write_with_count_json": "SELECT COUNT(*) AS rows_written FROM customer",
        "write_if_absent": "SELECT c_custkey, c_mktsegment FROM customer",
        "publish_table": f"{C360} SELECT customer_id, segment, tenure, churn FROM c",
        "stream_ingest": LAST_EVENT,
        "stream_two_checkpoints": LAST_EVENT,
        "upsert_buckets": LAST_EVENT,
        "stream_new_column": """SELECT user_id, event_id, event_type, CASE WHEN ts >=
            (SELECT MIN(ts) + (MAX(ts) - MIN(ts)) / 2 FROM events) THEN value END AS value
            FROM events QUALIFY ROW_NUMBER() OVER (
                PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
        "upsert_latest": LAST_EVENT,
        "drop_columns": "SELECT c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
        "normalise_names": f"""{C360} SELECT customer_id AS "Customer_ID",
            ROUND(total_spend, 6) AS "Total_Spend", segment AS "Subscription_Type" FROM c""",
        "project_label": f"""{C360}
            SELECT customer_id, tenure, CAST(churn AS DOUBLE) AS label FROM c""",
        "column_roles": C360
        + union(
            f"""SELECT '{n}' AS "column", '{role}' AS role, COUNT({n}) AS value_count FROM c"""
            for n in COLUMNS
            if n != "customer_id"
            for role in [
                "label"
                if n == "churn"
                else "categorical"
                if n in ("segment", "region")
                else "numeric"
            ]
        ),
        "schema_report": """SELECT column_name AS name, CASE WHEN column_type = 'BIGINT' THEN 'bigint'
                WHEN column_type = 'INTEGER' THEN 'int' WHEN column_type = 'DOUBLE' THEN 'double'
                WHEN column_type = 'VARCHAR' THEN 'string'
                WHEN column_type LIKE 'TIMESTAMP%' THEN 'timestamp_ntz' END AS type,
            "null" = 'YES' AS nullable, (SELECT COUNT(*) FROM lineitem) AS row_count
            FROM (DESCRIBE lineitem)""",
        "dropna_subset": f"""{C360} SELECT customer_id, support_calls,
            ROUND(total_spend, 6) AS total_spend, ROUND(payment_delay, 6) AS payment_delay FROM c
            WHERE support_calls IS NOT NULL AND total_spend IS NOT NULL
              AND payment_delay IS NOT NULL""",
        "filter_missing": f"""{C360} SELECT customer_id, segment, churn FROM c
            WHERE support_calls IS NULL""",
        "dedup_all": "SELECT DISTINCT o_custkey, o_orderstatus, o_orderpriority FROM orders",
        "dedup_subset": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
            l_extendedprice, l_discount + 0.0 AS l_discount, l_tax, l_returnflag, l_linestatus
            FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
                ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
                         l_returnflag, l_linestatus) AS rn FROM lineitem) WHERE rn = 1""",
        "head_n": f"""{C360} SELECT customer_id, segment, tenure, churn FROM c
            ORDER BY customer_id LIMIT 20""",
        "clean_table": f"""{C360} SELECT DISTINCT segment, region, support_calls, churn FROM c
            WHERE support_calls IS NOT NULL""",
        "row_count": "SELECT COUNT(*) AS row_count FROM lineitem",
        "describe": describe(),
        "null_profile": null_profile(),
        "rate_by_category": rate_by_category(),
        "corr_with_label": corr_with_label(),
        "corr_matrix": corr_matrix(),
        "box_stats": box_stats(),
        "hist_by_label": hist_by_label(),
        "density_by_label": density(),
        "kpi_metrics": f"""{C360} SELECT COUNT(*) AS total_customers,
            COUNT(*) FILTER (WHERE churn = 1) AS churned_customers,
            ROUND(100.0 * COUNT(*) FILTER (WHERE churn = 1) / COUNT(*), 2) AS churn_rate,
            ROUND(AVG(tenure), 2) AS avg_tenure, ROUND(AVG(total_spend), 2) AS avg_spend FROM c""",
        "churn_distribution": counts(),
        "churn_by_segment": counts("segment"),
        "churn_by_region": counts("region"),
        "churn_by_tenure": counts("tenure"),
        "churn_by_support_calls": counts("support_calls") + " ORDER BY support_calls, churn",
        "churn_by_tenure_group": f"""{C360} SELECT {TENURE_CASE.format("tenure")}
            AS tenure_category, churn, COUNT(*) AS "count" FROM c GROUP BY 1, 2""",
        "churn_by_usage": counts("usage_frequency"),
        "avg_by_churn": f"""{C360} SELECT churn, ROUND(AVG(balance), 6) AS avg_balance,
            ROUND(AVG(tenure), 6) AS avg_tenure, ROUND(AVG(usage_frequency), 6) AS avg_usage,
            ROUND(AVG(support_calls), 6) AS avg_support_calls,
            ROUND(AVG(payment_delay), 6) AS avg_payment_delay,
            ROUND(AVG(total_spend), 6) AS avg_spend FROM c GROUP BY churn""",
        "churn_panels": panels(),
        "bin_columns": f"""{C360} SELECT customer_id, tenure, tenure AS age,
            {AGE_CASE.format("tenure")} AS age_category,
            {TENURE_CASE.format("tenure")} AS tenure_category FROM c""",
        "bin_age": f"""{C360} SELECT customer_id, tenure AS age, CASE WHEN tenure < 40 THEN 'Young'
            WHEN tenure >= 40 AND tenure < 65 THEN 'Middle-Aged' ELSE 'Senior' END
            AS age_category FROM c""",
        "bin_balance": """SELECT o_orderkey, o_totalprice AS balance,
            CASE WHEN o_totalprice = 0 THEN 'Zero' WHEN o_totalprice < 50000 THEN 'Low'
                 WHEN o_totalprice < 100000 THEN 'Medium' ELSE 'High' END AS balance_category
            FROM orders""",
        "bin_score": f"""{C360} SELECT customer_id, last_interaction,
            CASE WHEN last_interaction < 600 THEN 'Poor' WHEN last_interaction < 700 THEN 'Fair'
                 WHEN last_interaction < 800 THEN 'Good' ELSE 'Excellent' END
            AS credit_score_category FROM c""",
        "bin_tenure": f"""{C360} SELECT customer_id, usage_frequency,
            CASE WHEN usage_frequency <= 3 THEN 'New' WHEN usage_frequency <= 12 THEN 'Early-Stage'
                 WHEN usage_frequency <= 24 THEN 'Mid-term' ELSE 'Loyal' END
            AS tenure_category FROM c""",
        "ratio_column": f"""{C360} SELECT customer_id, ROUND(total_spend, 6) AS total_spend,
            support_calls, ROUND(total_spend / CASE WHEN support_calls = 0 THEN 1
                                                    ELSE support_calls END, 6)
            AS total_spend_support_calls_ratio FROM c""",
        "engagement_inputs": f"""{ENGAGEMENT} SELECT segment, ROUND(adoption, 6) AS adoption,
            ROUND(stickiness, 6) AS stickiness, ROUND(growth, 6) AS growth FROM x""",
        "engagement_score": f"""{ENGAGEMENT} SELECT segment,
            ROUND(adoption * stickiness * growth, 6) AS engagement_score FROM x""",
        "sample_bounds": "SELECT COUNT(*) AS rows, TRUE AS known, TRUE AS near FROM orders",
        "sample_hash": """SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE CAST('0x' ||
            substr(md5(CAST(o_orderkey AS VARCHAR) || ':42'), 1, 8) AS BIGINT) < 42949673""",
        "split_random": "SELECT c_custkey, c_mktsegment, 1::BIGINT AS parts FROM customer",
        "split_hash": f"{C360} {SPLIT_CTE} SELECT customer_id, churn, part FROM t",
        "string_index": f"""{C360} SELECT customer_id, CAST(s.idx AS DOUBLE) AS segment_idx,
            CAST(r.idx AS DOUBLE) AS region_idx
            FROM c JOIN {index_of("segment", "c")} s USING (segment)
            JOIN {index_of("region", "c")} r USING (region)""",
        "string_index_wide": """SELECT o_orderkey, CAST(ROW_NUMBER() OVER (
            ORDER BY CAST(o_orderkey AS VARCHAR)) - 1 AS DOUBLE) AS text_idx FROM orders""",
        "one_hot_wide": """WITH o AS (SELECT o_orderkey, o_orderstatus AS s,
                CAST(o_custkey AS VARCHAR) AS c FROM orders),
            si AS (SELECT s, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, s) - 1 AS idx
                FROM o WHERE s IS NOT NULL GROUP BY s),
            ci AS (SELECT c, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, c) - 1 AS idx
                FROM o WHERE c IS NOT NULL GROUP BY c)
            SELECT o_orderkey, 'o_orderstatus' AS "column", si.idx AS slot FROM o JOIN si USING (s)
            UNION ALL SELECT o_orderkey, 'customer', ci.idx + (SELECT COUNT(*) FROM si)
            FROM o JOIN ci USING (c)""",
        "one_hot": C360 + one_hot("segment", "c", "c"),
        "assemble": assemble(),
        "standard_scale": standard_scale(),
        "ml_features": ml_features(),
        "sparse_slots": sparse_slots(),
        "sparse_gradient": f"""{LINES} SELECT CAST(i - 1 AS INTEGER) AS slot, 0.0::DOUBLE AS gradient
            FROM (SELECT UNNEST(range((SELECT COUNT(DISTINCT "order") + COUNT(DISTINCT status) + 3 FROM tr))) AS i)""",
        "lr_gradient": f"""{scaled_slots()}
            SELECT DISTINCT slot, 0.0::DOUBLE AS gradient FROM z UNION ALL SELECT -1, 0.0""",
        "dtc_stump": f"""{SPLITS} SELECT "column", threshold, left_rows, right_rows, ROUND(gain, 6) AS gain FROM split""",
        "dtc_best_split": f"""{SPLITS} SELECT "column", threshold, left_rows, right_rows, ROUND(gain, 6) AS gain FROM split
            ORDER BY split.gain DESC, "column", threshold LIMIT 1""",
        "permutation_importance": permutation_importance(),
        "cv_scores_nb": cv_scores_nb(f"SELECT fold, COUNT(*) AS rows, ROUND({HIT}, 6) AS accuracy FROM p GROUP BY fold"),
        "search_nb": cv_scores_nb(
            f"""SELECT 'smoothing=' || s AS params, 'accuracy' AS metric, ROUND(AVG(a), 6) AS score
            FROM (SELECT fold, {HIT} AS a FROM p GROUP BY fold) CROSS JOIN (VALUES ('0.5'), ('1.0'), ('2.0')) v(s) GROUP BY s"""
        ),
        "train_promote_metric": f"""SELECT 'churn' AS name, 1 AS version, ROUND({HIT}, 6) AS accuracy
            FROM ({naive_bayes("part = 'test'")})""",
        "model_record": f"""{scaled_slots()}
            SELECT * FROM (VALUES ('featuresCol', 'features'), ('labelCol', 'label'), ('modelType', 'gaussian'),
                ('predictionCol', 'prediction'), ('smoothing', '1.0')) v(name, value)
            UNION ALL SELECT 'numClasses', CAST(COUNT(DISTINCT label) AS VARCHAR) FROM z WHERE part = 'train'
            UNION ALL SELECT 'numFeatures', CAST(COUNT(DISTINCT slot) AS VARCHAR) FROM z""",
        "predict_nb": naive_bayes("part = 'test'"),
        "train_promote": "SELECT 'churn' AS name, 1 AS version",
        "score_champion": f"SELECT customer_id, prediction FROM ({naive_bayes('TRUE')})",
        "batch_predict": naive_bayes("TRUE"),
        "confusion_matrix": f"""{SCORED} SELECT label, COUNT(*) FILTER (WHERE prediction = 0)
            AS pred_0, COUNT(*) FILTER (WHERE prediction = 1) AS pred_1 FROM s GROUP BY label""",
        "eval_metrics": EVAL_METRICS,
        "eval_auc": EVAL_AUC,
        "eval_auc_by_segment": GROUPED_AUC,
        "promote_champion": f"""{RUNS} SELECT n.name, n.run_id, l.run_id AS champion_run,
            ROUND(n.metric, 6) AS new_metric, ROUND(o.metric, 6) AS old_metric,
            COALESCE(l.version IS NULL OR n.metric > o.metric * 1.1, FALSE) AS promoted,
            CAST(COALESCE(l.version, 0) + 1 AS INTEGER) AS next_version
            FROM r n LEFT JOIN latest l USING (name) LEFT JOIN r o ON o.run_id = l.run_id""",
        "promote_registry": f"""{RUNS}, known AS (SELECT * FROM reg WHERE version <= 5),
            champion AS (SELECT k.name, k.version, r.metric FROM known k JOIN r USING (run_id)
                QUALIFY ROW_NUMBER() OVER (PARTITION BY k.name ORDER BY k.version DESC) = 1)
            SELECT name, version, run_id FROM known UNION ALL
            SELECT name, CAST(next_version AS INTEGER), run_id FROM (
                SELECT r.name, COALESCE(c.version, 0) + 1 AS next_version, r.run_id,
                    ROW_NUMBER() OVER (PARTITION BY r.name ORDER BY r.metric DESC, r.run_id) AS place
                FROM r LEFT JOIN champion c USING (name)
                WHERE r.run_id NOT IN (SELECT run_id FROM known)
                  AND (c.version IS NULL OR r.metric > c.metric * 1.1)) WHERE place = 1""",
        "latest_champion": f"{RUNS} SELECT name, version, run_id FROM latest",
    }
