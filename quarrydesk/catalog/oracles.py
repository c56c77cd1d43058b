"""DuckDB SQL for the registered queries, written independently of the Spark plans.

Each text is plain SQL over the given tables: brute-force self-joins, global
windows and all-pairs products where the Spark side uses something that scales.
"""

from __future__ import annotations

RAW = r"""
base AS (
  SELECT d.doc_id, d.text, d.source, d.lang, e.user_id, e.ts, e.value,
         row_number() OVER (PARTITION BY e.user_id ORDER BY e.ts, e.event_id) - 1 AS prev
  FROM documents d JOIN events e ON e.event_id = d.doc_id),
t AS (
  SELECT doc_id AS row_seq,
         concat('T-', lpad(cast(doc_id AS string), 6, '0')) AS ticket_id,
         concat('C-', cast(user_id AS string)) AS customer_id,
         CASE WHEN doc_id % 25 = 0 THEN NULL ELSE text END AS ticket_text,
         source AS product,
         CASE doc_id % 335 WHEN 0 THEN '13/32/2023 10:00:00' WHEN 67 THEN '2023/99/01 00:00'
              WHEN 134 THEN 'not-a-date' WHEN 201 THEN 'Jan 2023' WHEN 268 THEN ''
              ELSE substr(cast(ts AS string), 1, 19) END AS created_at,
         CASE WHEN doc_id % 33 = 0 THEN NULL WHEN doc_id % 333 = 1 THEN -1.0E0
              WHEN doc_id % 333 = 2 THEN -5.0E0 WHEN doc_id % 333 = 4 THEN -999.0E0
              ELSE cast(prev AS double) END AS previous_tickets,
         CASE WHEN (doc_id * 31) % 100 >= 82 THEN NULL WHEN doc_id % 50 = 11 THEN NULL
              WHEN doc_id % 200 = 17 THEN -5.0E0 WHEN doc_id % 200 = 18 THEN 9999.0E0
              WHEN doc_id % 200 = 20 THEN 0.001E0 WHEN doc_id % 200 = 21 THEN 50000.0E0
              ELSE value END AS resolution_time,
         CASE WHEN (doc_id * 7) % 10 < 2 THEN 'HIGH' WHEN (doc_id * 7) % 10 < 7 THEN 'MEDIUM' ELSE 'LOW' END AS priority,
         lang AS category,
         (doc_id * 31) % 100 < 82 AS resolved
  FROM base),
tickets_raw AS MATERIALIZED (
  SELECT * FROM t
  UNION ALL
  SELECT row_seq + 1000000000, concat('T-DUPE-', lpad(cast(row_seq AS string), 6, '0')), customer_id, ticket_text, product,
         created_at, previous_tickets, resolution_time, priority, category, resolved
  FROM t WHERE row_seq % 50 = 7)"""

STAMP = "try_strptime(created_at, '%Y-%m-%d %H:%M:%S')"
NORMAL = r"lower(trim(regexp_replace(ticket_text, '\s+', ' ', 'g')))"
CAPPED = "CASE WHEN resolution_time IS NOT NULL THEN least(greatest(resolution_time, 0.0), 8760.0) END"

STAGED = RAW + rf""",
staged AS MATERIALIZED (
  SELECT row_seq, ticket_id, customer_id, {NORMAL} AS ticket_text, product, {STAMP} AS created_at,
         previous_tickets, resolution_time, priority, category, resolved
  FROM tickets_raw WHERE ticket_text IS NOT NULL AND {STAMP} IS NOT NULL)"""

CLEAN = STAGED + rf""",
capped AS (
  SELECT * REPLACE (greatest(coalesce(previous_tickets, 0.0), 0.0) AS previous_tickets, {CAPPED} AS resolution_time)
  FROM staged),
imputed AS (
  SELECT * REPLACE (CASE WHEN resolved AND resolution_time IS NULL
                         THEN (SELECT median(resolution_time) FROM capped WHERE resolved)
                         ELSE resolution_time END AS resolution_time) FROM capped),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY customer_id, ticket_text, product, created_at, previous_tickets,
                               resolution_time, priority, category, resolved ORDER BY row_seq) AS copy_no
  FROM imputed),
kept AS MATERIALIZED (SELECT * EXCLUDE (copy_no) FROM numbered WHERE copy_no = 1),
tickets_clean AS MATERIALIZED (
  SELECT k.*, cast(hour(created_at) AS int) AS hour_of_day, cast(isodow(created_at) - 1 AS int) AS day_of_week,
         cast(month(created_at) AS int) AS month,
         EXISTS (SELECT 1 FROM kept o WHERE o.customer_id = k.customer_id AND o.row_seq <> k.row_seq
                 AND abs(length(o.ticket_text) - length(k.ticket_text)) <= 15) AS is_near_duplicate
  FROM kept k)"""

MEASURED = CLEAN + r""",
measured AS (
  SELECT *, length(ticket_text) AS text_length, len(regexp_extract_all(ticket_text, '\S+')) AS word_count
  FROM tickets_clean)"""

SPLIT_RANDOM = """,
split AS MATERIALIZED (
  SELECT *, CASE WHEN row_number() OVER (ORDER BY md5('42:' || ticket_id))
                      <= ceil((SELECT count(*) FROM tickets_clean) * 0.2::double) THEN 'test' ELSE 'train' END AS split
  FROM tickets_clean)"""

SPLIT_CUSTOMER = """,
customers AS (SELECT DISTINCT customer_id FROM tickets_clean),
test_customers AS (
  SELECT customer_id FROM customers
  QUALIFY row_number() OVER (ORDER BY md5('42:' || customer_id)) <= floor((SELECT count(*) FROM customers) * 0.2::double)),
split AS MATERIALIZED (
  SELECT *, CASE WHEN customer_id IN (SELECT customer_id FROM test_customers) THEN 'test' ELSE 'train' END AS split
  FROM tickets_clean)"""

OVERLAP = """
sides AS (SELECT customer_id, bool_or(split = 'test') AS in_test, bool_or(split = 'train') AS in_train FROM split GROUP BY 1)
SELECT count(*) FILTER (in_train) AS train_customers, count(*) FILTER (in_test) AS test_customers,
       count(*) FILTER (in_train AND in_test) AS shared_customers,
       round(count(*) FILTER (in_train AND in_test) * 100.0::double / count(*) FILTER (in_test), 6) AS shared_pct
FROM sides"""

TOKENS = r"regexp_extract_all(strip_accents(lower({0})), '[\p{{L}}\p{{N}}_]{{2,}}')"
BIGRAMS = "list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])"


def fitted(source: str, limit: int, name: str = "") -> str:
    """TF-IDF CTEs fitted on ``source``: vocabulary and unit vectors of its rows."""
    return rf""",
docs{name} AS (SELECT row_seq, coalesce(ticket_text, '') AS text FROM {source}),
toks{name} AS (SELECT row_seq, {TOKENS.format('text')} AS t FROM docs{name}),
tf{name} AS MATERIALIZED (
  SELECT row_seq, term, count(*) AS tf
  FROM (SELECT row_seq, unnest(list_concat(t, {BIGRAMS})) AS term FROM toks{name}) GROUP BY ALL),
chosen{name} AS (
  SELECT term, count(*) AS df, sum(tf) AS total FROM tf{name} GROUP BY term HAVING count(*) >= 2
  ORDER BY total DESC, term LIMIT {limit}),
vocabulary AS MATERIALIZED (
  SELECT term, df, row_number() OVER (ORDER BY term) - 1 AS idx,
         ln((1.0::double + (SELECT count(*) FROM docs{name})) / (1.0::double + df)) + 1 AS idf FROM chosen{name})"""


def vectors(tf: str, name: str) -> str:
    return f""",
{name} AS MATERIALIZED (
  SELECT row_seq, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY row_seq)) AS w
  FROM (SELECT row_seq, term, (ln(tf) + 1) * idf AS raw FROM {tf} JOIN vocabulary USING (term)))"""


TRAIN = CLEAN + SPLIT_CUSTOMER + """,
train AS (SELECT * FROM split WHERE split = 'train'),
test AS (SELECT * FROM split WHERE split = 'test')"""
TRAIN_FIT = TRAIN + fitted("train", 15000) + vectors("tf", "train_vec")
TEST_VEC = rf""",
test_toks AS (SELECT row_seq, {TOKENS.format("coalesce(ticket_text, '')")} AS t FROM test),
test_tf AS (
  SELECT row_seq, term, count(*) AS tf
  FROM (SELECT row_seq, unnest(list_concat(t, {BIGRAMS})) AS term FROM test_toks) GROUP BY ALL)""" + vectors("test_tf", "test_vec")

NEAR = CLEAN + fitted("tickets_clean", 5000) + vectors("tf", "vec") + """,
near AS MATERIALIZED (
  SELECT a.row_seq AS r1, b.row_seq AS r2, sum(a.w * b.w) AS cosine
  FROM vec a JOIN vec b ON a.term = b.term AND a.row_seq < b.row_seq
  GROUP BY ALL HAVING sum(a.w * b.w) >= 0.85 - 1e-9),
near_named AS MATERIALIZED (
  SELECT least(x.ticket_id, y.ticket_id) AS ticket_id_1, greatest(x.ticket_id, y.ticket_id) AS ticket_id_2,
         x.ticket_id AS tx, y.ticket_id AS ty,
         round(cosine, 4) AS similarity_score, x.customer_id = y.customer_id AS same_customer
  FROM near JOIN tickets_clean x ON x.row_seq = r1 JOIN tickets_clean y ON y.row_seq = r2)"""

PREDICTIONS = """
c AS (SELECT 'de' AS label, 0 AS k UNION ALL SELECT 'en', 1 UNION ALL SELECT 'es', 2 UNION ALL SELECT 'fr', 3),
s AS (
  SELECT d.doc_id, d.lang AS truth, c.label,
         cast(1 + (d.doc_id * 7 + c.k * 13) % 10
              + CASE WHEN d.lang = c.label AND d.doc_id % 9 <> 0 THEN 20 ELSE 0 END AS double) AS raw
  FROM documents d CROSS JOIN c),
predictions AS MATERIALIZED (
  SELECT doc_id, truth, label, raw / sum(raw) OVER (PARTITION BY doc_id) AS p, raw / 10.0E0 AS margin FROM s),
calibrated AS (SELECT doc_id, truth, label, p FROM predictions),
softmaxed AS (
  SELECT doc_id, truth, label, round(exp(margin) / sum(exp(margin)) OVER w, 12) AS p
  FROM predictions WINDOW w AS (PARTITION BY doc_id)),
scored AS MATERIALIZED (
  SELECT doc_id, truth, label AS prediction, p AS confidence FROM predictions
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY p DESC, label) = 1)"""

CLASSES = PREDICTIONS + """,
labels AS (SELECT truth AS class FROM scored UNION SELECT prediction FROM scored),
classes AS (
  SELECT class, (SELECT count(*) FROM scored WHERE truth = class) AS support,
         (SELECT count(*) FROM scored WHERE prediction = class) AS predicted,
         (SELECT count(*) FROM scored WHERE prediction = class AND truth = class) AS hit FROM labels),
rates AS (
  SELECT class, support, hit, CASE WHEN predicted > 0 THEN hit / predicted ELSE 0.0 END AS precision,
         CASE WHEN support > 0 THEN hit / support ELSE 0.0 END AS recall,
         CASE WHEN support + predicted > 0 THEN 2.0::double * hit / (support + predicted) ELSE 0.0 END AS f1 FROM classes)"""


def quantile_curve(source: str, name: str, label: str = "label") -> str:
    return f"""
{name}_rows AS (SELECT {label} AS label, CASE WHEN truth = {source}.label THEN 1.0 ELSE 0.0 END AS hit, p FROM {source}),
{name}_edges AS (
  SELECT label, quantile_cont(p, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS edges FROM {name}_rows GROUP BY label),
{name} AS (
  SELECT label, bin, avg(hit) AS fraction_positive, avg(p) AS mean_predicted, count(*) AS n
  FROM (SELECT r.label, hit, p, len(list_filter(edges, lambda e: e < p)) AS bin FROM {name}_rows r JOIN {name}_edges USING (label))
  GROUP BY label, bin)"""


def uniform_curve(source: str, name: str, keys: str = "label") -> str:
    return f"""
{name} AS (
  SELECT {keys}, len(list_filter([i / 10.0::double for i in range(1, 10)], lambda e: e < p)) AS bin,
         avg(hit) AS fraction_positive, avg(p) AS mean_predicted, count(*) AS n FROM {source} GROUP BY ALL)"""


CURVE_OUT = "bin, round(fraction_positive, 6) AS fraction_positive, round(mean_predicted, 6) AS mean_predicted, n"
LONG_HITS = "hits AS (SELECT label, CASE WHEN truth = label THEN 1.0 ELSE 0.0 END AS hit, p FROM calibrated)"

INDEX = RAW + """,
idx AS MATERIALIZED (
  SELECT concat('V-', cast(vec_id AS string)) AS ticket_id, vec_id,
         list_transform(embedding, lambda x: x::double / sqrt(list_inner_product(embedding::double[], embedding::double[]))) AS v,
         concat('src', cast(vec_id % 20 AS string)) AS product, cast(label AS string) AS category,
         coalesce(priority, 'Unknown') AS priority, coalesce(ticket_text, '') AS text, ticket_text
  FROM embeddings LEFT JOIN tickets_raw ON row_seq = vec_id)"""


def knn(k: int, where: str = "true") -> str:
    return INDEX + f""",
knn AS MATERIALIZED (
  SELECT cast(q.vec_id AS string) AS query_id, i.ticket_id, round(list_inner_product(q.v, i.v), 9) AS score,
         row_number() OVER (PARTITION BY q.vec_id ORDER BY round(list_inner_product(q.v, i.v), 9) DESC, i.ticket_id) AS rank
  FROM idx q CROSS JOIN idx i WHERE {where} QUALIFY rank <= {k})"""


PREVIEW = "CASE WHEN length(text) > 80 THEN substr(text, 1, 80) || '...' ELSE text END"

WEIGHTS = TRAIN_FIT + """,
folded AS (
  SELECT row_seq, category, (row_number() OVER (PARTITION BY category ORDER BY md5('42:' || ticket_id)) - 1) % 5 AS fold FROM train),
folds AS (SELECT unnest(range(5)) AS fold),
sizes AS (
  SELECT fo.fold, l.category AS label,
         (SELECT count(*) FROM folded x WHERE x.fold <> fo.fold AND x.category = l.category) AS n_in,
         (SELECT count(*) FROM folded x WHERE x.fold <> fo.fold AND x.category <> l.category) AS n_out
  FROM folds fo CROSS JOIN (SELECT DISTINCT category FROM train) l),
cells AS (SELECT term, fold, category, sum(w) AS s FROM train_vec JOIN folded USING (row_seq) GROUP BY ALL),
fold_w AS (
  SELECT z.fold, z.label, v.term,
         coalesce(sum(s) FILTER (c.fold <> z.fold AND c.category = z.label), 0) / z.n_in
         - coalesce(sum(s) FILTER (c.fold <> z.fold AND c.category <> z.label), 0) / z.n_out AS w
  FROM (SELECT DISTINCT term FROM cells) v CROSS JOIN sizes z JOIN cells c ON c.term = v.term
  GROUP BY z.fold, z.label, v.term, z.n_in, z.n_out),
consensus AS MATERIALIZED (SELECT label, 'text__' || term AS feature, term, avg(w) AS w FROM fold_w GROUP BY ALL)"""

EXPLAIN = WEIGHTS + TEST_VEC + "," + PREDICTIONS + """,
chosen_class AS MATERIALIZED (SELECT test.row_seq, prediction, confidence FROM test JOIN scored ON doc_id = test.row_seq),
active AS MATERIALIZED (
  SELECT v.row_seq, c.prediction, k.feature, k.w AS weight, v.w * k.w AS contribution
  FROM test_vec v JOIN chosen_class c USING (row_seq) JOIN consensus k ON k.label = c.prediction AND k.term = v.term
  WHERE k.w > 0 AND v.w * k.w > 0)"""


def top_features(n: int) -> str:
    return EXPLAIN + f""",
salient AS (
  SELECT label, feature, w FROM consensus WHERE w > 0
  QUALIFY row_number() OVER (PARTITION BY label ORDER BY w DESC, feature) <= {2 * n}),
tiers AS (
  SELECT row_seq, prediction, feature, weight, contribution, 0 AS tier, contribution AS v FROM active
  UNION ALL
  SELECT c.row_seq, c.prediction, s.feature, s.w, 0.0, 1, s.w FROM chosen_class c JOIN salient s ON s.label = c.prediction
  WHERE NOT EXISTS (SELECT 1 FROM active a WHERE a.row_seq = c.row_seq AND a.feature = s.feature)),
top AS MATERIALIZED (
  SELECT row_seq, prediction, row_number() OVER (PARTITION BY row_seq ORDER BY tier, v DESC, feature) - 1 AS position,
         replace(feature, 'text__', '') AS feature, round(weight, 4) AS weight, round(contribution, 4) AS contribution
  FROM tiers QUALIFY position < {n})"""


def scaled_rows(columns: list[str]) -> str:
    """Non-zero standardised numbers of test tickets, filled with the train median."""
    out = ""
    for c in columns:
        v = f"cast({c} AS double)"
        filled = f"coalesce({v}, (SELECT median({v}) FROM train))"
        out += f""" UNION ALL SELECT row_seq, 'num:{c}', round(z, 6) FROM (
          SELECT row_seq, ({filled} - (SELECT avg({filled}) FROM train))
            / (SELECT CASE WHEN stddev_pop({filled}) > 0 THEN stddev_pop({filled}) ELSE 1.0 END FROM train) AS z FROM test) WHERE z <> 0"""
    return out


REJECTS = f"""WITH {RAW} SELECT ticket_id, reason AS reject_reason FROM (
  SELECT ticket_id, CASE
    WHEN ticket_text IS NULL OR trim(regexp_replace(ticket_text, '\\s+', ' ', 'g')) = '' THEN 'blank text'
    WHEN previous_tickets < 0 THEN 'negative previous_tickets'
    WHEN {STAMP} IS NULL THEN 'malformed created_at' END AS reason FROM tickets_raw) WHERE reason IS NOT NULL"""


def _nulls(columns: list[str], pct: bool = True) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS n, "
        f"round(count(*) FILTER ({c} IS NULL) * 100.0::double / count(*), 6) AS pct FROM tickets_raw" for c in columns)


RAW_COLUMNS = ["ticket_id", "customer_id", "ticket_text", "product", "created_at", "previous_tickets", "resolution_time",
               "priority", "category", "resolved"]
CLEAN_COLUMNS = RAW_COLUMNS + ["hour_of_day", "day_of_week", "month", "is_near_duplicate"]
KEYS = "customer_id, ticket_text, product, created_at, previous_tickets, resolution_time, priority, category, resolved"
DUPLICATES = "(SELECT coalesce(sum(n - 1), 0) FROM (SELECT count(*) AS n FROM {0} GROUP BY {1}))"


def _audit(source: str, columns: list[str], bad_stamp: str, keys: str) -> str:
    rows = ["SELECT 'total_rows' AS check_name, count(*) AS n FROM {s}"]
    rows += [f"SELECT 'missing:{c}', count(*) FILTER ({c} IS NULL) FROM {{s}}" for c in columns]
    rows += [f"SELECT 'malformed_timestamps', count(*) FILTER ({bad_stamp}) FROM {{s}}",
             "SELECT 'negative_previous_tickets', count(*) FILTER (previous_tickets < 0) FROM {s}",
             "SELECT 'resolution_time_outliers', count(*) FILTER (resolution_time < 0 OR resolution_time > 8760) FROM {s}",
             f"SELECT 'exact_duplicates', cast({DUPLICATES.format('{s}', keys)} AS bigint)"]
    return " UNION ALL ".join(rows).replace("{s}", source)


AUDIT_RAW = _audit("tickets_raw", RAW_COLUMNS, f"{STAMP} IS NULL", KEYS)
AUDIT_CLEAN = _audit("tickets_clean", CLEAN_COLUMNS, "created_at IS NULL", KEYS + ", hour_of_day, day_of_week, month")

HISTOGRAM = """,
span AS (SELECT min({c})::double AS lo, max({c})::double AS hi FROM measured),
bins AS (SELECT unnest(range({k})) AS bin)
SELECT cast(bin AS int) AS bin, round(lo + bin * ((hi - lo) / {k}), 4) AS low_edge, round(lo + (bin + 1) * ((hi - lo) / {k}), 4) AS high_edge,
       (SELECT count(*) FROM measured WHERE least(floor(({c} - lo) / (hi - lo) * {k}), {k} - 1) = bin) AS n
FROM bins CROSS JOIN span"""

CONTAMINATION = """
SELECT sc.same_customer, (
  SELECT count(*) FROM near_named n JOIN split a ON a.ticket_id = n.tx JOIN split b ON b.ticket_id = n.ty
  WHERE a.split <> b.split AND n.same_customer = sc.same_customer) AS pairs
FROM (SELECT true AS same_customer UNION ALL SELECT false) sc"""

ORACLES: dict[str, str] = {
    "csv_source": f"WITH {RAW} SELECT * EXCLUDE (row_seq) REPLACE (nullif(created_at, '') AS created_at) FROM tickets_raw",
    "clean_table_round_trip": f"""WITH {CLEAN} SELECT * REPLACE (strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at) FROM tickets_clean""",
    "clean_csv_files": f"""WITH {CLEAN} SELECT * EXCLUDE (row_seq) REPLACE (strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at) FROM tickets_clean""",
    "stored_vocabulary": f"WITH {TRAIN_FIT} SELECT term, idx, df, round(idf, 6) AS idf FROM vocabulary",
    "stored_metrics": f"""WITH {CLASSES} SELECT 'fixture-run' AS run_id, metric, round(value, 6) AS value FROM (
        SELECT 'accuracy' AS metric, sum(hit) / sum(support) AS value FROM rates UNION ALL
        SELECT 'macro_f1', avg(f1) FROM rates UNION ALL
        SELECT 'weighted_f1', sum(f1 * support) / sum(support) FROM rates UNION ALL
        SELECT 'rows', cast(sum(support) AS double) FROM rates)""",
    "total_rows": f"WITH {RAW} SELECT count(*) AS total_rows FROM tickets_raw",
    "null_counts": f"WITH {RAW} {_nulls(RAW_COLUMNS)}",
    "exact_duplicate_count": f"WITH {RAW} SELECT cast({DUPLICATES.format('tickets_raw', KEYS)} AS bigint) AS exact_duplicates",
    "defect_counts": f"""WITH {RAW} SELECT count(*) FILTER ({STAMP} IS NULL) AS malformed_timestamps,
        count(*) FILTER (previous_tickets < 0) AS negative_previous_tickets,
        count(*) FILTER (resolution_time < 0 OR resolution_time > 8760) AS resolution_time_outliers FROM tickets_raw""",
    "audit_report": f"""WITH {RAW}, audit AS ({AUDIT_RAW})
        SELECT check_name, n, round(n * 100.0::double / (SELECT count(*) FROM tickets_raw), 6) AS pct FROM audit""",
    "before_after_summary": f"""WITH {CLEAN}, b AS ({AUDIT_RAW} UNION ALL SELECT 'columns', 10),
        a AS ({AUDIT_CLEAN} UNION ALL SELECT 'columns', 14
              UNION ALL SELECT 'near_duplicates_flagged', count(*) FILTER (is_near_duplicate) FROM tickets_clean)
        SELECT check_name, b.n AS n_before, a.n AS n_after FROM b FULL JOIN a USING (check_name)""",
    "missing_value_table": f"WITH {RAW} SELECT * FROM ({_nulls(RAW_COLUMNS)}) WHERE n > 0",
    "null_patterns": f"""WITH {RAW} SELECT concat_ws(',', {', '.join(f"CASE WHEN {c} IS NULL THEN '{c}' END" for c in RAW_COLUMNS)})
        AS null_columns, count(*) AS n FROM tickets_raw GROUP BY 1""",
    "normalised_text": f"WITH {RAW} SELECT ticket_id, {NORMAL} AS ticket_text FROM tickets_raw WHERE ticket_text IS NOT NULL",
    "parsed_timestamps": f"""WITH {RAW}, p AS (SELECT ticket_id, {STAMP} AS stamp FROM tickets_raw)
        SELECT ticket_id, strftime(stamp, '%Y-%m-%d %H:%M:%S') AS created_at, cast(hour(stamp) AS int) AS hour_of_day,
               cast(isodow(stamp) - 1 AS int) AS day_of_week, cast(month(stamp) AS int) AS month FROM p WHERE stamp IS NOT NULL""",
    "cleaned_previous_tickets": f"""WITH {RAW} SELECT ticket_id, greatest(coalesce(previous_tickets, 0.0), 0.0) AS previous_tickets
        FROM tickets_raw""",
    "capped_hours": f"WITH {RAW} SELECT ticket_id, {CAPPED} AS resolution_time FROM tickets_raw",
    "imputed_hours": f"""WITH {RAW}, c AS (SELECT ticket_id, resolved, {CAPPED} AS h FROM tickets_raw)
        SELECT ticket_id, resolved, round(CASE WHEN resolved AND h IS NULL THEN (SELECT median(h) FROM c WHERE resolved) ELSE h END, 6)
        AS resolution_time FROM c""",
    "imputation_report": f"""WITH {STAGED} SELECT count(*) FILTER (previous_tickets IS NULL) AS previous_filled,
        count(*) FILTER (previous_tickets < 0) AS previous_clipped,
        count(*) FILTER (resolution_time < 0 OR resolution_time > 8760) AS hours_capped,
        count(*) FILTER (resolved AND resolution_time IS NULL) AS hours_imputed,
        count(*) FILTER (NOT resolved AND resolution_time IS NULL) AS hours_left_open,
        round(median({CAPPED}) FILTER (resolved), 6) AS median_hours FROM staged""",
    "clean_tickets": f"""WITH {CLEAN} SELECT * REPLACE (strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at,
        round(resolution_time, 6) AS resolution_time) FROM tickets_clean""",
    "text_measures": f"WITH {MEASURED} SELECT ticket_id, cast(text_length AS int) AS text_length, cast(word_count AS int) AS word_count FROM measured",
    "validated_requests": r"""WITH r AS (
        SELECT conv_id, turn, CASE WHEN role = 'user' THEN regexp_replace(text, '^\s+|\s+$', '', 'g') WHEN turn % 4 = 1 THEN '' END AS ticket_text,
               CASE WHEN turn > 1 THEN 'web' ELSE 'general' END AS product,
               cast(CASE WHEN turn > 0 THEN turn - 2 ELSE 0 END AS int) AS previous_tickets,
               cast(CASE WHEN conv_id % 3 > 0 THEN conv_id % 60 ELSE 5 END AS int) AS top_k,
               cast(CASE WHEN conv_id % 2 > 0 THEN conv_id % 25 ELSE 5 END AS int) AS top_n FROM conversations)
        SELECT *, CASE WHEN ticket_text IS NULL OR regexp_replace(ticket_text, '\s', '', 'g') = '' THEN 'blank text'
                       WHEN previous_tickets < 0 THEN 'negative previous_tickets'
                       WHEN top_k NOT BETWEEN 1 AND 50 THEN 'top_k out of range'
                       WHEN top_n NOT BETWEEN 1 AND 20 THEN 'top_n out of range' END AS reject_reason FROM r""",
    "exact_dedupe": f"""WITH {RAW} SELECT row_seq, ticket_id, customer_id FROM tickets_raw
        QUALIFY row_number() OVER (PARTITION BY {KEYS} ORDER BY row_seq) = 1""",
    "near_duplicate_flags": f"WITH {CLEAN} SELECT ticket_id, is_near_duplicate FROM tickets_clean",
    "recomputed_previous_tickets": f"""WITH {CLEAN} SELECT ticket_id, customer_id,
        row_number() OVER (PARTITION BY customer_id ORDER BY created_at, ticket_id) - 1 AS previous_count FROM tickets_clean""",
    "near_duplicate_groups": f"""WITH {NEAR},
        shapes AS (SELECT row_seq, string_agg(term || ':' || tf, '|' ORDER BY term) AS shape FROM tf JOIN vocabulary USING (term) GROUP BY 1),
        member AS MATERIALIZED (SELECT ticket_id, min(ticket_id) OVER (PARTITION BY shape) AS g FROM shapes JOIN tickets_clean USING (row_seq))
        SELECT least(a.g, b.g) AS ticket_id_1, greatest(a.g, b.g) AS ticket_id_2, max(similarity_score) AS similarity_score,
               count(*) AS ticket_pairs, count(*) FILTER (same_customer) AS same_customer_pairs
        FROM near_named n JOIN member a ON a.ticket_id = n.tx JOIN member b ON b.ticket_id = n.ty
        GROUP BY least(a.g, b.g), greatest(a.g, b.g)""",
    "near_duplicate_relation": f"""WITH {NEAR} SELECT s.same_customer, count(n.tx) AS pairs,
        round(count(n.tx) * 100.0::double / greatest((SELECT count(*) FROM near_named), 1), 6) AS pct
        FROM (SELECT true AS same_customer UNION ALL SELECT false) s LEFT JOIN near_named n USING (same_customer) GROUP BY 1""",
    "top_near_duplicates": f"""WITH {NEAR}, best AS (
        SELECT ticket_id_1, ticket_id_2, similarity_score, same_customer FROM near_named ORDER BY 3 DESC, 1, 2 LIMIT 5)
        SELECT ticket_id_1, ticket_id_2, a.customer_id AS customer_id_1, b.customer_id AS customer_id_2, a.ticket_text AS text_1,
               b.ticket_text AS text_2, similarity_score, same_customer
        FROM best JOIN tickets_clean a ON a.ticket_id = ticket_id_1 JOIN tickets_clean b ON b.ticket_id = ticket_id_2""",
    "lexical_pair_similarity": rf"""WITH p AS MATERIALIZED (
          SELECT a.conv_id, a.turn, a.text AS x, b.text AS y FROM conversations a JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1),
        toks AS (SELECT conv_id, turn, 0 AS side, regexp_extract_all(lower(x), '[\p{{L}}\p{{N}}_]{{2,}}') AS t FROM p UNION ALL
                 SELECT conv_id, turn, 1, regexp_extract_all(lower(y), '[\p{{L}}\p{{N}}_]{{2,}}') FROM p),
        tf AS (SELECT conv_id, turn, term, count(*) FILTER (side = 0) AS a, count(*) FILTER (side = 1) AS b
               FROM (SELECT conv_id, turn, side, unnest(list_concat(t, {BIGRAMS})) AS term FROM toks) GROUP BY ALL),
        w AS (SELECT conv_id, turn, CASE WHEN a > 0 THEN (ln(a) + 1) * idf ELSE 0.0 END AS a, CASE WHEN b > 0 THEN (ln(b) + 1) * idf ELSE 0.0 END AS b
              FROM (SELECT *, ln(3.0::double / (1 + (a > 0)::int + (b > 0)::int)) + 1 AS idf FROM tf)),
        c AS (SELECT conv_id, turn, CASE WHEN sqrt(sum(a * a)) * sqrt(sum(b * b)) > 0 THEN sum(a * b) / (sqrt(sum(a * a)) * sqrt(sum(b * b))) ELSE 0.0 END AS s
              FROM w GROUP BY ALL)
        SELECT p.conv_id, p.turn, round(coalesce(s, 0.0), 4) AS similarity,
               array_to_string(list_sort(list_distinct(list_intersect(regexp_extract_all(x, '\S+'), regexp_extract_all(y, '\S+')))), ' ') AS shared_words
        FROM p LEFT JOIN c USING (conv_id, turn)""",
    "contamination_random_split": f"WITH {NEAR}{SPLIT_RANDOM} {CONTAMINATION}",
    "contamination_customer_split": f"WITH {NEAR}{SPLIT_CUSTOMER} {CONTAMINATION}",
    "category_frequency": f"""WITH {CLEAN} SELECT category, count(*) AS n, round(count(*) * 100.0::double / sum(count(*)) OVER (), 6) AS pct,
        count(*) < 100 AS is_rare FROM tickets_clean GROUP BY 1""",
    "priority_distribution": f"""WITH {CLEAN}, o AS (SELECT * FROM (VALUES (0, 'LOW'), (1, 'MEDIUM'), (2, 'HIGH')) v(position, priority)),
        c AS (SELECT priority, count(*) AS n FROM tickets_clean GROUP BY 1)
        SELECT position, priority, n, round(n * 100.0::double / (SELECT count(*) FROM tickets_clean), 6) AS pct FROM o LEFT JOIN c USING (priority)""",
    "product_frequency": f"""WITH {CLEAN} SELECT product, count(*) AS n, round(count(*) * 100.0::double / sum(count(*)) OVER (), 6) AS pct
        FROM tickets_clean GROUP BY 1""",
    "length_statistics": f"""WITH {MEASURED} {' UNION ALL '.join(
        f"SELECT '{c}' AS measure, min({c})::double AS min, max({c})::double AS max, round(avg({c}), 4) AS mean, "
        f"round(median({c}), 4) AS median, round(stddev_samp({c}), 4) AS std FROM measured" for c in ('text_length', 'word_count'))}""",
    "length_histogram": f"WITH {MEASURED}{HISTOGRAM.format(c='text_length', k=40)}",
    "word_histogram": f"WITH {MEASURED}{HISTOGRAM.format(c='word_count', k=30)}",
    "length_vs_hours": f"""WITH {MEASURED} SELECT count(*) AS n, round(corr(text_length, resolution_time), 6) AS pearson_r,
        round(least(800.0, quantile_cont(resolution_time, 0.98)), 6) AS hours_cap
        FROM measured WHERE resolved AND resolution_time IS NOT NULL""",
    "top_customers": f"WITH {CLEAN} SELECT customer_id, count(*) AS n FROM tickets_clean GROUP BY 1 ORDER BY n DESC, customer_id LIMIT 20",
    "customer_concentration": f"""WITH {CLEAN}, c AS (SELECT customer_id, count(*) AS n FROM tickets_clean GROUP BY 1),
        top AS (SELECT n FROM c ORDER BY n DESC, customer_id LIMIT 20)
        SELECT count(*) AS customers, cast(sum(n) AS bigint) AS tickets, cast((SELECT sum(n) FROM top) AS bigint) AS top_tickets,
               round((SELECT sum(n) FROM top) * 100.0::double / sum(n), 6) AS top_pct FROM c""",
    "monthly_volume": f"""WITH {CLEAN}, m AS (SELECT date_trunc('month', created_at)::date AS month_start, count(*) AS n FROM tickets_clean GROUP BY 1),
        every AS (SELECT unnest(generate_series((SELECT min(month_start) FROM m)::timestamp, (SELECT max(month_start) FROM m)::timestamp, INTERVAL 1 MONTH))::date AS month_start)
        SELECT strftime(month_start, '%Y-%m-%d') AS month_start, strftime(month_start, '%b %Y') AS label, coalesce(n, 0) AS n FROM every LEFT JOIN m USING (month_start)""",
    "category_priority_crosstab": f"""WITH {CLEAN} SELECT category, {', '.join(
        f"round(count(*) FILTER (priority = '{p}') * 100.0::double / count(priority), 1) AS {p.lower()}_pct" for p in ('LOW', 'MEDIUM', 'HIGH'))}
        FROM tickets_clean GROUP BY 1""",
    "hourly_volume": f"WITH {CLEAN} SELECT hour_of_day, count(*) AS n FROM tickets_clean GROUP BY 1",
    "table_summary": f"""WITH {RAW} SELECT count(*) AS tickets, count(*) FILTER (resolved) AS resolved, count(*) FILTER (ticket_text IS NULL) AS null_text,
        count(DISTINCT category) AS categories, count(DISTINCT priority) AS priorities FROM tickets_raw""",
    "ticket_tokens": f"WITH {CLEAN} SELECT ticket_id, array_to_string({TOKENS.format('ticket_text')}, ' ') AS tokens FROM tickets_clean",
    "ticket_bigrams": f"""WITH {CLEAN}, k AS (SELECT ticket_id, {TOKENS.format('ticket_text')} AS t FROM tickets_clean)
        SELECT ticket_id, len({BIGRAMS}) AS n_bigrams, md5(coalesce(array_to_string({BIGRAMS}, '|'), '')) AS bigrams_md5 FROM k""",
    "accents_stripped": f"WITH {CLEAN} SELECT ticket_id, strip_accents(ticket_text) AS plain_text FROM tickets_clean",
    "accents_stripped_nfkd": f"WITH {CLEAN} SELECT ticket_id, strip_accents(ticket_text) AS plain_text FROM tickets_clean",
    "tfidf_weights": f"WITH {TRAIN_FIT} SELECT row_seq, term, round(w, 6) AS weight FROM train_vec",
    "tfidf_weights_of_test": f"WITH {TRAIN_FIT}{TEST_VEC} SELECT row_seq, term, round(w, 6) AS weight FROM test_vec",
    "product_one_hot": f"""WITH {TRAIN}, p AS (SELECT product, row_number() OVER (ORDER BY product) - 1 AS i FROM (SELECT DISTINCT product FROM train))
        SELECT ticket_id, test.product, CASE WHEN i IS NULL THEN 0 ELSE 1 END AS ones, coalesce(i, -1) AS position
        FROM test LEFT JOIN p ON p.product = test.product""",
    "numeric_statistics": f"""WITH {TRAIN} {' UNION ALL '.join(
        f"SELECT '{c}' AS feature, round(m, 6) AS median, round(avg(coalesce({c}, m)), 6) AS mean, "
        f"round(CASE WHEN stddev_pop(coalesce({c}, m)) > 0 THEN stddev_pop(coalesce({c}, m)) ELSE 1.0 END, 6) AS std "
        f"FROM train, (SELECT median({c}) AS m FROM train) GROUP BY m"
        for c in ('previous_tickets', 'hour_of_day', 'day_of_week', 'month', 'resolution_time'))}""",
    "scaled_numbers": f"""WITH {TRAIN} SELECT ticket_id, {', '.join(
        f"round((coalesce({c}, (SELECT median({c}) FROM train)) - (SELECT avg({c}) FROM train)) / (SELECT CASE WHEN stddev_pop({c}) > 0 THEN stddev_pop({c}) ELSE 1.0 END FROM train), 6) AS {c}"
        for c in ('previous_tickets', 'hour_of_day', 'day_of_week', 'month'))} FROM test""",
    "class_weights": f"""WITH {TRAIN} SELECT priority, round((SELECT count(*) FROM train) / ((SELECT count(DISTINCT priority) FROM train) * count(*)::double), 6) AS weight
        FROM train GROUP BY 1""",
    "label_codes": f"WITH {TRAIN} SELECT priority, row_number() OVER (ORDER BY priority) - 1 AS code FROM (SELECT DISTINCT priority FROM train)",
    "feature_names": f"""WITH {TRAIN_FIT}, p AS (SELECT product, row_number() OVER (ORDER BY product) - 1 AS i FROM (SELECT DISTINCT product FROM train)),
        sizes AS (SELECT (SELECT count(*) FROM vocabulary) AS v, (SELECT count(*) FROM p) AS c)
        SELECT idx, 'word:' || term AS name FROM vocabulary UNION ALL
        SELECT v + i, 'cat:product_' || product FROM p, sizes UNION ALL
        SELECT v + c + k, 'num:' || f FROM sizes, (VALUES (0, 'previous_tickets'), (1, 'hour_of_day'), (2, 'day_of_week'), (3, 'month')) n(k, f)""",
    "leakage_guard": f"""WITH {CLEAN}, c AS ({' UNION ALL '.join(f"SELECT '{c}' AS feature, count({c}) AS filled FROM tickets_clean" for c in CLEAN_COLUMNS)})
        SELECT feature, CASE WHEN feature IN ('resolution_time', 'resolved') THEN 'post-outcome'
          WHEN feature IN ('ticket_text', 'product', 'previous_tickets', 'hour_of_day', 'day_of_week', 'month') THEN 'model input' ELSE 'not used' END AS role,
          CASE feature WHEN 'resolution_time' THEN 'filled in when a ticket is closed' WHEN 'resolved' THEN 'set when a ticket is closed' END AS reason, filled FROM c""",
    "random_row_split": f"WITH {CLEAN}{SPLIT_RANDOM} SELECT ticket_id, split FROM split",
    "customer_disjoint_split": f"WITH {CLEAN}{SPLIT_CUSTOMER} SELECT ticket_id, customer_id, split FROM split",
    "random_split_overlap": f"WITH {CLEAN}{SPLIT_RANDOM}, {OVERLAP}",
    "customer_split_overlap": f"WITH {CLEAN}{SPLIT_CUSTOMER}, {OVERLAP}",
    "stratified_folds": f"""WITH {CLEAN} SELECT ticket_id, category,
        (row_number() OVER (PARTITION BY category ORDER BY md5('42:' || ticket_id)) - 1) % 5 AS fold FROM tickets_clean""",
    "retrieval_index": f"""WITH {INDEX} SELECT ticket_id, product, category, priority, text, len(v) AS dim, round(list_inner_product(v, v), 6) AS squared_norm FROM idx""",
    "retrieval_index_properties": f"WITH {INDEX} SELECT count(*) AS total_records, max(len(v)) AS embedding_dim, 'given vectors' AS model_name, true AS dated FROM idx",
    "similar_tickets": f"""WITH {knn(5)} SELECT query_id, rank, ticket_id, round(score, 4) AS similarity, category, priority, product,
        {PREVIEW} AS preview, text FROM knn JOIN idx USING (ticket_id)""",
    "similar_tickets_of_text": f"""WITH {knn(3, "q.ticket_text IS NOT NULL AND trim(regexp_replace(q.ticket_text, '[[:space:]]+', ' ', 'g')) <> ''")}
        SELECT query_id, rank, ticket_id, round(score, 4) AS similarity, {PREVIEW} AS preview FROM knn JOIN idx USING (ticket_id)""",
    "high_matches": f"""WITH {knn(10)} SELECT query_id, rank, ticket_id, round(score, 4) >= 0.7 AS high_match FROM knn""",
    "similar_tickets_of_many": f"""WITH {INDEX}, asked AS (
        SELECT concat(vec_id, ':', s) AS query_id, list_concat(v[s + 1:], v[1:s]) AS v FROM idx, (SELECT unnest(range(10)) AS s)),
        scored AS (SELECT query_id, ticket_id, round(list_inner_product(asked.v, idx.v), 9) AS score FROM asked CROSS JOIN idx)
        SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, ticket_id) AS rank, ticket_id, round(score, 6) AS score
        FROM scored QUALIFY rank <= 3""",
    "index_append": f"""WITH {CLEAN}, i AS (SELECT concat('V-', cast(vec_id AS string)) AS ticket_id, concat('src', cast(vec_id % 20 AS string)) AS product,
        cast(label AS string) AS category, vec_id FROM embeddings)
        SELECT ticket_id, product, category FROM i WHERE vec_id NOT IN (SELECT row_seq FROM tickets_clean)""",
    "index_upsert": f"""WITH {CLEAN}, i AS (SELECT vec_id, label, coalesce(r.priority, 'Unknown') AS priority FROM embeddings LEFT JOIN tickets_raw r ON r.row_seq = vec_id)
        SELECT concat('V-', cast(vec_id AS string)) AS ticket_id, concat('src', cast(vec_id % 20 AS string)) AS product, cast(label AS string) AS category,
        CASE WHEN vec_id IN (SELECT row_seq FROM tickets_clean) THEN 'REVIEWED' ELSE priority END AS priority FROM i""",
    "metric_summary": f"""WITH {CLASSES} SELECT round(sum(hit) / sum(support), 6) AS accuracy, round(avg(f1), 6) AS macro_f1,
        round(sum(f1 * support) / sum(support), 6) AS weighted_f1, cast(sum(support) AS bigint) AS rows FROM rates""",
    "classification_report": f"""WITH {CLASSES}, r AS (
        SELECT class, precision, recall, f1, support FROM rates UNION ALL
        SELECT 'accuracy', NULL, NULL, sum(hit) / sum(support), cast(sum(support) AS bigint) FROM rates UNION ALL
        SELECT 'macro avg', avg(precision), avg(recall), avg(f1), cast(sum(support) AS bigint) FROM rates UNION ALL
        SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support), sum(f1 * support) / sum(support),
               cast(sum(support) AS bigint) FROM rates)
        SELECT class, round(precision, 4) AS precision, round(recall, 4) AS recall, round(f1, 4) AS f1, support FROM r""",
    "confusion_matrix": f"""WITH {CLASSES} SELECT a.class AS label, b.class AS prediction,
        (SELECT count(*) FROM scored WHERE truth = a.class AND prediction = b.class) AS n FROM labels a CROSS JOIN labels b""",
    "confusion_matrix_wide": f"""WITH {CLASSES} SELECT class AS label, {', '.join(
        f"(SELECT count(*) FROM scored WHERE truth = class AND prediction = '{c}') AS {c}" for c in ('de', 'en', 'es', 'fr'))} FROM labels""",
    "model_winner": f"WITH {CLASSES} SELECT 'by_margin' AS model, round(avg(f1), 6) AS macro_f1 FROM rates",
    "brier_by_class": f"WITH {PREDICTIONS}, {LONG_HITS} SELECT label, round(avg((hit - p) ** 2), 6) AS brier FROM hits GROUP BY 1",
    "reliability_quantile": f"WITH {PREDICTIONS}, {quantile_curve('calibrated', 'curve')} SELECT label, {CURVE_OUT} FROM curve",
    "reliability_uniform": f"WITH {PREDICTIONS}, {LONG_HITS}, {uniform_curve('hits', 'curve')} SELECT label, {CURVE_OUT} FROM curve",
    "adaptive_calibration_error": f"""WITH {PREDICTIONS}, {quantile_curve('calibrated', 'curve')}
        SELECT label, round(avg(abs(fraction_positive - mean_predicted)), 6) AS ece FROM curve GROUP BY 1""",
    "calibration_report": f"""WITH {PREDICTIONS}, {quantile_curve('calibrated', 'cc')}, {quantile_curve('softmaxed', 'rc')},
        k AS (SELECT label, (SELECT avg((hit - p) ** 2) FROM cc_rows x WHERE x.label = l.label) AS cb,
                     (SELECT avg(abs(fraction_positive - mean_predicted)) FROM cc x WHERE x.label = l.label) AS ce,
                     (SELECT avg((hit - p) ** 2) FROM rc_rows x WHERE x.label = l.label) AS rb,
                     (SELECT avg(abs(fraction_positive - mean_predicted)) FROM rc x WHERE x.label = l.label) AS re
              FROM (SELECT DISTINCT label FROM calibrated) l),
        u AS (SELECT * FROM k UNION ALL SELECT '(mean)', avg(cb), avg(ce), avg(rb), avg(re) FROM k)
        SELECT label, round(cb, 6) AS calibrated_brier, round(ce, 6) AS calibrated_ece, round(rb, 6) AS raw_brier, round(re, 6) AS raw_ece,
               CASE WHEN label = '(mean)' AND rb > 0 THEN round((rb - cb) / rb * 100, 2) END AS brier_reduction_pct FROM u""",
    "pooled_reliability": f"""WITH {PREDICTIONS}, {quantile_curve('softmaxed', 'rq', "'(all)'")}, {quantile_curve('calibrated', 'cq', "'(all)'")},
        {LONG_HITS}, {uniform_curve('hits', 'cu', "'(all)' AS label")}
        SELECT 'raw_quantile' AS curve, {CURVE_OUT} FROM rq UNION ALL SELECT 'calibrated_quantile', {CURVE_OUT} FROM cq
        UNION ALL SELECT 'calibrated_uniform', {CURVE_OUT} FROM cu""",
    "selected_reliability": f"""WITH {PREDICTIONS}, {quantile_curve('calibrated', 'curve')}
        SELECT label, {CURVE_OUT} FROM curve WHERE label IN ('en', 'fr', 'no such class')""",
    "raw_softmax": f"WITH {PREDICTIONS} SELECT doc_id, label, round(p, 6) AS p FROM softmaxed",
    "ood_guard": f"""WITH {PREDICTIONS} SELECT doc_id, confidence < 0.5 AS uncertain,
        CASE WHEN confidence < 0.5 THEN 'low_confidence' ELSE 'in_distribution' END AS reason, round(confidence, 4) AS max_confidence,
        CASE WHEN confidence < 0.5 THEN NULL ELSE prediction END AS predicted_category, 0.5::double AS threshold FROM scored""",
    "ood_benchmark": f"""WITH {PREDICTIONS} SELECT doc_id, confidence < 0.5 AS uncertain, doc_id % 9 = 0 AS expected_uncertain,
        CASE WHEN (confidence < 0.5) = (doc_id % 9 = 0) THEN 'PASSED' ELSE 'FAILED' END AS result FROM scored""",
    "confidence_routing": f"""WITH {PREDICTIONS} SELECT CASE WHEN confidence >= 0.85 THEN 'auto' WHEN confidence >= 0.5 THEN 'tier_1' ELSE 'human' END AS queue,
        count(*) AS n FROM scored GROUP BY 1""",
    "sla_labels": f"""WITH {RAW}, l AS (SELECT CASE WHEN resolved THEN lower(priority) ELSE priority END AS priority FROM tickets_raw)
        SELECT priority, CASE upper(priority) WHEN 'HIGH' THEN 'CRITICAL / IMMEDIATE ATTENTION' WHEN 'MEDIUM' THEN 'STANDARD QUEUE SLA (12H)'
          WHEN 'LOW' THEN 'ROUTINE INQUIRY QUEUE SLA (24H)' ELSE 'UNASSIGNED QUEUE' END AS sla, count(*) AS n FROM l GROUP BY ALL""",
    "score_drift": f"""WITH {PREDICTIONS},
        dated AS (SELECT strftime(ts, '%Y-%m-%d') AS window_start, label, CASE WHEN truth = label THEN 1.0 ELSE 0.0 END AS hit, p
                  FROM calibrated JOIN events ON event_id = doc_id),
        fit AS (SELECT 'fit' AS window_start, label, CASE WHEN truth = label THEN 1.0 ELSE 0.0 END AS hit, p FROM calibrated),
        both_sides AS (SELECT * FROM dated UNION ALL SELECT * FROM fit),
        edges AS (SELECT window_start, label, quantile_cont(p, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS cuts FROM both_sides GROUP BY ALL),
        curve AS (SELECT window_start, label, len(list_filter(cuts, lambda e: e < p)) AS bin, avg(hit) AS fraction_positive, avg(p) AS mean_predicted
                  FROM both_sides JOIN edges USING (window_start, label) GROUP BY ALL),
        dc AS (SELECT * FROM curve WHERE window_start <> 'fit'), fc AS (SELECT * FROM curve WHERE window_start = 'fit'),
        d AS (SELECT window_start, label, avg((hit - p) ** 2) AS brier FROM dated GROUP BY ALL),
        de AS (SELECT window_start, label, avg(abs(fraction_positive - mean_predicted)) AS ece FROM dc GROUP BY ALL),
        f AS (SELECT label, avg((hit - p) ** 2) AS fit_brier FROM fit GROUP BY ALL),
        fe AS (SELECT label, avg(abs(fraction_positive - mean_predicted)) AS fit_ece FROM fc GROUP BY ALL)
        SELECT window_start, label, round(brier, 6) AS brier, round(ece, 6) AS ece, round(fit_brier, 6) AS fit_brier, round(fit_ece, 6) AS fit_ece,
               round(brier - fit_brier, 6) AS brier_change, round(ece - fit_ece, 6) AS ece_change
        FROM d JOIN de USING (window_start, label) JOIN f USING (label) JOIN fe USING (label)""",
    "consensus_weights": f"WITH {WEIGHTS} SELECT label, feature, round(w, 6) AS w FROM consensus",
    "active_contributions": f"""WITH {EXPLAIN} SELECT row_seq, feature, round(weight, 4) AS weight, round(contribution, 4) AS contribution FROM active""",
    "explanations_top_10": f"WITH {top_features(10)} SELECT row_seq, prediction, position, feature, weight, contribution FROM top",
    "explanation_texts": f"""WITH {top_features(5)}, lines AS (
        SELECT row_seq, string_agg(CASE WHEN contribution > 0
          THEN printf('  %2d. "%s" -> weight: %+.4f (local contribution: %+.4f)', position + 1, feature, weight, contribution)
          ELSE printf('  %2d. "%s" -> class weight: %+.4f', position + 1, feature, weight) END, chr(10) ORDER BY position) AS body FROM top GROUP BY 1)
        SELECT row_seq, printf('Predicted Category: %s (Confidence: %.1f%%)', prediction, round(confidence, 4) * 100) || chr(10)
          || 'Key Contributing Words & Signals:' || coalesce(chr(10) || body, '') AS explanation
        FROM chosen_class LEFT JOIN lines USING (row_seq)""",
    "chart_labels": f"""WITH {TRAIN_FIT} SELECT term, CASE WHEN length(term) > 20 THEN substr(term, 1, 18) || '...' ELSE term END AS chart_label FROM vocabulary""",
    "streaming_volume": f"""WITH {STAGED} SELECT strftime(date_trunc('day', created_at), '%Y-%m-%d %H:%M:%S') AS window_start, product, count(*) AS n
        FROM staged GROUP BY ALL""",
    "streaming_resubmissions": f"""WITH {STAGED}, rowwise AS (
        SELECT * REPLACE (greatest(coalesce(previous_tickets, 0.0), 0.0) AS previous_tickets, {CAPPED} AS resolution_time) FROM staged),
        forms AS (SELECT DISTINCT {KEYS} FROM rowwise)
        SELECT customer_id, product, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at, priority, category, ticket_text, previous_tickets,
               resolution_time, resolved FROM forms""",
    "streaming_volume_late": f"""WITH {STAGED}, span AS (SELECT min(epoch(created_at)) AS low, max(epoch(created_at)) AS high FROM (
          SELECT {STAMP} AS created_at FROM tickets_raw))
        SELECT strftime(date_trunc('day', created_at), '%Y-%m-%d %H:%M:%S') AS window_start, product, count(*) AS n
        FROM staged, span WHERE NOT ((epoch(created_at) - low) / (high - low + 1) < 1.0::double / 3 AND row_seq % 7 = 3) GROUP BY ALL""",
    "triage_rejects": REJECTS, "streaming_rejects": REJECTS,
    "near_duplicate_ticket_pairs": f"""WITH {NEAR} SELECT least(x.ticket_id, y.ticket_id) AS ticket_id_1, greatest(x.ticket_id, y.ticket_id) AS ticket_id_2,
          CASE WHEN x.ticket_id < y.ticket_id THEN x.customer_id ELSE y.customer_id END AS customer_id_1,
          CASE WHEN x.ticket_id < y.ticket_id THEN y.customer_id ELSE x.customer_id END AS customer_id_2,
          CASE WHEN x.ticket_id < y.ticket_id THEN x.ticket_text ELSE y.ticket_text END AS text_1,
          CASE WHEN x.ticket_id < y.ticket_id THEN y.ticket_text ELSE x.ticket_text END AS text_2,
          round(cosine, 4) AS similarity_score, x.customer_id = y.customer_id AS same_customer
        FROM near JOIN tickets_clean x ON x.row_seq = r1 JOIN tickets_clean y ON y.row_seq = r2
        WHERE cosine >= 0.9 - 1e-9 AND (r1 % 50 = 0 OR r2 % 50 = 0)""",
    "fused_features": f"""WITH {TRAIN_FIT}{TEST_VEC} SELECT row_seq, 'word:' || term AS name, round(w, 6) AS x FROM test_vec
        UNION ALL SELECT row_seq, 'cat:product_' || product, 1.0 FROM test WHERE product IN (SELECT product FROM train)
        {scaled_rows(["previous_tickets", "hour_of_day", "day_of_week", "month"])}""",
    "leaky_features": f"""WITH {TRAIN}, dropped AS (SELECT 1) SELECT NULL::BIGINT AS row_seq, '' AS name, 0.0::double AS x WHERE false
        {scaled_rows(["previous_tickets", "hour_of_day", "day_of_week", "month", "resolution_time", "resolved"])}""",
    "linear_fit_ends": f"""WITH {TRAIN} SELECT 'svm' AS model, f AS fold, category AS label, true AS ended
        FROM (SELECT unnest(range(5)) AS f), (SELECT DISTINCT category FROM train)
        UNION ALL SELECT 'lr', 0, category, true FROM (SELECT DISTINCT category FROM train)""",
    "boosting_losses": "SELECT unnest(range(1, 301)) AS round, true AS not_raised",
    "projection_basis": """SELECT k, m, CASE WHEN k = m THEN 1.0::double ELSE 0.0 END AS product
        FROM (SELECT unnest(range(50)) AS k), (SELECT unnest(range(50)) AS m)""",
    "streaming_index": f"""WITH {STAGED} SELECT ticket_id, product, category, priority, 64 AS dim FROM staged
        WHERE ticket_id NOT IN (SELECT concat('V-', cast(vec_id AS string)) FROM embeddings)""",
}
