"""The same results in SQL, run by another engine over the same tables."""

from __future__ import annotations

from medvoice.functions.lexicon import LEXICON, NEGATION_FACTOR, NEGATORS, STOPWORDS
from medvoice.functions.text import TOKEN_PATTERN

RN = """
rn AS (
  SELECT l_orderkey*8 + l_linenumber AS UniqueID, p_brand AS drugName,
         CASE WHEN l_partkey % 29 = 0 THEN NULL
              WHEN l_partkey % 31 = 0 THEN '3</span> users found this comment helpful.'
              ELSE p_type END AS condition,
         CASE WHEN l_suppkey % 37 = 0 THEN NULL
              ELSE CAST(1 + CAST(FLOOR(l_discount*60) AS INT) + CAST(l_quantity AS INT) % 4
                        AS DOUBLE) END AS rating,
         CAST(l_orderkey % 200 AS INT) AS usefulCount,
         l_discount*20 - 1 AS sentiment, l_shipdate AS review_ts
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""

CLEAN = (
    RN
    + """,
clean AS (
  SELECT * FROM rn
  WHERE condition IS NOT NULL AND rating IS NOT NULL AND NOT contains(condition, '</span>'))"""
)

RT = """
rt AS (
  SELECT doc_id AS UniqueID, source AS drugName,
         CASE WHEN doc_id % 29 = 0 THEN NULL
              WHEN doc_id % 31 = 0 THEN '3</span> users found this comment helpful.'
              ELSE lang END AS condition,
         text AS review, CAST(1 + n_chars % 10 AS DOUBLE) AS rating,
         printf('%02d-%02d-2022', 1 + doc_id % 12, 1 + doc_id % 28) AS date,
         CAST(n_chars % 200 AS INT) AS usefulCount
  FROM documents)"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_WORDS = f"regexp_extract_all(lower(review), {_quoted(TOKEN_PATTERN)})"
_STOP = "(" + ", ".join(_quoted(w) for w in STOPWORDS) + ")"
_LEXICON = ", ".join(f"({_quoted(w)}, CAST({p} AS DOUBLE))" for w, p in LEXICON.items())
_NEGATED = (
    "(prev IN (" + ", ".join(_quoted(w) for w in NEGATORS) + ") OR ends_with(prev, 'n''t'))"
)

# Tokens of rt with the token before each.
TOKENS = (
    RT
    + f""",
lists AS (SELECT UniqueID, {_WORDS} AS ws FROM rt),
toks AS (
  SELECT UniqueID, unnest(ws) AS word,
         unnest(list_concat([CAST(NULL AS VARCHAR)], ws[1:len(ws)-1])) AS prev
  FROM lists WHERE len(ws) > 0)"""
)

POLARITY = (
    TOKENS
    + f""",
lex(word, polarity) AS (VALUES {_LEXICON}),
scores AS (
  SELECT UniqueID,
         AVG(polarity * CASE WHEN prev IS NOT NULL AND {_NEGATED}
                             THEN CAST({NEGATION_FACTOR} AS DOUBLE) ELSE 1.0 END) AS s
  FROM toks JOIN lex USING (word) GROUP BY UniqueID),
scored AS (
  SELECT rt.*, COALESCE(s, CAST(0 AS DOUBLE)) AS sentiment
  FROM rt LEFT JOIN scores ON rt.UniqueID = scores.UniqueID)"""
)

_CLEAN_TEXT = (
    "condition IS NOT NULL AND review IS NOT NULL AND NOT contains(condition, '</span>')"
)
_INT_ID = "UniqueID"


def _term_frequency(label_condition: str) -> str:
    return f"""WITH {RT},
toks AS (SELECT unnest({_WORDS}) AS term FROM rt WHERE {label_condition})
SELECT term, COUNT(*) AS n FROM toks WHERE term NOT IN {_STOP}
GROUP BY term ORDER BY n DESC, term LIMIT 1000"""


def _sides(columns: str) -> str:
    """Cleaned rows by side of the split."""
    return f"""WITH {CLEAN}, s AS (
SELECT CASE WHEN CAST('0x' || substr(md5(CAST(UniqueID AS VARCHAR) || ':42'), 1, 8) AS BIGINT)
            / 4294967296.0 < 0.25 THEN 'holdout' ELSE 'train' END AS split FROM clean)
SELECT {columns} FROM s GROUP BY split"""


def _summary(source: str, column: str, quantile: str, digits: int) -> str:
    quantiles = ", ".join(
        f"ROUND({quantile.format(q=q, x=column)}, {digits}) AS q{round(q * 100)}"
        for q in (0.25, 0.5, 0.75)
    )
    return f"""SELECT COUNT({column}) AS count, ROUND(AVG({column}), {digits}) AS mean,
ROUND(STDDEV_SAMP({column}), {digits}) AS stddev, ROUND(MIN({column}), {digits}) AS min,
{quantiles}, ROUND(MAX({column}), {digits}) AS max FROM {source}"""


def _cloud(view: str, name: str, column: str) -> str:
    words = f"regexp_extract_all(lower({column}), {_quoted(TOKEN_PATTERN)})"

    def part(k: str, n: str, p: str) -> str:
        return f"(ln(greatest({p}, 1e-10))*({k}) + ln(greatest(1-({p}), 1e-10))*(({n})-({k})))"

    p, p1, p2 = "c2/total", "c12/c1", "(c2-c12)/(total-c1)"
    score = (
        f"-2*({part('c12', 'c1', p)} + {part('c2-c12', 'total-c1', p)}"
        f" - {part('c12', 'c1', p1)} - {part('c2-c12', 'total-c1', p2)})"
    )
    plural = "ends_with({w}, 's') AND NOT ends_with({w}, 'ss')"
    return f"""WITH {view},
raw AS (SELECT list_filter(list_transform({words},
          lambda t: CASE WHEN ends_with(t, '''s') THEN t[1:length(t)-2] ELSE t END),
          lambda t: NOT regexp_full_match(t, '\\p{{Nd}}+')) AS ws FROM {name}),
seq AS (SELECT unnest(ws) AS w1,
          unnest(list_concat(ws[2:], [CAST(NULL AS VARCHAR)])) AS w2 FROM raw WHERE len(ws) > 0),
singles AS (SELECT w1 AS term, COUNT(*) AS n FROM seq WHERE w1 NOT IN {_STOP} GROUP BY w1),
phrases AS (SELECT w1, w2, COUNT(*) AS n FROM seq
            WHERE w1 NOT IN {_STOP} AND w2 IS NOT NULL AND w2 NOT IN {_STOP} GROUP BY w1, w2),
tot AS (SELECT CAST(SUM(n) AS DOUBLE) AS total FROM singles),
forms AS (SELECT a.term, COALESCE(b.term, a.term) AS form, a.n FROM singles a
          LEFT JOIN singles b ON {plural.format(w='a.term')} AND b.term = a.term[1:length(a.term)-1]),
words AS (SELECT form, SUM(n) AS n FROM forms GROUP BY form),
known AS (SELECT term, forms.form, words.n FROM forms JOIN words ON forms.form = words.form),
merged AS (SELECT a.w1, COALESCE(b.w2, a.w2) AS w2, SUM(a.n) AS n FROM phrases a
           LEFT JOIN phrases b ON a.w1 = b.w1 AND {plural.format(w='a.w2')}
                AND b.w2 = a.w2[1:length(a.w2)-1]
           GROUP BY 1, 2),
measured AS (SELECT m.w1, m.w2, f.form AS f1, s.form AS f2, m.n AS n,
               CAST(m.n AS DOUBLE) AS c12, CAST(f.n AS DOUBLE) AS c1, CAST(s.n AS DOUBLE) AS c2, total
             FROM merged m JOIN known f ON f.term = m.w1 JOIN known s ON s.term = m.w2, tot),
found AS (SELECT * FROM measured WHERE total > c1 AND total > c2 AND {score} > 30),
changes AS (
  SELECT form AS term, n FROM words
  UNION ALL SELECT f1, -n FROM found
  UNION ALL SELECT f2, -n FROM found
  UNION ALL SELECT w1 || ' ' || w2, n FROM found)
SELECT term, CAST(SUM(n) AS BIGINT) AS n FROM changes GROUP BY term HAVING SUM(n) > 0
ORDER BY n DESC, term LIMIT 1000"""


def _top_drugs(bound: str, values: tuple[int, ...]) -> str:
    counts = ", ".join(f"COUNT(*) FILTER (WHERE rating = {v}) AS r{v}" for v in values)
    return f"""WITH {RN} SELECT drugName, {counts} FROM rn
WHERE condition = 'ECONOMY' AND {bound} AND usefulCount >= 100 GROUP BY drugName"""


_LANDED = f"""WITH {POLARITY}
SELECT review, {_INT_ID}, drugName, condition, date, usefulCount,
ROUND(sentiment, 9) AS sentiment, TRUE AS month_dir_ok FROM scored
WHERE condition IS NOT NULL AND review IS NOT NULL"""
_SCORED_AUDIT = f"""WITH {RT}
SELECT drugName, COUNT(*) AS n, CAST(SUM(UniqueID) AS BIGINT) AS id_sum, COUNT(*) AS n_on_scale
FROM rt WHERE condition IS NOT NULL AND review IS NOT NULL GROUP BY drugName"""

_LABELS = f"""WITH {TOKENS},
d AS (SELECT UniqueID, CASE WHEN rating >= 5 THEN 1 ELSE 0 END AS y FROM rt WHERE review IS NOT NULL),
c AS (SELECT word, COUNT(*) FILTER (WHERE y = 1) AS p, COUNT(*) FILTER (WHERE y = 0) AS n
      FROM toks JOIN d USING (UniqueID) GROUP BY word),
a AS (SELECT COUNT(*) AS v, SUM(p) AS p, SUM(n) AS n FROM c),
w AS (SELECT word, ln((c.p + 1) / CAST(a.p + v AS DOUBLE)) - ln((c.n + 1) / CAST(a.n + v AS DOUBLE)) AS weight FROM c, a),
prior AS (SELECT ln(COUNT(*) FILTER (WHERE y = 1) + 1) - ln(COUNT(*) FILTER (WHERE y = 0) + 1) AS base FROM d),
s AS (SELECT UniqueID, SUM(weight) AS score FROM toks JOIN w USING (word) GROUP BY UniqueID)
SELECT d.UniqueID, CASE WHEN ROUND(COALESCE(score, 0) + base, 9) > 0 THEN 'positive' ELSE 'negative' END AS sentiment
FROM d LEFT JOIN s USING (UniqueID), prior"""
_LABEL_AUDIT = f"""WITH {RT}
SELECT UniqueID, CAST(1 AS BIGINT) AS n_allowed, CAST(1 AS BIGINT) AS n FROM rt WHERE review IS NOT NULL"""

ORACLES: dict[str, str] = {
    "clean_reviews": f"WITH {CLEAN} SELECT * FROM clean",
    "stage_counts": f"""WITH {CLEAN}
SELECT 'raw' AS stage, COUNT(*) AS n FROM rn
UNION ALL SELECT 'no_nulls', COUNT(*) FROM rn WHERE condition IS NOT NULL AND rating IS NOT NULL
UNION ALL SELECT 'clean', COUNT(*) FROM clean""",
    "rating_histogram": f"WITH {CLEAN} SELECT rating, COUNT(*) AS n FROM clean GROUP BY rating",
    "rating_histogram_raw": f"WITH {RN} SELECT rating, COUNT(*) AS n FROM rn GROUP BY rating",
    "avg_rating_by_condition": f"""WITH {CLEAN}
SELECT condition, AVG(rating) AS avg_rating, COUNT(condition) AS n FROM clean GROUP BY condition""",
    "avg_rating_by_drug": f"""WITH {CLEAN}
SELECT drugName, AVG(rating) AS avg_rating, COUNT(drugName) AS n FROM clean GROUP BY drugName""",
    "rating_percent": f"""WITH {RN}
SELECT rating, ROUND(100.0*COUNT(*)/CAST((SELECT COUNT(*) FROM rn) AS DOUBLE), 9) AS percent
FROM rn WHERE rating IS NOT NULL GROUP BY rating""",
    "condition_value_counts": f"""WITH {RN}
SELECT condition, COUNT(*) AS n FROM rn WHERE condition IS NOT NULL GROUP BY condition""",
    "top_conditions": f"""WITH {RN}
SELECT condition, COUNT(*) AS n FROM rn WHERE condition IS NOT NULL
GROUP BY condition ORDER BY n DESC, condition LIMIT 5""",
    "top_drugs_gt": _top_drugs("rating > 7.0", (8, 9, 10)),
    "top_drugs_ge": _top_drugs("rating >= 9.0", (9, 10)),
    "drug_rating_crosstab": f"""WITH {RN}
SELECT drugName, {", ".join(f"COUNT(*) FILTER (WHERE rating = {v}) AS r{v}" for v in range(1, 11))}
FROM rn WHERE rating IS NOT NULL GROUP BY drugName""",
    "drug_rating_pairs": f"""WITH {RN}
SELECT drugName, rating, COUNT(*) AS n FROM rn WHERE rating IS NOT NULL GROUP BY drugName, rating""",
    "sentiment_summary": f"WITH {RN} "
    + _summary("rn", "sentiment", "percentile_disc({q}) WITHIN GROUP (ORDER BY {x})", 9),
    "sentiment_describe": f"WITH {RN} "
    + _summary("rn", "sentiment", "quantile_cont({x}, {q})", 9),
    "price_describe": _summary("lineitem", "l_extendedprice", "quantile_cont({x}, {q})", 4),
    "rmse_by_drug": f"""WITH {RN}
SELECT drugName, ROUND(SQRT(AVG((rating-5.5)*(rating-5.5))), 9) AS rmse
FROM rn WHERE rating IS NOT NULL GROUP BY drugName""",
    "rmse_rounded": f"""WITH {CLEAN}, d AS (
SELECT rating - round_even(5.5 + 4.5*sentiment, 0) AS e FROM clean)
SELECT ROUND(SQRT(AVG(e*e)), 9) AS rmse FROM d""",
    "project_features": f"WITH {RN} SELECT usefulCount, sentiment FROM rn",
    "drop_columns": f"""WITH {RN}
SELECT UniqueID, drugName, condition, rating, usefulCount, sentiment FROM rn""",
    "rename_review": f"""WITH {RT}
SELECT UniqueID, drugName, condition, review AS text, rating, date, usefulCount FROM rt""",
    "to_numeric_cols": f"""WITH {RN}
SELECT UniqueID, CAST(CAST(rating AS VARCHAR) AS DOUBLE) AS rating,
CAST(usefulCount AS DOUBLE) AS usefulCount, TRY_CAST(condition AS DOUBLE) AS condition FROM rn""",
    "review_sent": f"""WITH {RN}
SELECT UniqueID, rating,
CAST(CASE WHEN rating >= 5 THEN 1 WHEN rating < 5 THEN 0 END AS DOUBLE) AS review_sent FROM rn""",
    "rint_col": f"WITH {RN} SELECT UniqueID, round_even(sentiment*5, 0) AS rounded FROM rn",
    "month_dir_counts": """
SELECT CAST(month(ts) AS VARCHAR) || '-' || CAST(year(ts) AS VARCHAR) AS month_dir, COUNT(*) AS n
FROM events GROUP BY 1""",
    "latest_reviews": f"""WITH {RN}
SELECT review_ts, UniqueID, usefulCount, rating FROM rn
ORDER BY review_ts DESC, UniqueID, usefulCount, rating NULLS LAST LIMIT 20""",
    "sample_n": f"""WITH {RT}
SELECT UniqueID, drugName, rating FROM rt
ORDER BY md5(CAST(UniqueID AS VARCHAR) || ':1'), UniqueID LIMIT 100""",
    "holdout_split": f"""WITH {RN}, h AS (
SELECT UniqueID,
  CAST('0x' || substr(md5(CAST(UniqueID AS VARCHAR) || ':42'), 1, 8) AS BIGINT)/4294967296.0 < 0.25
  AS holdout FROM rn)
SELECT holdout, COUNT(*) AS n, CAST(SUM(UniqueID) AS BIGINT) AS id_sum FROM h GROUP BY holdout""",
    "union_batches": f"""WITH {RN}, {RT}
SELECT UniqueID, drugName, rating, sentiment, CAST(NULL AS VARCHAR) AS review FROM rn
UNION ALL SELECT UniqueID, drugName, rating, CAST(NULL AS DOUBLE), review FROM rt""",
    "tsv_round_trip": f"""WITH {RT}
SELECT {_INT_ID}, drugName, condition, review, rating, date, usefulCount FROM rt""",
    "tsv_split_round_trip": f"""WITH {RT}
SELECT {_INT_ID}, drugName, condition, review, rating, date, usefulCount FROM rt""",
    "text_typed_round_trip": f"""WITH {RT}
SELECT CAST(UniqueID AS DOUBLE) AS UniqueID, drugName, condition, review, rating, date,
CAST(usefulCount AS DOUBLE) AS usefulCount FROM rt""",
    "scored_csv_round_trip": f"""WITH {POLARITY}
SELECT {_INT_ID}, drugName, condition, review, rating, date, usefulCount,
ROUND(sentiment, 9) AS sentiment FROM scored""",
    "predictions_by_run": f"""WITH {RN}
SELECT run_ts, COUNT(*) AS n, CAST(SUM(UniqueID) AS BIGINT) AS id_sum
FROM rn CROSS JOIN (VALUES ('first'), ('second')) AS runs(run_ts) GROUP BY run_ts""",
    "term_frequency": f"""WITH {RT}, toks AS (SELECT unnest({_WORDS}) AS term FROM rt)
SELECT term, COUNT(*) AS n FROM toks GROUP BY term""",
    "term_freq_negative": _term_frequency("rating < 5"),
    "term_freq_positive": _term_frequency("rating >= 5"),
    "drug_name_terms": f"""WITH {RN},
toks AS (SELECT unnest(regexp_extract_all(lower(drugName), {_quoted(TOKEN_PATTERN)})) AS term FROM rn)
SELECT term, COUNT(*) AS n FROM toks WHERE term NOT IN {_STOP} GROUP BY term""",
    "review_cloud": _cloud(RT, "rt", "review"),
    "negative_cloud": _cloud(RT, "rt WHERE rating < 5", "review"),
    "positive_cloud": _cloud(RT, "rt WHERE rating >= 5", "review"),
    "drug_name_cloud": _cloud(RN, "rn", "drugName"),
    "benchmark_cloud": _cloud(
        "bt AS (SELECT text FROM benchmark UNION ALL SELECT text FROM benchmark)", "bt", "text"
    ),
    "review_polarity": f"WITH {POLARITY} SELECT UniqueID, ROUND(sentiment, 9) AS sentiment FROM scored",
    "review_polarity_large_lexicon": f"""WITH {TOKENS},
scores AS (
  SELECT UniqueID, AVG((length(word) % 5 - 2) / 2.0
         * CASE WHEN prev IS NOT NULL AND {_NEGATED} THEN -0.5 ELSE 1.0 END) AS s
  FROM toks GROUP BY UniqueID)
SELECT rt.UniqueID, ROUND(COALESCE(CAST(s AS DOUBLE), 0), 9) AS sentiment
FROM rt LEFT JOIN scores ON rt.UniqueID = scores.UniqueID""",
    "extract_scored": f"""WITH {POLARITY}
SELECT UniqueID, drugName, condition, review, rating, date, usefulCount,
ROUND(sentiment, 9) AS sentiment FROM scored WHERE {_CLEAN_TEXT}""",
    "explode_labels": """
SELECT doc_id, unnest([CASE WHEN quality = 1 THEN 'positive' ELSE 'negative' END,
                       CASE WHEN toxic = 0 THEN 'positive' ELSE 'negative' END]) AS sentiment
FROM labels""",
    "assemble_features": f"""WITH {RN}
SELECT UniqueID, CAST(usefulCount AS DOUBLE) AS useful_count, sentiment FROM rn""",
    "index_condition": f"""WITH {RN}, c AS (
SELECT condition, COUNT(*) AS n FROM rn WHERE condition IS NOT NULL GROUP BY condition)
SELECT condition, CAST(ROW_NUMBER() OVER (ORDER BY n DESC, condition) - 1 AS DOUBLE)
AS condition_idx, n FROM c""",
    "index_parts_by_rank": """WITH c AS (
SELECT 'part ' || CAST(l_partkey AS VARCHAR) AS label, COUNT(*) AS n FROM lineitem GROUP BY 1)
SELECT label, CAST(ROW_NUMBER() OVER (ORDER BY n DESC, label) - 1 AS DOUBLE) AS label_idx, n
FROM c""",
    "condition_index_stage": """WITH c AS (
SELECT l_partkey AS k, COUNT(*) AS n FROM lineitem GROUP BY 1),
r AS (SELECT CAST(ROW_NUMBER() OVER (ORDER BY n DESC, 'part ' || CAST(k AS VARCHAR)) - 1 AS DOUBLE) AS label_idx, n FROM c)
SELECT label_idx, n FROM r UNION ALL
SELECT CAST((SELECT COUNT(*) FROM c) AS DOUBLE), COUNT(*) FROM orders""",
    "rating_model_collapsed": _sides("split, COUNT(*) AS n, TRUE AS as_good"),
    "decode_event_bodies": """
SELECT event_id, CAST(json_extract_string(decode(from_base64(base64(encode(props)))), '$.k') AS BIGINT)
AS k FROM events""",
    "decode_messages": f"""WITH {RT}
SELECT {_INT_ID}, drugName, condition, review, rating, date, usefulCount,
condition IS NOT NULL AND review IS NOT NULL AS usable FROM rt""",
    "stream_events_landed": """
SELECT event_id, user_id, event_type, value,
CAST(month(ts) AS VARCHAR) || '-' || CAST(year(ts) AS VARCHAR) AS month_dir FROM events""",
    "stream_month_land": _LANDED,
    "stream_manifest_landed": _LANDED,
    "stream_rejects": f"""WITH {RT}
SELECT {_INT_ID}, drugName, condition FROM rt WHERE condition IS NULL OR review IS NULL""",
    "stream_score_audit": _SCORED_AUDIT,
    "stream_manifest_scored": _SCORED_AUDIT,
    "top_drugs_half_ratings": f"""WITH {RN}, h AS (
SELECT drugName, condition, usefulCount, rating - (UniqueID % 2) * 0.5 AS rating FROM rn)
SELECT drugName, {", ".join(f"COUNT(*) FILTER (WHERE rating = {v}) AS {c}"
    for v, c in ((8.5, "r8_5"), (9, "r9"), (9.5, "r9_5"), (10, "r10")))}
FROM h WHERE condition = 'ECONOMY' AND rating > 8.0 AND usefulCount >= 100 GROUP BY drugName""",
    "rating_model_audit": _sides("split, COUNT(*) AS n, TRUE AS better"),
    "rating_model_three_features": _sides(
        "split, COUNT(*) AS n, TRUE AS better, CAST(3 AS INTEGER) AS features"
    ),
    "model_reload_audit": f"""SELECT n, n AS n_equal FROM ({_sides("split, COUNT(*) AS n")})
WHERE split = 'holdout'""",
    "label_sentiment": _LABELS,
    "label_sentiment_audit": _LABEL_AUDIT,
    "label_sentiment_hashed": _LABEL_AUDIT,
    "observed_counts": f"""WITH {RT}
SELECT 'raw' AS stage, COUNT(*) AS n FROM rt
UNION ALL SELECT 'no_nulls', COUNT(*) FROM rt WHERE condition IS NOT NULL AND review IS NOT NULL
UNION ALL SELECT stage, COUNT(*) FROM rt, (VALUES ('clean'), ('written')) AS v(stage) WHERE {_CLEAN_TEXT} GROUP BY stage""",
    "top_parts": """SELECT l_partkey, COUNT(*) AS n FROM lineitem GROUP BY l_partkey
ORDER BY n DESC, l_partkey LIMIT 50""",
    "top_parts_by_few": """SELECT CASE WHEN l_partkey % 3 = 0 THEN l_partkey % 20 ELSE l_orderkey + 1000 END AS item,
COUNT(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, item LIMIT 10""",
    "sentiment_summary_by_month": f"""WITH {RN}
SELECT CAST(month(review_ts) AS INTEGER) AS month, COUNT(sentiment) AS count, ROUND(AVG(sentiment), 9) AS mean,
ROUND(STDDEV_SAMP(sentiment), 9) AS stddev, ROUND(MIN(sentiment), 9) AS min, ROUND(MAX(sentiment), 9) AS max,
TRUE AS q25_near, TRUE AS q50_near, TRUE AS q75_near FROM rn GROUP BY 1""",
    "sample_large": """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
ORDER BY md5(CAST(l_orderkey AS VARCHAR) || ':' || CAST(l_linenumber AS VARCHAR) || ':1'), l_orderkey, l_linenumber
LIMIT (SELECT COUNT(*) // 2 FROM lineitem)""",
    "polarity_sql": f"WITH {POLARITY} SELECT UniqueID, ROUND(sentiment, 9) AS sentiment FROM scored",
    "archive_audit": f"""WITH {RT}
SELECT 'archived' AS folder, COUNT(*) AS n, CAST(SUM(UniqueID) AS BIGINT) AS id_sum
FROM rt WHERE condition IS NOT NULL AND review IS NOT NULL""",
    "run_stamps": f"WITH {RN} SELECT drugName, COUNT(*) AS n, TRUE AS same FROM rn GROUP BY drugName",
    "rating_bands": f"""WITH {RN}
SELECT CASE WHEN rating <= 4 THEN 'low' WHEN rating <= 7 THEN 'middle' ELSE 'high' END AS band, COUNT(*) AS n
FROM rn WHERE rating IS NOT NULL GROUP BY 1""",
    "polarity_duplicate_keys": f"WITH {POLARITY} SELECT UniqueID AS doc, ROUND(sentiment, 9) AS sentiment FROM scored",
    "long_ids_landed": f"""WITH {RT}
SELECT UniqueID + 3000000000 AS UniqueID, drugName FROM rt WHERE condition IS NOT NULL AND review IS NOT NULL""",
    "stream_two_sources": f"""WITH {RT}
SELECT drugName, COUNT(*) AS n, CAST(SUM(UniqueID) AS BIGINT) AS id_sum
FROM rt WHERE condition IS NOT NULL AND review IS NOT NULL GROUP BY drugName""",
    "landed_index_round_trip": f"""WITH {POLARITY}
SELECT review, {_INT_ID}, drugName, condition, date, usefulCount,
ROUND(sentiment, 9) AS sentiment FROM scored WHERE condition IS NOT NULL""",
}
