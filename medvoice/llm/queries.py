"""One query per operator over the given tables, and the SQL of those SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medvoice.llm.frames import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@query
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from medvoice.llm.line_dedup import drop_repeated_lines

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_repeated_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


ORACLES["op6_line_dedup"] = f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
l AS (SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS pos FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          '{UPPER}', '{LOWER}') AS key FROM l),
f AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10
      GROUP BY key HAVING min(doc_id) < max(doc_id)),
m AS (SELECT k.*, f.key IS NOT NULL AND doc_id > f.first AS gone FROM k LEFT JOIN f USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


@query
def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from medvoice.llm.window_dedup import drop_repeated_windows

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_repeated_windows(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


ORACLES["op9_substring_dedup"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
t AS (SELECT doc_id, unnest(ws) AS word, unnest(range(len(ws))) AS pos, len(ws) AS n FROM d),
k AS (SELECT doc_id, pos, n, string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY pos
        ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING) AS s FROM t),
g AS (SELECT doc_id, pos, count(*) OVER (PARTITION BY s) AS c FROM k WHERE pos + 35 <= n),
x AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + 35)) AS pos FROM g WHERE c > 1),
r AS (SELECT t.doc_id, count(x.pos) AS n_removed, string_agg(word, ' ' ORDER BY t.pos) FILTER (WHERE x.pos IS NULL) AS kept
      FROM t LEFT JOIN x ON t.doc_id = x.doc_id AND t.pos = x.pos GROUP BY t.doc_id)
SELECT d.doc_id, len(ws) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN r USING (doc_id)
"""


@query
def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from medvoice.llm.decontaminate import find_benchmark, is_contaminated

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_benchmark(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        is_contaminated().alias("contaminated"),
    )


ORACLES["op5_benchmark_decontamination"] = rf"""
WITH dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
bw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
bt AS (SELECT item_id, least(len(ws), 13) AS w, unnest(ws) AS word, unnest(range(len(ws))) AS pos, len(ws) AS n FROM bw),
bk AS (SELECT item_id, w, pos, n, string_agg(word, ' ') OVER (PARTITION BY item_id ORDER BY pos
         ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING) AS s FROM bt),
p AS (SELECT DISTINCT item_id, w, s FROM bk WHERE pos + w <= n),
dt AS (SELECT doc_id, unnest(ws) AS word, unnest(range(len(ws))) AS pos, len(ws) AS n FROM dw),
dk AS (SELECT doc_id, pos, n, string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY pos
         ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING) AS s FROM dt),
o AS (SELECT doc_id, pos, w, item_id FROM dk JOIN p USING (s) WHERE w = 13 AND pos + 13 <= n
      UNION ALL
      SELECT dk.doc_id, pos, w, item_id FROM dk JOIN p ON (dk.s || ' ') LIKE (p.s || ' %') WHERE w < 13 AND pos + w <= n),
h AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(pos, pos + w)) FROM o) GROUP BY 1),
i AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM o) GROUP BY 1)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM dw LEFT JOIN h USING (doc_id) LEFT JOIN i USING (doc_id)
"""


@query
def op8_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    from medvoice.llm.mixing import Mix

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return Mix(docs).taken().select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "source")


@query
def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from medvoice.llm.near_dedup import NearDuplicates

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return NearDuplicates(docs).documents().select(F.col("id").alias("doc_id"), "class_id", "class_size")


@query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from medvoice.llm.toxicity import fit, is_held_out, score

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    field = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs, field).select(
        "doc_id", is_held_out("doc_id").alias("held_out"), "score", "predicted", F.size("toxic_spans").alias("n_spans")
    )


@query
def op2_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from medvoice.llm.fingerprints import as_string, edited, fingerprint, similar, with_next

    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    marked = docs.withColumn("mark", F.xxhash64("text"))
    changed = with_next(
        marked, "doc_id", "mark", {"own": fingerprint(F.col("text"))}, ["text", "own"]
    ).withColumn("edited", edited(F.col("text"), F.col("next.text")))
    both = changed.withColumn("other", fingerprint(F.col("edited")))
    return both.select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        as_string(F.col("own")).alias("fingerprint"),
        as_string(F.col("other")).alias("edited_fingerprint"),
        similar(F.col("own"), F.col("other")).alias("near_edited"),
        similar(F.col("own"), F.col("next.own")).alias("near_next"),
    )


@query
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from medvoice.llm.secrets import find, fit_found

    def labelled(found: DataFrame) -> DataFrame:
        """Findings whose nature is plain: values given to a key-like name, and known harmless forms, ordinary words among them."""
        plain = (F.col("digits") == 0) & (F.col("covered") >= 0.75)
        secret = (F.col("key_word") == 1) & (F.col("assigned") == 1) & ((F.col("length") >= 20) | (F.col("digits") > 0)) & ~plain
        harmless = (
            plain
            | F.col("value").rlike(r"^[0-9.:\-/]+$")
            | F.col("value").rlike(r"@[a-z0-9.\-]+\.[a-z]+\.?$")
            | (F.col("path") == 1) & F.col("value").rlike("^(https?:|www|/)")
        )
        return found.withColumn("label", F.when(secret, 1.0).when(harmless, 0.0)).where("label IS NOT NULL")

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found, words = find(docs)
    return (
        fit_found(found, words, labelled)
        .judge(found)
        .select(
            F.col("id").alias("doc_id"), "at", "value", "probability", (F.col("probability") >= 0.5).alias("is_secret")
        )
    )


@query
def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from medvoice.llm.suffix_dedup import drop_repeated_strings

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return drop_repeated_strings(docs).select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from medvoice.llm.suffix_tree import Model, is_held_out

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scores = Model(docs, ~is_held_out("doc_id")).scores().withColumnRenamed("id", "doc_id")
    return scores.select(
        "doc_id", is_held_out("doc_id").alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


@query
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from medvoice.llm.filter_audit import audit

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return audit(docs, table(spark, sf_dir, "labels"))


ORACLES["op11_filter_audit"] = r"""
WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws, min(doc_id) OVER (PARTITION BY text) AS first FROM t),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
        (len(ws) < 100)::INT + 2 * (100 * len(list_distinct(ws)) < 80 * len(ws))::INT
        + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text))::INT
        + 8 * regexp_matches(text, '[#$%&*|]')::INT + 16 * (first < doc_id)::INT AS mask
      FROM w LEFT JOIN l USING (doc_id)),
c AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY ALL),
f(letter, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
o AS (SELECT concat(a.letter, b.letter, x.letter, d.letter, e.letter) AS filter_order, [a.bit, b.bit, x.bit, d.bit, e.bit] AS bits
      FROM f a, f b, f x, f d, f e WHERE a.bit | b.bit | x.bit | d.bit | e.bit = 31),
s AS (SELECT filter_order, CAST(step AS INT) AS step, bits[step] AS bit, list_sum(bits[1:step - 1]) AS earlier
      FROM o, range(1, 6) AS r(step)),
r AS (SELECT part, filter_order, step, bit,
        sum(n) FILTER (WHERE mask & (coalesce(earlier, 0)::INT | bit) = 0) AS kept,
        sum(n) FILTER (WHERE mask & coalesce(earlier, 0)::INT = 0 AND mask & bit > 0) AS removed,
        sum(n) FILTER (WHERE mask & coalesce(earlier, 0)::INT > 0 AND mask & bit > 0) AS redundant,
        sum(n) FILTER (WHERE mask = bit) AS unique_fails,
        sum(good) FILTER (WHERE mask & coalesce(earlier, 0)::INT = 0 AND mask & bit > 0) AS good_lost,
        sum(toxic) FILTER (WHERE mask & coalesce(earlier, 0)::INT = 0 AND mask & bit > 0) AS toxic_lost
      FROM c, s GROUP BY ALL)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
       coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
       coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       coalesce(sum(removed) OVER (PARTITION BY part, bit), 0)::BIGINT AS shapley
FROM r
"""


@query
def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from medvoice.llm.language import fit, is_held_out, predict

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit(docs)
    return predict(docs.select("doc_id", "text"), model).select(
        "doc_id", is_held_out("doc_id").alias("held_out"), "lang_pred", "score"
    )


@query
def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from medvoice.llm.fill_middle import fill_in_middle, with_restored

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return with_restored(fill_in_middle(docs)).select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2("restored", 256).alias("restored_sha256"),
    )


ORACLES["op13_fill_in_middle"] = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || doc_id) AS h,
             regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u FROM documents),
h AS (SELECT doc_id, text, u, len(u) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
        ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM d),
f AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
             WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
c AS (SELECT *, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:], '') AS s FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE text END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM c
"""
