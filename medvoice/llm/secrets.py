"""Secret scans: candidates by pattern, false positives removed by a random forest.

Candidates are, in one pass over a text: values of ``SHORT`` characters or more, up to white
space or a quote, behind a name that holds a key word and an assignment (a scheme such as
``Bearer`` may stand between), or behind ``Bearer`` alone; and unbroken strings of
``LENGTH`` or more of the characters keys are made of, without the name where they begin
with one and ``=`` or ``:``. A value behind another assignment is one where a key word is
among the three words before it. Key words are a parameter, by default of four languages.

Each is described by its length, the kinds of its characters and the changes between
kinds, the share of it that common words of the corpus cover, path and address marks, and
the words before and after it. A random forest trained on labelled findings gives the
probability of a secret.

DataFrame functions and Spark ML only; work rises in proportion to the candidates, however
many a text has. Candidates are found and described once, for the fit and for the scan. The
forest is fitted to at most ``SAMPLE`` labelled candidates of each class, those of least
hash; word counts, candidates and scores cover all texts. Null and empty texts have no
candidates. Equal rows have equal findings, once per row. Without labelled findings of both
classes every candidate gets the share of secrets among the labelled ones (1/2 if there are
none).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medvoice.llm.fingerprints import let
from medvoice.llm.frames import stored

SAMPLE = 20_000
LENGTH, SHORT = 16, 8
#: What may be a key: no white space, quotes, brackets or sentence marks inside.
KEY_CHAR = r"[A-Za-z0-9+/=_@:%~\-.]"
CONTEXT = 48
#: Words of four to twelve letters that at least this share of the documents holds.
DICTIONARY_SHARE = 0.002

# Words that often stand before a credential, in English, German, French and Spanish.
KEY_WORDS = (
    "access", "api", "apikey", "auth", "authorization", "bearer", "client", "credential", "key", "passphrase",
    "passwd", "password", "private", "pwd", "secret", "session", "signature", "token",
    "geheimnis", "kennwort", "passwort", "schlüssel", "zugang", "zugangsdaten",
    "clé", "identifiant", "jeton", "mdp", "motdepasse", "passe", "secrète",
    "clave", "contraseña", "credencial", "secreto", "llave",
)
# A value up to white space or a quote, without sentence marks at its end.
VALUE = rf"[^\s\"'`]{{{SHORT - 1},}}[^\s\"'`,;.!?:)\]}}>]"
# Marks a candidate in a text in which no such character is left.
MARK, OTHER = "\u0001", "\u0002"


def pattern(key_words: Sequence[str] = KEY_WORDS) -> str:
    """What is a candidate: groups 1, 3, 5 stand before one, groups 2, 4, 6, 7 are one."""
    word = rf"(?iu:{'|'.join(key_words)})"
    letter = r"[\p{L}0-9_.\-]"
    name = rf"(?<!{letter})(?:{letter}{{0,40}}?[0-9_.\-])?{word}(?:[0-9_.\-]{letter}{{0,40}})?"
    assign = r"[=:](?!//|[=:])"
    return "|".join(
        (
            rf"({name}[\"'`]?\s{{0,8}}{assign}\s{{0,8}}(?:(?i:bearer|basic|token)\s{{1,4}})?[\"'`]?|(?<!{letter})(?i:bearer)\s{{1,4}})({VALUE})",
            rf"((?<!{KEY_CHAR})[A-Za-z_][A-Za-z0-9_.\-]{{0,63}}{assign})({KEY_CHAR}{{{LENGTH},}}+)",
            rf"({assign}\s{{0,8}}[\"'`]?)(?!{KEY_CHAR}{{{LENGTH}}})({VALUE})",
            rf"(?<!{KEY_CHAR})({KEY_CHAR}{{{LENGTH},}}+)",
        )
    )


PATH_MARKS = ("://", "/usr/", "/home/", "www.", ".com", ".org", ".html", ".py", ".js")

FEATURES = (
    "length", "digits", "uppers", "lowers", "marks", "different", "changes", "repeats", "hexadecimal",
    "covered", "longest_letters", "path", "address", "key_word", "assigned", "quoted", "words_before", "words_after",
)


def _key_word(before: Column, key_words: Sequence[str] = KEY_WORDS) -> Column:
    """Whether one of the last three words is a key word."""
    words = F.regexp_extract_all(F.lower(before), F.lit(r"\p{L}+"), F.lit(0))
    last = F.array_join(let(words, lambda w: F.slice(w, F.greatest(F.size(w) - 2, F.lit(1)), 3)), " ")
    return F.concat(F.lit(" "), last, F.lit(" ")).rlike(" (?:" + "|".join(key_words) + ") ")


def candidates(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", key_words: Sequence[str] = KEY_WORDS
) -> DataFrame:
    """``(id, text_hash, at, value, before, after)``: every candidate of every text, with its surroundings.

    ``at`` is its place among the characters, from 0.
    """
    named = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).withColumn(
        "row", F.monotonically_increasing_id()
    )
    # One pass of the pattern puts marks around candidates; they stand at the odd places then.
    marked = F.regexp_replace(F.translate("text", MARK, OTHER), pattern(key_words), f"$1$3$5{MARK}$2$4$6$7{MARK}")
    parts = (
        named.select("id", "row", F.xxhash64("text").alias("text_hash"), F.split(marked, MARK).alias("parts"))
        .where(F.size("parts") > 1)
        .withColumn("candidates", ((F.size("parts") - 1) / 2).cast("int"))
    )
    part = lambda i: F.get("parts", i)
    rows = parts.select(
        "id",
        "row",
        "text_hash",
        F.inline(
            F.transform(
                F.sequence(F.lit(0), F.col("candidates") - 1),
                lambda i: F.struct(
                    i.alias("n"),
                    part(2 * i + 1).alias("value"),
                    F.char_length(part(2 * i)).alias("gap"),
                    F.right(part(2 * i), F.lit(CONTEXT)).alias("before"),
                    F.left(part(2 * i + 2), F.lit(CONTEXT)).alias("after"),
                ),
            )
        ),
    )
    # Where a candidate begins is a running sum over those of its text.
    own = Window.partitionBy("row").orderBy("n")
    upto = F.sum(F.col("gap") + F.char_length("value")).over(own)
    return rows.withColumn("at", (upto - F.char_length("value")).cast("int")).where(
        (F.char_length("value") >= LENGTH) | _key_word(F.col("before"), key_words) | F.col("before").rlike(named_value(key_words))
    ).select("id", "text_hash", "at", "value", "before", "after")


def named_value(key_words: Sequence[str] = KEY_WORDS) -> str:
    """A name that holds a key word, and an assignment, at the end."""
    return rf"(?iu)(?:^|[^\p{{L}}])(?:{'|'.join(key_words)})(?:[0-9_.\-][\p{{L}}0-9_.\-]{{0,40}})?[\"'`]?\s*[=:]\s*(?:(?:bearer|basic|token)\s+)?[\"'`]?$"


def dictionary(docs: DataFrame, text: str = "text") -> list[str]:
    """Words of four to twelve letters that at least ``DICTIONARY_SHARE`` of the documents hold.

    The share bounds their number: by what a document holds, over the share.
    """
    words = F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(r"\b[a-z]{4,12}\b"), F.lit(0)))
    n = docs.count()
    rows = (
        docs.select(F.explode(words).alias("word"))
        .groupBy("word")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= DICTIONARY_SHARE * n)
        .select("word")
        .collect()
    )
    return sorted(r["word"] for r in rows)


def described(found: DataFrame, words: list[str], key_words: Sequence[str] = KEY_WORDS) -> DataFrame:
    """The candidates with the values of ``FEATURES``."""
    value, n = F.col("value"), F.char_length("value").cast("double")

    def share(pattern: str) -> Column:
        return F.regexp_count(value, F.lit(pattern)) / n

    kinds = F.translate(
        F.regexp_replace(value, "[^A-Za-z0-9]", "-"),
        "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
        "A" * 26 + "a" * 26 + "0" * 10,
    )
    before, after = F.lower(F.col("before")), F.lower(F.col("after"))
    letters = F.array_distinct(F.regexp_extract_all(F.lower(value), F.lit("[a-z]{4,}"), F.lit(0)))
    covered = F.aggregate(
        F.filter(letters, lambda w: w.isin(*words) if words else F.lit(False)), F.lit(0), lambda s, w: s + F.char_length(w)
    )
    return found.select(
        "*",
        n.alias("length"),
        share("[0-9]").alias("digits"),
        share("[A-Z]").alias("uppers"),
        share("[a-z]").alias("lowers"),
        share("[^A-Za-z0-9]").alias("marks"),
        (F.size(F.array_distinct(F.split(value, ""))) / n).alias("different"),
        (F.regexp_count(kinds, F.lit("(?=A[a0\\-]|a[A0\\-]|0[Aa\\-]|\\-[Aa0])")) / n).alias("changes"),
        (F.regexp_count(value, F.lit(r"(.)(?=\1)")) / n).alias("repeats"),
        value.rlike("^[0-9a-fA-F]+$").cast("double").alias("hexadecimal"),
        (covered / n).alias("covered"),
        F.coalesce(F.array_max(F.transform(letters, lambda w: F.char_length(w))), F.lit(0)).cast("double").alias("longest_letters"),
        (value.rlike("[/.].*[/.]")).cast("double").alias("path"),
        let(F.lower(value), lambda v: sum((v.contains(m).cast("double") for m in PATH_MARKS), F.lit(0.0)) + v.contains("@").cast("double")).alias("address"),
        (_key_word(F.col("before"), key_words) | F.col("before").rlike(named_value(key_words))).cast("double").alias("key_word"),
        before.rlike("(?:[=:]\\s*(?:(?:bearer|basic|token)\\s+)?|bearer\\s+)[\"'`]?$").cast("double").alias("assigned"),
        (before.rlike("[\"'`]$") & after.rlike("^[\"'`]")).cast("double").alias("quoted"),
        F.regexp_count(before, F.lit("[a-z]+")).cast("double").alias("words_before"),
        F.regexp_count(after, F.lit("[a-z]+")).cast("double").alias("words_after"),
    )


class SecretModel:
    """A fitted forest, or a constant where there was nothing to tell apart."""

    def __init__(
        self, model: PipelineModel | None, words: list[str], share: float, key_words: Sequence[str] = KEY_WORDS
    ):
        self.model, self.words, self.share, self.key_words = model, words, share, key_words

    def scan(self, docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
        """All candidates of a table with ``probability``; from 1/2 on they are findings."""
        return self.judge(described(candidates(docs, text, doc_id, self.key_words), self.words, self.key_words))

    def judge(self, found: DataFrame) -> DataFrame:
        """Described candidates with ``probability``."""
        if self.model is None:
            return found.withColumn("probability", F.lit(self.share))
        return self.model.transform(found).withColumn("probability", F.get(vector_to_array("forest_probability"), F.lit(1)))


def find(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", key_words: Sequence[str] = KEY_WORDS
) -> tuple[DataFrame, list[str]]:
    """All candidates of a table, described and stored once; and the words they are described with."""
    words = dictionary(docs, text)
    return stored(described(candidates(docs, text, doc_id, key_words), words, key_words), "candidates"), words


def fit(
    docs: DataFrame,
    labelled: Callable[[DataFrame], DataFrame],
    text: str = "text",
    doc_id: str = "doc_id",
    **settings: object,
) -> SecretModel:
    """Forest fitted to labelled findings of a table; see :func:`fit_found`."""
    found, words = find(docs, text, doc_id)
    return fit_found(found, words, labelled, **settings)


def fit_found(
    found: DataFrame,
    words: list[str],
    labelled: Callable[[DataFrame], DataFrame],
    sample: int = SAMPLE,
    trees: int = 24,
    depth: int = 6,
    seed: int = 11,
    key_words: Sequence[str] = KEY_WORDS,
) -> SecretModel:
    """Forest fitted to labelled findings among candidates that :func:`find` has stored.

    ``labelled`` takes described candidates and returns those whose label is known,
    with ``label`` 1.0 for a secret.
    """
    known = labelled(found)
    least = known.withColumn("_order", F.xxhash64("id", "text_hash", "at"))
    columns = [*FEATURES, "label"]
    rows = [
        least.where(F.col("label") == v).orderBy("_order", "id", "at").select(*columns).limit(sample) for v in (0.0, 1.0)
    ]
    picked = rows[0].unionByName(rows[1]).persist()
    counts = {r["label"]: r["count"] for r in picked.groupBy("label").count().collect()}
    if len(counts) < 2:
        picked.unpersist()
        share = next(iter(counts), 0.5)
        return SecretModel(None, words, float(share), key_words)
    forest = RandomForestClassifier(
        labelCol="label", featuresCol="features", numTrees=trees, maxDepth=depth, seed=seed,
        rawPredictionCol="forest_raw", probabilityCol="forest_probability", predictionCol="forest_prediction",
    )
    ordered = picked.repartition(1).sortWithinPartitions(*columns)
    model = Pipeline(stages=[VectorAssembler(inputCols=list(FEATURES), outputCol="features"), forest]).fit(ordered)
    picked.unpersist()
    return SecretModel(model, words, 0.5, key_words)
