"""The registered queries: every operator over the given tables.

Each takes ``(spark, sf_dir)`` and returns a DataFrame. They read whole tables
and whole texts. Floating point results whose last bits depend on the order of
addition are rounded here, not in the operators.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medvoice.functions import columns as C
from medvoice.functions.lexicon import LEXICON, STOPWORDS
from medvoice.functions.sql import register_polarity
from medvoice.operators import classifier, profiling, rating_model, sketches, terms
from medvoice.operators.cleaning import clean_reviews, stage_counts
from medvoice.operators.label_index import LabelIndex
from medvoice.operators.polarity import polarity_by_join, score_reviews
from medvoice.operators.quantiles import describe
from medvoice.operators.sampling import sample_large, sample_n, with_split
from medvoice.operators.word_bayes import fit_word_bayes, label_by_words
from medvoice.plans.extraction import extract
from medvoice.plans.extraction import run as run_extraction
from medvoice.plans.training import train
from medvoice.plans.views import numeric_reviews, table, text_reviews
from medvoice.schemas import FEATURES, LANDED, RAW, SCORED
from medvoice.sources import files, messages
from medvoice.streaming.landing import land_messages, read_landed_manifests
from medvoice.streaming.scoring import (
    archive_scored,
    landed_source,
    manifest_source,
    predicted_columns,
    read_predictions_manifests,
    score_landed,
    score_landed_manifests,
)
from medvoice.workspace import materialize, new_folder, spread

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The condition that stands in for the named ones of the product reports.
CONDITION = "ECONOMY"
DIGITS = 9
ROW_KEY = ("UniqueID", "usefulCount", "rating")


def query(name: str) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        return run

    return register


def _r(column: Column | str) -> Column:
    return F.round(column, DIGITS)


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text reviews for work that is heavy per text."""
    return spread(text_reviews(spark, sf_dir))


def _clean_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_reviews(numeric_reviews(spark, sf_dir))


# --- cleaning and audit ---------------------------------------------------------


@query("clean_reviews")
def q_clean_reviews(spark, sf_dir):
    return _clean_numeric(spark, sf_dir)


@query("stage_counts")
def q_stage_counts(spark, sf_dir):
    return stage_counts(numeric_reviews(spark, sf_dir))


@query("observed_counts")
def q_observed_counts(spark, sf_dir):
    """The same counts from the one job that extracts and writes."""
    raw, scored = new_folder(spark, "tsv"), new_folder(spark, "scored")
    files.write_reviews_tsv(text_reviews(spark, sf_dir).select(*RAW.fieldNames()), raw)
    counts = run_extraction(spark, raw, scored, file_format="parquet")
    written = spark.read.parquet(scored).agg(F.lit("written").alias("stage"), F.count(F.lit(1)).alias("n"))
    return files.from_local(spark, list(counts.items()), "stage string, n long").unionByName(written)


# --- grouped profiles -------------------------------------------------------------


@query("rating_histogram")
def q_rating_histogram(spark, sf_dir):
    return profiling.rating_histogram(_clean_numeric(spark, sf_dir))


@query("rating_histogram_raw")
def q_rating_histogram_raw(spark, sf_dir):
    return profiling.rating_histogram(numeric_reviews(spark, sf_dir), ordered=False)


@query("avg_rating_by_condition")
def q_avg_rating_by_condition(spark, sf_dir):
    return profiling.avg_rating_by(_clean_numeric(spark, sf_dir), "condition")


@query("avg_rating_by_drug")
def q_avg_rating_by_drug(spark, sf_dir):
    return profiling.avg_rating_by(_clean_numeric(spark, sf_dir), "drugName")


@query("rating_percent")
def q_rating_percent(spark, sf_dir):
    return profiling.rating_percent(numeric_reviews(spark, sf_dir)).withColumn(
        "percent", _r("percent")
    )


@query("condition_value_counts")
def q_condition_value_counts(spark, sf_dir):
    return profiling.value_counts(numeric_reviews(spark, sf_dir), "condition")


@query("top_conditions")
def q_top_conditions(spark, sf_dir):
    return profiling.top_conditions(numeric_reviews(spark, sf_dir))


@query("top_parts")
def q_top_parts(spark, sf_dir):
    """The most frequent of many values, by a sketch of bounded size and an exact count."""
    return sketches.top_values(table(spark, sf_dir, "lineitem"), "l_partkey", 50)


@query("top_parts_by_few")
def q_top_parts_by_few(spark, sf_dir):
    """The same with few values that are far more frequent than the others."""
    items = table(spark, sf_dir, "lineitem")
    key = F.when(F.col("l_partkey") % 3 == 0, F.col("l_partkey") % 20).otherwise(F.col("l_orderkey") + 1000)
    return sketches.top_values(items.select(key.alias("item")), "item", 10, tracked=500)


@query("top_drugs_gt")
def q_top_drugs_gt(spark, sf_dir):
    return profiling.top_drugs(numeric_reviews(spark, sf_dir), CONDITION, 7.0, False, always=(8.0, 9.0, 10.0))


@query("top_drugs_ge")
def q_top_drugs_ge(spark, sf_dir):
    return profiling.top_drugs(numeric_reviews(spark, sf_dir), CONDITION, 9.0, True, always=(9.0, 10.0))


@query("top_drugs_half_ratings")
def q_top_drugs_half_ratings(spark, sf_dir):
    """Ratings between the whole numbers are counted like all others."""
    half = F.col("rating") - F.col("UniqueID") % 2 * 0.5
    reviews = numeric_reviews(spark, sf_dir).withColumn("rating", half)
    return profiling.top_drugs(reviews, CONDITION, 8.0, False, always=(8.5, 9.0, 9.5, 10.0))


@query("drug_rating_crosstab")
def q_drug_rating_crosstab(spark, sf_dir):
    return profiling.crosstab(numeric_reviews(spark, sf_dir), "drugName", "rating")


@query("drug_rating_pairs")
def q_drug_rating_pairs(spark, sf_dir):
    return profiling.crosstab_long(numeric_reviews(spark, sf_dir), "drugName", "rating")


@query("sentiment_summary")
def q_sentiment_summary(spark, sf_dir):
    row = profiling.summary(numeric_reviews(spark, sf_dir), "sentiment")
    return row.select("count", *[_r(c).alias(c) for c in row.columns if c != "count"])


@query("sentiment_describe")
def q_sentiment_describe(spark, sf_dir):
    row = describe(numeric_reviews(spark, sf_dir), "sentiment")
    return row.select("count", *[_r(c).alias(c) for c in row.columns if c != "count"])


@query("sentiment_summary_by_month")
def q_sentiment_summary_by_month(spark, sf_dir):
    """Stored sketches per month and year, merged to months; quartiles by the error of their rank."""
    reviews = numeric_reviews(spark, sf_dir).select(
        F.year("review_ts").alias("year"), F.month("review_ts").alias("month"), "sentiment"
    )
    parts = materialize(sketches.summary_parts(reviews, "sentiment", ["year", "month"]), "sketches")
    merged = sketches.summary_of(sketches.merged_parts(parts, ["month"]))
    near = []
    for q in (25, 50, 75):
        below = F.count_if(F.col("sentiment") < F.col(f"q{q}")) / F.count(F.lit(1))
        upto = F.count_if(F.col("sentiment") <= F.col(f"q{q}")) / F.count(F.lit(1))
        near.append(((below <= q / 100 + 0.01) & (upto >= q / 100 - 0.01)).alias(f"q{q}_near"))
    ranks = reviews.join(F.broadcast(merged.select("month", "q25", "q50", "q75")), "month").groupBy("month").agg(*near)
    return merged.join(ranks, "month").select(
        "month", "count", *[_r(c).alias(c) for c in ("mean", "stddev", "min", "max")], "q25_near", "q50_near", "q75_near"
    )


@query("price_describe")
def q_price_describe(spark, sf_dir):
    row = describe(table(spark, sf_dir, "lineitem"), "l_extendedprice")
    return row.select("count", *[F.round(c, 4).alias(c) for c in row.columns if c != "count"])


@query("rmse_by_drug")
def q_rmse_by_drug(spark, sf_dir):
    rated = numeric_reviews(spark, sf_dir).where(F.col("rating").isNotNull())
    return rated.groupBy("drugName").agg(_r(profiling.rmse("rating", F.lit(5.5))).alias("rmse"))


@query("rmse_rounded")
def q_rmse_rounded(spark, sf_dir):
    guess = 5.5 + 4.5 * F.col("sentiment")
    return _clean_numeric(spark, sf_dir).agg(
        _r(profiling.rmse_rounded("rating", guess)).alias("rmse")
    )


# --- projections and derived columns ------------------------------------------------


@query("project_features")
def q_project_features(spark, sf_dir):
    return numeric_reviews(spark, sf_dir).select(*FEATURES)


@query("drop_columns")
def q_drop_columns(spark, sf_dir):
    return numeric_reviews(spark, sf_dir).drop("review_ts", "document", "token", "class")


@query("rename_review")
def q_rename_review(spark, sf_dir):
    return text_reviews(spark, sf_dir).withColumnRenamed("review", "text")


@query("to_numeric_cols")
def q_to_numeric_cols(spark, sf_dir):
    as_text = numeric_reviews(spark, sf_dir).select(
        "UniqueID", F.col("rating").cast("string").alias("rating"),
        F.col("usefulCount").cast("string").alias("usefulCount"), "condition",
    )
    return as_text.select(
        "UniqueID",
        C.to_numeric("rating").alias("rating"),
        C.to_numeric("usefulCount").alias("usefulCount"),
        C.to_numeric_or_null("condition").alias("condition"),
    )


@query("review_sent")
def q_review_sent(spark, sf_dir):
    return numeric_reviews(spark, sf_dir).select(
        "UniqueID", "rating", C.review_sent("rating").alias("review_sent")
    )


@query("rint_col")
def q_rint_col(spark, sf_dir):
    return numeric_reviews(spark, sf_dir).select(
        "UniqueID", C.round_half_even(F.col("sentiment") * 5).alias("rounded")
    )


@query("month_dir_counts")
def q_month_dir_counts(spark, sf_dir):
    return (
        table(spark, sf_dir, "events")
        .groupBy(C.month_dir("ts").alias("month_dir"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


# --- order, limit, sample, append ----------------------------------------------------


@query("latest_reviews")
def q_latest_reviews(spark, sf_dir):
    return (
        numeric_reviews(spark, sf_dir)
        .select("review_ts", "UniqueID", "usefulCount", "rating")
        .orderBy(F.desc("review_ts"), "UniqueID", "usefulCount", F.asc_nulls_last("rating"))
        .limit(20)
    )


@query("sample_n")
def q_sample_n(spark, sf_dir):
    return sample_n(text_reviews(spark, sf_dir), ["UniqueID"], n=100, seed=1).select(
        "UniqueID", "drugName", "rating"
    )


@query("sample_large")
def q_sample_large(spark, sf_dir):
    """Half of all line items, without ordering them."""
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return sample_large(items, ["l_orderkey", "l_linenumber"], n=items.count() // 2, seed=1)


@query("holdout_split")
def q_holdout_split(spark, sf_dir):
    return (
        with_split(numeric_reviews(spark, sf_dir), ["UniqueID"])
        .groupBy("holdout")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("UniqueID").alias("id_sum"),
        )
    )


@query("union_batches")
def q_union_batches(spark, sf_dir):
    numbers = numeric_reviews(spark, sf_dir)
    texts = text_reviews(spark, sf_dir)
    return files.append(
        numbers.select("UniqueID", "drugName", "rating", "sentiment"),
        texts.select("rating", "UniqueID", "drugName", "review"),
    )


# --- files -----------------------------------------------------------------------------


@query("tsv_round_trip")
def q_tsv_round_trip(spark, sf_dir):
    folder = new_folder(spark, "tsv")
    files.write_reviews_tsv(text_reviews(spark, sf_dir).select(*RAW.fieldNames()), folder)
    return files.read_reviews_tsv(spark, folder)


@query("text_typed_round_trip")
def q_text_typed_round_trip(spark, sf_dir):
    folder = new_folder(spark, "tsv-text")
    files.write_reviews_tsv(text_reviews(spark, sf_dir).select(*RAW.fieldNames()), folder)
    return files.read_text_typed(spark, folder)


@query("tsv_split_round_trip")
def q_tsv_split_round_trip(spark, sf_dir):
    """One file whose reviews span lines, read by a task per block."""
    folder = new_folder(spark, "tsv-split")
    files.write_reviews_tsv(text_reviews(spark, sf_dir).select(*RAW.fieldNames()), folder)
    return files.read_reviews_tsv(spark, folder, split=True)


@query("scored_csv_round_trip")
def q_scored_csv_round_trip(spark, sf_dir):
    folder = new_folder(spark, "scored")
    scored = score_reviews(text_reviews(spark, sf_dir))
    files.write_scored_csv(scored.select(*SCORED.fieldNames()), folder, 200)
    return files.read_scored_csv(spark, folder).withColumn("sentiment", _r("sentiment"))


@query("predictions_by_run")
def q_predictions_by_run(spark, sf_dir):
    folder = new_folder(spark, "predictions")
    guess = numeric_reviews(spark, sf_dir).select(
        "UniqueID", *FEATURES, (5.5 + 4.5 * F.col("sentiment")).alias("prediction")
    )
    for run in ("first", "second", "second"):
        files.write_predictions(guess, folder, run)
    return (
        spark.read.parquet(folder)
        .groupBy("run_ts")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("UniqueID").alias("id_sum"))
    )


# --- text ----------------------------------------------------------------------------------


@query("term_frequency")
def q_term_frequency(spark, sf_dir):
    return terms.term_frequency(_texts(spark, sf_dir), "review")


@query("term_freq_negative")
def q_term_freq_negative(spark, sf_dir):
    return terms.term_frequency_by_sentiment(_texts(spark, sf_dir), 0)


@query("term_freq_positive")
def q_term_freq_positive(spark, sf_dir):
    return terms.term_frequency_by_sentiment(_texts(spark, sf_dir), 1)


@query("drug_name_terms")
def q_drug_name_terms(spark, sf_dir):
    names = terms.weighted_values(numeric_reviews(spark, sf_dir), "drugName")
    return terms.term_frequency(names, "drugName", STOPWORDS, weight="weight")


@query("review_cloud")
def q_review_cloud(spark, sf_dir):
    return terms.cloud_terms(_texts(spark, sf_dir), "review")


def _labelled_cloud(spark: SparkSession, sf_dir: str, label: int) -> DataFrame:
    reviews = _texts(spark, sf_dir)
    return terms.cloud_terms(reviews.where(C.review_sent("rating") == label), "review")


@query("negative_cloud")
def q_negative_cloud(spark, sf_dir):
    return _labelled_cloud(spark, sf_dir, 0)


@query("positive_cloud")
def q_positive_cloud(spark, sf_dir):
    return _labelled_cloud(spark, sf_dir, 1)


@query("drug_name_cloud")
def q_drug_name_cloud(spark, sf_dir):
    names = terms.weighted_values(numeric_reviews(spark, sf_dir), "drugName")
    return terms.cloud_terms(names, "drugName", weight="weight")


@query("benchmark_cloud")
def q_benchmark_cloud(spark, sf_dir):
    """A cloud of many terms by weighted values: the texts of the benchmark."""
    texts = table(spark, sf_dir, "benchmark").unionByName(table(spark, sf_dir, "benchmark"))
    return terms.cloud_terms(terms.weighted_values(texts, "text"), "text", weight="weight")


@query("review_polarity")
def q_review_polarity(spark, sf_dir):
    scored = score_reviews(text_reviews(spark, sf_dir))
    return scored.select("UniqueID", _r("sentiment").alias("sentiment"))


@query("polarity_sql")
def q_polarity_sql(spark, sf_dir):
    """The polarity as a function of SQL text."""
    register_polarity(spark, "review_polarity")
    text_reviews(spark, sf_dir).createOrReplaceTempView("text_reviews")
    return spark.sql(f"SELECT UniqueID, round(review_polarity(review), {DIGITS}) AS sentiment FROM text_reviews")


@query("review_polarity_large_lexicon")
def q_review_polarity_large_lexicon(spark, sf_dir):
    """Every word of the texts is a lexicon word: the join form."""
    reviews = _texts(spark, sf_dir).select("UniqueID", "review")
    words = materialize(terms.explode_tokens(reviews, "review").distinct(), "words")
    lexicon = words.select(
        F.col("term").alias("word"), ((F.length("term") % 5 - 2) / 2.0).alias("polarity")
    )
    scored = polarity_by_join(reviews, lexicon)
    return scored.select("UniqueID", _r("sentiment").alias("sentiment"))


@query("extract_scored")
def q_extract_scored(spark, sf_dir):
    scored = extract(text_reviews(spark, sf_dir))
    return scored.withColumn("sentiment", _r("sentiment"))


@query("explode_labels")
def q_explode_labels(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    positive = F.when(F.col("quality") == 1, "positive").otherwise("negative")
    safe = F.when(F.col("toxic") == 0, "positive").otherwise("negative")
    tagged = labels.select(
        "doc_id",
        F.array(F.struct(positive.alias("result")), F.struct(safe.alias("result"))).alias(
            "sentiment"
        ),
    )
    return classifier.explode_results(tagged)


@query("label_sentiment")
def q_label_sentiment(spark, sf_dir):
    """Labels by word counts, each word with a weight of its own."""
    reviews = _texts(spark, sf_dir).select(
        "UniqueID", F.col("review").alias("text"), C.review_sent("rating").alias("label")
    )
    labelled = label_by_words(fit_word_bayes(reviews), reviews.drop("label"))
    return classifier.explode_results(labelled).select("UniqueID", "sentiment")


@query("label_sentiment_hashed")
def q_label_sentiment_hashed(spark, sf_dir):
    """Labels by a pipeline of Spark ML with a hashed vocabulary; how many rows have one of the two."""
    reviews = _texts(spark, sf_dir).select(
        "UniqueID", F.col("review").alias("text"), C.review_sent("rating").alias("label")
    )
    model = classifier.fit_text_classifier(reviews)
    labelled = classifier.explode_results(classifier.label_sentiment(model, reviews.drop("label")))
    allowed = F.col("sentiment").isin(classifier.NEGATIVE, classifier.POSITIVE)
    return labelled.groupBy("UniqueID").agg(F.count_if(allowed).alias("n_allowed"), F.count(F.lit(1)).alias("n"))


# --- model ------------------------------------------------------------------------------------


@query("assemble_features")
def q_assemble_features(spark, sf_dir):
    vector = vector_to_array("features")
    return rating_model.assemble(numeric_reviews(spark, sf_dir)).select(
        "UniqueID",
        F.get(vector, F.lit(0)).alias("useful_count"),
        F.get(vector, F.lit(1)).alias("sentiment"),
    )


@query("index_condition")
def q_index_condition(spark, sf_dir):
    reviews = numeric_reviews(spark, sf_dir).select("condition")
    return (
        rating_model.fit_label_index(reviews)
        .transform(reviews)
        .groupBy("condition", "condition_idx")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query("index_parts_by_rank")
def q_index_parts_by_rank(spark, sf_dir):
    """The index for more labels than one model should hold."""
    items = table(spark, sf_dir, "lineitem").select(F.concat(F.lit("part "), "l_partkey").alias("label"))
    ranks = rating_model.label_ranks(items, "label")
    return (
        rating_model.index_by_ranks(items, ranks, "label")
        .groupBy("label", "label_idx")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query("condition_index_stage")
def q_condition_index_stage(spark, sf_dir):
    """The index as a stage whose labels are a table: stored, loaded, with labels it has not seen."""
    items = table(spark, sf_dir, "lineitem").select(F.concat(F.lit("part "), "l_partkey").alias("label"))
    stage = LabelIndex(inputCol="label", outputCol="label_idx").fit(items)
    folder = new_folder(spark, "index-stage")
    PipelineModel(stages=[stage]).write().save(folder)
    asked = items.unionByName(
        table(spark, sf_dir, "orders").select(
            F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("order "), "o_orderkey")).alias("label")
        )
    )
    return (
        PipelineModel.load(folder).transform(asked).groupBy("label_idx").agg(F.count(F.lit(1)).alias("n"))
    )


@query("rating_model_collapsed")
def q_rating_model_collapsed(spark, sf_dir):
    """Rows per side, and whether a fit to cells is as good as one to all rows, to a fiftieth."""
    reviews = numeric_reviews(spark, sf_dir)
    plain, cells = train(reviews).report, train(reviews, bins=64).report
    both = plain.join(cells.select("split", F.col("rmse").alias("of_cells")), "split")
    return both.select("split", "n", (F.col("of_cells") < 1.02 * F.col("rmse")).alias("as_good"))


@query("rating_model_predictions")
def q_rating_model_predictions(spark, sf_dir):
    result = train(numeric_reviews(spark, sf_dir))
    return result.predictions.select(
        "UniqueID", *FEATURES, "rating", "prediction",
        C.round_half_even("prediction").alias("prediction_ints"),
    )


@query("rating_model_rmse")
def q_rating_model_rmse(spark, sf_dir):
    return train(numeric_reviews(spark, sf_dir)).report


@query("prediction_sample")
def q_prediction_sample(spark, sf_dir):
    predictions = train(numeric_reviews(spark, sf_dir)).predictions
    return sample_n(predictions.drop("features"), [*ROW_KEY, "sentiment"], n=1000, seed=1)


@query("model_reload_predict")
def q_model_reload_predict(spark, sf_dir):
    folder = new_folder(spark, "model")
    reviews = numeric_reviews(spark, sf_dir)
    train(reviews, model_path=folder)
    reloaded = rating_model.load_model(folder)
    return rating_model.predict(reloaded, clean_reviews(reviews)).select(
        "UniqueID", *FEATURES, "prediction"
    )


# --- messages and streams -----------------------------------------------------------------------


@query("decode_event_bodies")
def q_decode_event_bodies(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    data = F.base64(F.col("props").cast("binary"))
    return events.select(
        "event_id", F.get_json_object(C.decode_body(data), "$.k").cast("long").alias("k")
    )


@query("decode_messages")
def q_decode_messages(spark, sf_dir):
    encoded = messages.encode_messages(text_reviews(spark, sf_dir))
    return messages.decode_messages(encoded).drop("data")


@query("stream_events_landed")
def q_stream_events_landed(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    source = messages.table_source(spark, sf_dir, schema, "events.parquet")
    out = new_folder(spark, "events")
    (
        source.withColumn("month_dir", C.month_dir("ts"))
        .writeStream.format("parquet")
        .partitionBy("month_dir")
        .option("checkpointLocation", new_folder(spark, "checkpoint"))
        .trigger(availableNow=True)
        .start(out)
        .awaitTermination()
    )
    return spark.read.parquet(out).select(
        "event_id", "user_id", "event_type", "value", "month_dir"
    )


def _land(spark: SparkSession, sf_dir: str, manifests: bool = False) -> tuple[str, str]:
    """Publish the text reviews as messages and land them; (landed, rejects)."""
    published = new_folder(spark, "messages")
    messages.encode_messages(text_reviews(spark, sf_dir)).write.text(published)
    landed, rejects = new_folder(spark, "landed"), new_folder(spark, "rejects")
    land_messages(
        messages.message_source(spark, published),
        landed, rejects, new_folder(spark, "checkpoint"), manifests=manifests,
    ).awaitTermination()
    return landed, rejects


@query("stream_month_land")
def q_stream_month_land(spark, sf_dir):
    landed, _ = _land(spark, sf_dir)
    return (
        files.read_landed(spark, landed)
        .withColumn("sentiment", _r("sentiment"))
        .withColumn("month_dir_ok", F.col("month_dir").rlike(r"^([1-9]|1[0-2])-\d{4}$"))
        .drop("month_dir")
    )


@query("stream_manifest_landed")
def q_stream_manifest_landed(spark, sf_dir):
    """The same, published by manifests."""
    landed, _ = _land(spark, sf_dir, manifests=True)
    return (
        read_landed_manifests(spark, landed)
        .withColumn("sentiment", _r("sentiment"))
        .withColumn("month_dir_ok", F.col("month_dir").rlike(r"^([1-9]|1[0-2])-\d{4}$"))
        .drop("month_dir")
    )


@query("stream_rejects")
def q_stream_rejects(spark, sf_dir):
    _, rejects = _land(spark, sf_dir)
    bodies = spark.read.schema("value string, month_dir string, batch_id int").text(rejects)
    parsed = C.parse_message(C.decode_body("value"))
    return bodies.select(parsed.alias("m")).select("m.UniqueID", "m.drugName", "m.condition")


def _score(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed, _ = _land(spark, sf_dir)
    model = train(numeric_reviews(spark, sf_dir)).model
    out = new_folder(spark, "predictions")
    checkpoint, archive = new_folder(spark, "checkpoint"), new_folder(spark, "archive")
    for _ in range(2):  # the second run finds nothing new
        score_landed(
            model, landed_source(spark, landed, archive), out, checkpoint
        ).awaitTermination()
    return spark.read.parquet(out)


@query("stream_score_new")
def q_stream_score_new(spark, sf_dir):
    return _score(spark, sf_dir).select("UniqueID", *FEATURES, "prediction")


@query("stream_score_audit")
def q_stream_score_audit(spark, sf_dir):
    """Each landed row once, with a prediction on the rating scale."""
    scored = _score(spark, sf_dir)
    return scored.groupBy("drugName").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("UniqueID").cast("long")).alias("id_sum"),
        F.count_if(F.col("prediction").between(1, 10)).alias("n_on_scale"),
    )


@query("stream_manifest_scored")
def q_stream_manifest_scored(spark, sf_dir):
    """Landing, scoring and predictions by manifests; the second run finds nothing new."""
    landed, _ = _land(spark, sf_dir, manifests=True)
    model = train(numeric_reviews(spark, sf_dir)).model
    out, checkpoint = new_folder(spark, "predictions"), new_folder(spark, "checkpoint")
    for _ in range(2):
        score_landed_manifests(model, manifest_source(spark, landed), landed, out, checkpoint).awaitTermination()
    return read_predictions_manifests(spark, out).groupBy("drugName").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("UniqueID").alias("id_sum"),
        F.count_if(F.col("prediction").between(1, 10)).alias("n_on_scale"),
    )


@query("batch_score_landed")
def q_batch_score_landed(spark, sf_dir):
    """The landed rows scored as a batch: what the streams must add up to."""
    landed, _ = _land(spark, sf_dir)
    model = train(numeric_reviews(spark, sf_dir)).model
    return predicted_columns(model, files.read_landed(spark, landed)).select(
        "UniqueID", *FEATURES, "prediction"
    )


@query("archive_audit")
def q_archive_audit(spark, sf_dir):
    """After one run all scored files are in the archive, and none is left."""
    landed, _ = _land(spark, sf_dir)
    model = train(numeric_reviews(spark, sf_dir)).model
    checkpoint, archive, out = (new_folder(spark, n) for n in ("checkpoint", "archive", "predictions"))
    score_landed(model, landed_source(spark, landed), out, checkpoint).awaitTermination()
    archive_scored(spark, checkpoint, landed, archive)
    schema, options = files.landed_layout()
    rows = [
        spark.read.schema(schema).options(**options, recursiveFileLookup="true").csv(folder).select(
            F.lit(name).alias("folder"), "UniqueID"
        )
        for name, folder in (("archived", archive), ("waiting", landed))
    ]
    return rows[0].unionByName(rows[1]).groupBy("folder").agg(
        F.count(F.lit(1)).alias("n"), F.sum("UniqueID").alias("id_sum")
    )


@query("run_stamps")
def q_run_stamps(spark, sf_dir):
    """All rows of a run share one sortable stamp."""
    stamped = numeric_reviews(spark, sf_dir).withColumn("run_ts", C.run_stamp())
    return stamped.groupBy("drugName").agg(
        F.count_if(F.col("run_ts").rlike(r"^\d{8}T\d{6}\.\d{6}$")).alias("n"), (F.min("run_ts") == F.max("run_ts")).alias("same")
    )


@query("rating_bands")
def q_rating_bands(spark, sf_dir):
    """Reviews by bands that are rows of the program."""
    bands = files.from_local(spark, [("low", 1.0, 4.0), ("middle", 5.0, 7.0), ("high", 8.0, 99.0)], "band string, least double, most double")
    reviews = numeric_reviews(spark, sf_dir)
    joined = reviews.join(F.broadcast(bands), F.col("rating").between(F.col("least"), F.col("most")))
    return joined.groupBy("band").agg(F.count(F.lit(1)).alias("n"))


# --- audits: what must hold whatever the model, and awkward inputs -------------------------------


@query("rating_model_audit")
def q_rating_model_audit(spark, sf_dir):
    """Rows per side, and whether the model beats the mean on each."""
    reviews = numeric_reviews(spark, sf_dir)
    spread_ = clean_reviews(reviews).agg(F.stddev_samp("rating")).first()[0]
    report = train(reviews).report
    return report.select("split", "n", (F.col("rmse") < spread_).alias("better"))


@query("rating_model_three_features")
def q_rating_model_three_features(spark, sf_dir):
    """The same with the condition's index as third feature."""
    reviews = numeric_reviews(spark, sf_dir)
    spread_ = clean_reviews(reviews).agg(F.stddev_samp("rating")).first()[0]
    result = train(
        reviews, features=(*FEATURES, "condition_idx"), indexed=("condition",)
    )
    return result.report.select(
        "split", "n", (F.col("rmse") < spread_).alias("better"),
        F.lit(result.model.stages[-1].numFeatures).alias("features"),
    )


@query("model_reload_audit")
def q_model_reload_audit(spark, sf_dir):
    """A stored model predicts what the fitted one does."""
    folder = new_folder(spark, "model")
    reviews = numeric_reviews(spark, sf_dir)
    result = train(reviews, model_path=folder)
    held = result.predictions.withColumnRenamed("prediction", "before").drop("features")
    both = rating_model.predict(rating_model.load_model(folder), held)
    return both.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("prediction") == F.col("before")).alias("n_equal"),
    )


@query("label_sentiment_audit")
def q_label_sentiment_audit(spark, sf_dir):
    """One of the two labels for every text."""
    allowed = F.col("sentiment").isin(classifier.NEGATIVE, classifier.POSITIVE)
    return (
        q_label_sentiment(spark, sf_dir)
        .groupBy("UniqueID")
        .agg(F.count_if(allowed).alias("n_allowed"), F.count(F.lit(1)).alias("n"))
    )


@query("polarity_duplicate_keys")
def q_polarity_duplicate_keys(spark, sf_dir):
    """Rows that share a key, or have none, are scored apart by the join form."""
    reviews = text_reviews(spark, sf_dir).select(
        F.when(F.col("UniqueID") % 5 != 0, F.col("UniqueID") % 7).alias("UniqueID"),
        F.col("UniqueID").alias("doc"), "review",
    )
    words = spark.createDataFrame(list(LEXICON.items()), "word string, polarity double")
    scored = polarity_by_join(reviews, words)
    return scored.select("doc", _r("sentiment").alias("sentiment"))


LARGE_ID = 3_000_000_000


@query("long_ids_landed")
def q_long_ids_landed(spark, sf_dir):
    """Identifiers beyond 32 bits through messages, landing and reading."""
    reviews = text_reviews(spark, sf_dir).withColumn("UniqueID", F.col("UniqueID") + LARGE_ID)
    published, landed = new_folder(spark, "messages"), new_folder(spark, "landed")
    messages.encode_messages(reviews).write.text(published)
    land_messages(
        messages.message_source(spark, published),
        landed, new_folder(spark, "rejects"), new_folder(spark, "checkpoint"),
    ).awaitTermination()
    return files.read_landed(spark, landed).select("UniqueID", "drugName")


@query("stream_two_sources")
def q_stream_two_sources(spark, sf_dir):
    """Two streams land in one folder, and a renewed checkpoint adds without replacing."""
    reviews = text_reviews(spark, sf_dir)
    landed, rejects = new_folder(spark, "landed"), new_folder(spark, "rejects")
    for half in (0, 1):
        published = new_folder(spark, "messages")
        part = reviews.where(F.col("UniqueID") % 2 == half)
        messages.encode_messages(part).write.text(published)
        land_messages(
            messages.message_source(spark, published),
            landed, rejects, new_folder(spark, "checkpoint"),
        ).awaitTermination()
    return (
        files.read_landed(spark, landed)
        .groupBy("drugName")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("UniqueID").alias("id_sum"))
    )


@query("landed_index_round_trip")
def q_landed_index_round_trip(spark, sf_dir):
    """Landed files with an unnamed index column first, flat in one folder."""
    scored = score_reviews(text_reviews(spark, sf_dir)).where("condition IS NOT NULL")
    folder = new_folder(spark, "indexed")
    indexed = scored.select(F.monotonically_increasing_id().alias("x"), *LANDED.fieldNames())
    files.csv_writer(indexed.withColumnRenamed("x", ""), files.LANDED_DELIMITER).csv(folder)
    return (
        files.read_landed(spark, folder, index_column=True)
        .drop("month_dir")
        .withColumn("sentiment", _r("sentiment"))
    )
