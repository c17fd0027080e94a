"""Command line: ``spark-submit ... -m medvoice <job> ...`` or ``python -m medvoice``."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from medvoice.functions.lexicon import LEXICON
from medvoice.operators.polarity import read_lexicon
from medvoice.operators.rating_model import load_model
from medvoice.plans import extraction
from medvoice.plans.profile import reports
from medvoice.plans.training import train
from medvoice.schemas import FEATURES
from medvoice.session import build_session
from medvoice.sources.files import as_parquet, read_reviews_tsv, read_scored_csv
from medvoice.sources.messages import message_source
from medvoice.streaming.landing import land_messages
from medvoice.streaming.scoring import (
    archive_scored,
    landed_source,
    manifest_source,
    score_landed,
    score_landed_manifests,
)
from medvoice.workspace import new_folder


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="medvoice")
    jobs = top.add_subparsers(dest="job", required=True)

    job = jobs.add_parser("extract", help="raw TSV -> cleaned, scored table")
    job.add_argument("raw")
    job.add_argument("scored")
    job.add_argument("--format", default="csv", choices=["csv", "parquet"])
    job.add_argument("--lexicon", help="CSV files with the columns word, polarity")
    job.add_argument("--split", action="store_true", help="read large files by a task per block")

    job = jobs.add_parser("profile", help="raw TSV -> one Parquet table per report")
    job.add_argument("raw")
    job.add_argument("out")
    job.add_argument("--split", action="store_true", help="read large files by a task per block")

    job = jobs.add_parser("train", help="scored tables -> stored model and report")
    job.add_argument("train")
    job.add_argument("holdout")
    job.add_argument("model")
    job.add_argument("--seed", type=int, default=42)
    job.add_argument("--indexed", nargs="*", default=[], help="text columns to add to the features, such as condition")
    job.add_argument("--bins", type=int, help="fit to cells of so many bins a feature, for very large tables")
    job.add_argument("--format", default="csv", choices=["csv", "parquet"])

    job = jobs.add_parser("land", help="message files -> landed files by month")
    job.add_argument("messages")
    job.add_argument("landed")
    job.add_argument("rejects")
    job.add_argument("checkpoint")
    job.add_argument("--forever", action="store_true")
    job.add_argument("--lexicon", help="CSV files with the columns word, polarity")
    job.add_argument("--max-files", type=int, help="files in a micro-batch")
    job.add_argument("--max-bytes", help="bytes in a micro-batch, such as 1g")
    job.add_argument("--manifests", action="store_true", help="publish by manifests, not by renaming")

    job = jobs.add_parser("score", help="landed files -> predictions, inputs archived")
    job.add_argument("model")
    job.add_argument("landed")
    job.add_argument("predictions")
    job.add_argument("checkpoint")
    job.add_argument("--archive")
    job.add_argument("--max-files", type=int, help="files in a micro-batch")
    job.add_argument("--index-column", action="store_true", help="landed files have an index first")
    job.add_argument("--manifests", action="store_true", help="read and publish by manifests")
    return top


def scored_table(spark: SparkSession, path: str, file_format: str) -> DataFrame:
    """A scored table as the extract job wrote it."""
    return spark.read.parquet(path) if file_format == "parquet" else read_scored_csv(spark, path)


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session(f"medvoice-{args.job}")
    lexicon = read_lexicon(spark, args.lexicon) if getattr(args, "lexicon", None) else LEXICON
    if args.job == "extract":
        print(extraction.run(spark, args.raw, args.scored, lexicon, file_format=args.format, split=args.split))
    elif args.job == "profile":
        raw = as_parquet(read_reviews_tsv(spark, args.raw, split=args.split), new_folder(spark, "reviews"))
        for name, report in reports(raw).items():
            report.write.mode("overwrite").parquet(f"{args.out}/{name}")
    elif args.job == "train":
        result = train(
            scored_table(spark, args.train, args.format),
            scored_table(spark, args.holdout, args.format),
            seed=args.seed,
            model_path=args.model,
            features=(*FEATURES, *(f"{c}_idx" for c in args.indexed)),
            indexed=args.indexed,
            bins=args.bins,
        )
        result.report.show()
    elif args.job == "land":
        land_messages(
            message_source(spark, args.messages, args.max_files, args.max_bytes),
            args.landed, args.rejects, args.checkpoint, lexicon, once=not args.forever, manifests=args.manifests,
        ).awaitTermination()
    elif args.manifests:
        score_landed_manifests(
            load_model(args.model), manifest_source(spark, args.landed, args.max_files),
            args.landed, args.predictions, args.checkpoint,
        ).awaitTermination()
    else:
        score_landed(
            load_model(args.model),
            landed_source(
                spark, args.landed, args.archive, args.max_files, args.index_column
            ),
            args.predictions, args.checkpoint,
        ).awaitTermination()
        if args.archive:
            archive_scored(spark, args.checkpoint, args.landed, args.archive)


if __name__ == "__main__":
    main()
