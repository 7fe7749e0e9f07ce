"""Run a job from the command line.

    spark-submit earshot/plans/run.py preprocess  contacts.jsonl  out/
    spark-submit earshot/plans/run.py classify    out/cleaned     out/

``preprocess`` and ``search`` read raw contacts (JSON lines), the others the
cleaned parquet that ``preprocess`` writes.  Tables are written as parquet,
one folder each; small reports are also shown.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from earshot.plans import jobs
from earshot.session import prepare_session
from earshot.sources.contacts import read_contacts, write_parquet

JOBS = {
    "preprocess": jobs.preprocess_job,
    "classify": jobs.classification_job,
    "search": lambda contacts: {"neighbours": jobs.search_job(contacts)},
    "sentiment": jobs.sentiment_job,
    "topics": jobs.topics_job,
}
RAW_INPUT = ("preprocess", "search")
BIG_TABLES = ("cleaned", "classified", "predictions", "disagreements", "scored", "assigned")


def run(spark: SparkSession, job: str, source: str, target: str) -> dict[str, DataFrame]:
    contacts = read_contacts(spark, source) if job in RAW_INPUT else spark.read.parquet(source)
    results = JOBS[job](contacts)
    for name, table in results.items():
        write_parquet(table, f"{target}/{name}")
    return {name: spark.read.parquet(f"{target}/{name}") for name in results}


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("job", choices=JOBS)
    parser.add_argument("source")
    parser.add_argument("target")
    args = parser.parse_args()
    spark = prepare_session(SparkSession.builder.appName(f"earshot-{args.job}").getOrCreate(), tune=True)
    for name, table in run(spark, args.job, args.source, args.target).items():
        if name not in BIG_TABLES:
            print(name)
            table.show(50, truncate=120)


if __name__ == "__main__":
    main()
