"""Times the headline queries and prints one JSON line.

Each query is run once to warm up and then twice, of which the shorter time counts, every time from the
model of the 20 sources, which are a column of the documents, and the same documents scored with it.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagwright.operators.labels import class_list, label_vocab, unpivot_tags
from tagwright.plans import relations
from tagwright.plans.queries import QUERIES
from tagwright.plans.training import HashedModel, fit_hashed
from tagwright.session import spread

HEADLINE = [
    "select_tags",
    "training_rows",
    "tokenize",
    "term_frequency",
    "document_frequency",
    "idf",
    "class_prior",
    "class_term_weight",
    "decode_posts",
    "tfidf",
    "hashing_tf",
    "nb_scores",
    "nb_predict",
    "nb_predict_sparse",
    "class_term_weight_added",
    "predicted_tag",
    "accuracy_any",
    "train_summary",
    "latest_post",
    "merged_post",
    "lookup_tag",
    "score_stream",
    "score_stream_plan",
    "upsert_stream",
    "merge_stream",
    "upsert_levels",
    "lookup_in_levels",
]


def compute(rows: DataFrame) -> None:
    rows.write.format("noop").mode("overwrite").save()


def source_classes(spark: SparkSession, sf_dir: str) -> list[tuple[int, str]]:
    tags = unpivot_tags(relations.table(spark, sf_dir, "documents"), "doc_id", ["source"])
    return class_list(label_vocab(tags, 20))


def fit_sources(spark: SparkSession, sf_dir: str, classes: list[tuple[int, str]]) -> HashedModel:
    documents = spread(relations.table(spark, sf_dir, "documents").select("doc_id", "text", "source"), "doc_id")
    place = F.array_position(F.lit([tag for _, tag in classes]), F.col("source")).cast("int") - 1
    one = F.array(F.struct(place.alias("CatId"), F.lit(1).cast("bigint").alias("n")))
    return fit_hashed(documents.select(F.col("text").alias("Body"), one.alias("classes")), classes)


def timed(job) -> float:
    """Seconds of the shorter of two runs after a first one."""
    runs = []
    for _ in range(3):
        begun = time.perf_counter()
        job()
        runs.append(time.perf_counter() - begun)
    return round(min(runs[1:]), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    classes = source_classes(spark, sf_dir)
    seconds["fit_sources"] = timed(lambda: fit_sources(spark, sf_dir, classes))
    model = fit_sources(spark, sf_dir, classes)
    seconds["score_sources"] = timed(lambda: compute(model.predict(relations.posts(spark, sf_dir))))
    for name in HEADLINE:
        seconds[name] = timed(lambda: compute(QUERIES[name](spark, sf_dir)))
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "cpus": int(cpus),
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
