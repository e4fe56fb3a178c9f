"""Versioned folders of fitted models. A version counts once its manifest row is written, which is done last."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagwright.operators.bayes import SEEN, BayesModel, term_bytes
from tagwright.operators.terms import TermTable, term_bucket
from tagwright.plans.training import HashedModel
from tagwright.session import shuffles_dropped

MANIFEST = "version INT, kind STRING, smoothing DOUBLE, buckets INT, slots INT"
BUCKET_BYTES = 8 << 20
MOST_BUCKETS = 1 << 16
TERMS = f"term STRING, df BIGINT, idf DOUBLE, seen {SEEN}, bucket INT"
CLASSES = "CatId INT, Tag STRING, place INT, n_rows BIGINT, weight DOUBLE"


class ModelStore:
    """Models below one folder of a file system that the cluster shares."""

    def __init__(self, spark: SparkSession, path: str, bucket_bytes: int = BUCKET_BYTES):
        self.spark = spark
        self.path = path.rstrip("/")
        self.bucket_bytes = bucket_bytes

    def versions(self) -> DataFrame | None:
        """The manifest, or None while nothing was published."""
        try:
            return self.spark.read.schema(MANIFEST).json(f"{self.path}/manifest")
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def latest(self) -> int | None:
        """The newest complete version."""
        manifest = self.versions()
        return None if manifest is None else manifest.agg(F.max("version")).first()[0]

    def _folder(self, version: int) -> str:
        return f"{self.path}/v={version}"

    def publish(self, model: HashedModel | BayesModel) -> int:
        """Save ``model`` as the next version. One writer at a time."""
        version = (self.latest() or 0) + 1
        folder = self._folder(version)
        if isinstance(model, HashedModel):
            model.pipeline.write().overwrite().save(f"{folder}/stages")
            rows = [(cat_id, tag, None, None, None) for cat_id, tag in model.classes]
            kind, smoothing, buckets, slots = "hashed", None, None, None
        else:
            buckets = min(MOST_BUCKETS, 1 + model.terms.n_bytes // self.bucket_bytes)
            self._write_terms(model.terms.rows, f"{folder}/terms", buckets)
            rows = list(zip(model.class_ids, model.tags, model.places, model.class_rows, model.class_weights))
            kind, smoothing, slots = "exact", model.smoothing, model.slots
        self.spark.createDataFrame(rows, CLASSES).coalesce(1).write.mode("overwrite").parquet(f"{folder}/classes")
        entry = self.spark.createDataFrame([(version, kind, smoothing, buckets, slots)], MANIFEST)
        entry.coalesce(1).write.mode("append").json(f"{self.path}/manifest")
        return version

    def _write_terms(self, terms: DataFrame, path: str, buckets: int) -> None:
        """Write a term table into folders by bucket, so that a few terms are found without reading the rest."""
        placed = terms.select("term", "df", "idf", "seen", term_bucket(F.col("term"), buckets).alias("bucket"))
        dealt = placed.repartition(buckets, "bucket").sortWithinPartitions("bucket", "term")
        with shuffles_dropped(self.spark):
            dealt.write.mode("overwrite").partitionBy("bucket").option("compression", "zstd").parquet(path)

    def load(self, version: int | None = None) -> HashedModel | BayesModel:
        """A complete version with its labels, by default the newest."""
        version = self.latest() if version is None else version
        manifest = self.versions()
        entry = None if manifest is None else manifest.where(F.col("version") == version).first()
        if entry is None:
            raise LookupError(f"no complete model version {version} in {self.path}")
        folder = self._folder(version)
        classes = self.spark.read.schema(CLASSES).parquet(f"{folder}/classes").orderBy("CatId").collect()
        if entry["kind"] == "hashed":
            pipeline = PipelineModel.load(f"{folder}/stages")
            return HashedModel(pipeline, [(row["CatId"], row["Tag"]) for row in classes])
        terms = self.spark.read.schema(TERMS).parquet(f"{folder}/terms")
        return BayesModel(
            terms=TermTable.measure(terms, term_bytes(), entry["buckets"]),
            places=[row["place"] for row in classes],
            class_ids=[row["CatId"] for row in classes],
            tags=[row["Tag"] for row in classes],
            class_rows=[row["n_rows"] for row in classes],
            class_weights=[row["weight"] for row in classes],
            smoothing=entry["smoothing"],
            slots=entry["slots"],
        )
