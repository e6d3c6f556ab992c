"""The stage tables of a project and their state."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.evaluation import best_transcript, stage_status
from ..schemas import SCHEMAS
from ..sources.subtitles import read_table

#: Tables in the order in which stages write them.
TABLES = ("frame", "segment", "ocr", "segment_corrected", "description", "reconstruction", "resolved_line", "claim", "report")


class Catalog:
    """Tables below one root, all keyed by video_id."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, name: str) -> DataFrame:
        """A table; empty, with its declared schema, where nothing has been written."""
        if name in SCHEMAS:
            return read_table(self.spark, name, self.path(name))
        if name == "segment_corrected":
            return self._or_empty(name, SCHEMAS["segment"])
        return self.spark.read.parquet(self.path(name))

    def _or_empty(self, name: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(self.path(name))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def need(self, name: str) -> DataFrame:
        """A table that an earlier stage must have written."""
        return read_table(self.spark, name, self.path(name), missing_ok=False)

    def write(self, name: str, df: DataFrame, mode: str = "overwrite") -> DataFrame:
        df.write.mode(mode).parquet(self.path(name))
        return self.read(name)

    def segments(self) -> DataFrame:
        """The best transcript of each video."""
        return best_transcript(self.read("segment"), self.read("segment_corrected"), ["video_id"])

    def export_json(self, name: str, path: str, keys: tuple[str, ...] = ("video_id",)) -> None:
        """One text file set of (keys, JSON array of rows), rows as they sort."""
        rows = self.read(name)
        inner = F.struct(*(c for c in rows.columns if c not in keys))
        rows.groupBy(*keys).agg(F.to_json(F.sort_array(F.collect_list(inner))).alias("rows")).write.mode("overwrite").json(path)

    def write_document(self, name: str, documents: DataFrame) -> None:
        """One text a video (video_id, document) as documents/<name>/video_id=<video>/part-*.txt."""
        documents.select("video_id", F.col("document").alias("value")).write.mode("overwrite").partitionBy("video_id").text(self.path(f"documents/{name}"))

    def status(self) -> DataFrame:
        """(video_id, stage, done, score): which tables have rows of which video, with the latest score."""
        found = [self.read(t).select("video_id", F.lit(t).alias("stage")).distinct() for t in TABLES]
        present = found[0]
        for f in found[1:]:
            present = present.unionByName(f)
        videos = present.select("video_id").distinct()
        expected = videos.withColumn("stage", F.explode(F.array(*map(F.lit, TABLES))))
        scores = self.read("report").groupBy("video_id").agg(F.max_by("score", "iteration").alias("score"))
        return stage_status(expected, present, ["video_id"]).join(scores, "video_id", "left")
