"""External models behind a provider: requests are keyed by content and answers are kept in a table.

Model calls are slow, billed and not repeatable, so they are never left in a
plan that may run again: requests are made distinct by key, those already in
the cache are left out, the rest are asked and written, and the answers are read
back from the table.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import base64_text
from ..schemas import SCHEMAS


class ModelError(RuntimeError):
    """A refusal or an answer cut short; it is not kept."""


@dataclass(frozen=True)
class Answer:
    """What a model gave: its text, why it stopped (`refusal` and `max_tokens` are errors), which model it was, what it used."""

    text: str
    stop: str | None = None
    model: str | None = None
    usage: str | None = None


@dataclass(frozen=True)
class Provider:
    """ask(prompt, images, system, max_tokens, effort) -> text or Answer, called on the workers; `open` makes it once a partition."""

    model: str
    open: Callable[[], Callable[..., str | Answer]]


def checked(answer: str | Answer, max_tokens: int) -> Answer:
    """The answer, if it is one."""
    if isinstance(answer, str):
        return Answer(answer)
    if not isinstance(answer, Answer) or not isinstance(answer.text, str):
        raise ModelError("the provider gave no text")
    if answer.stop == "refusal":
        raise ModelError(f"the model refused to answer: {answer.text[:200]}")
    if answer.stop == "max_tokens":
        raise ModelError(f"the answer was cut off at {max_tokens} tokens; ask for more")
    return answer


def offline(answer: Callable[..., str] | None = None, model: str = "offline") -> Provider:
    """A provider without a network: answer(...) or, by default, a digest of the prompt."""
    return Provider(model, lambda: answer or (lambda prompt, images, system, max_tokens, effort: hashlib.sha256(prompt.encode()).hexdigest()))


def image_digest(content: Column) -> Column:
    """An image in a key: the digest of its base64 text."""
    return F.sha2(base64_text(content), 256)


def request_key(model: str, prompt: Column, images: Column | None = None, system: str | None = None, max_tokens: int = 16_000, effort: str | None = None) -> Column:
    """sha256 of the request as JSON with sorted fields; images are an array of digests."""
    content = F.transform(images, lambda d: F.to_json(F.struct(d.alias("sha256"), F.lit("image").alias("type")))) if images is not None else F.array().cast("array<string>")
    text = F.to_json(F.struct(prompt.alias("text"), F.lit("text").alias("type")))
    parts = [
        F.lit('{"effort":'),
        F.lit(f'"{effort}"' if effort else "null"),
        F.lit(f',"max_tokens":{max_tokens},"messages":[{{"content":['),
        F.array_join(F.concat(content, F.array(text)), ","),
        F.lit('],"role":"user"}],"model":'),
        F.lit(f'"{model}"'),
        F.lit(',"system":'),
        F.get(F.split(F.to_json(F.struct(F.lit(system).alias("s"))), '^\\{"s":|\\}$'), F.lit(1)) if system else F.lit("null"),
        F.lit("}"),
    ]
    return F.sha2(F.concat(*parts), 256)


def split_by_cache(requests: DataFrame, cache: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Requests with an answer in the cache (with its text), and those without; of several answers to one key any is as good."""
    met = cache.join(requests.select("key").distinct(), "key", "left_semi").groupBy("key").agg(F.min("text").alias("answer"))
    return requests.join(met, "key"), requests.join(cache, "key", "left_anti")


class Cache:
    """The table of answers at a path."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def read(self) -> DataFrame:
        """The answers so far.

        Read file by file: two reads of one path count as the same scan within a
        plan, although answers may have come between them.
        """
        from ..sources.subtitles import read_table

        table = read_table(self.spark, "model_cache", self.path)
        files = table.inputFiles()
        return self.spark.read.schema(SCHEMAS["model_cache"]).parquet(*files) if files else table

    def answer(self, requests: DataFrame, provider: Provider, system: str | None = None, max_tokens: int = 16_000, effort: str | None = None) -> DataFrame:
        """requests (with `prompt`, and `images` as binaries if any) with `key` and `answer`.

        Every answer that came is kept, whatever became of the others; if one did
        not come, the first reason is raised afterwards, and a second run asks
        for the missing ones alone.
        """
        images = F.col("images") if "images" in requests.columns else None
        keyed = requests.withColumn("key", request_key(provider.model, F.col("prompt"), F.transform(images, image_digest) if images is not None else None, system, max_tokens, effort))
        _, missing = split_by_cache(keyed, self.read())
        columns = ["key", "prompt", *(["images"] if images is not None else [])]
        names = ["key", "text", "model", "usage", "error"]
        model, opened = provider.model, provider.open

        def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            call = opened()
            for batch in batches:
                for r in batch.to_pylist():  # one by one: calls are slow, and a row that is out is safe
                    try:
                        a = checked(call(r["prompt"], r.get("images") or [], system, max_tokens, effort), max_tokens)
                        row = (r["key"], a.text, a.model or model, a.usage, None)
                    except Exception as e:  # noqa: BLE001  any failure is told after the others are kept
                        row = (r["key"], None, model, None, f"{type(e).__name__}: {e}")
                    yield pa.RecordBatch.from_arrays([pa.array([v], pa.string()) for v in row], names=names)

        attempt = f"{self.path}_attempts/{uuid.uuid4().hex}"
        missing.select(*columns).dropDuplicates(["key"]).mapInArrow(ask, SCHEMAS["model_cache"] + ", error string").write.parquet(attempt)
        made = self.spark.read.schema(SCHEMAS["model_cache"] + ", error string").parquet(attempt)
        made.where("error IS NULL").drop("error").write.mode("append").parquet(self.path)
        failed = made.where("error IS NOT NULL").agg(F.count("*"), F.min("error")).first()
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(attempt)
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)
        if failed[0]:
            raise ModelError(f"{failed[0]} requests without an answer; {failed[1]}")
        return split_by_cache(keyed, self.read())[0]
