"""Learned scorers as plug-ins: batched calls in Python workers, a result cache keyed by content, and deterministic stand-ins."""

from __future__ import annotations

from collections.abc import Callable
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.verdicts import AcceptConfig, accept_reasons, parse_reply
from .packed import Mesh, map_meshes

#: Prompt languages; an unknown one means English.
PROMPTS = {"en": "Judge this 3D object. Reply in JSON.", "zh": "请评价这个三维物体，用 JSON 回答。"}

#: What is asked with the six views of a pose.
POSE_PROMPT = 'The six views are named by the axis they look along. Which axis points up and which to the front? Reply in JSON: {"up_axis": "+Y", "front_axis": "+Z"}.'

_loaded: dict = {}


class ImageScorer(Protocol):
    name: str

    def generate(self, images: list[bytes], prompt: str) -> list[str]: ...


class StubImageScorer:
    """Replies that depend on the image alone, for tests."""

    name = "stub"

    def generate(self, images: list[bytes], prompt: str) -> list[str]:
        import zlib

        return ['{"aesthetic_quality": %d, "is_primitive": false, "is_ground_plane": false, "is_noisy_scan": false, "is_fragmented": false, "object_class": "object"}' % (zlib.crc32(i or b"") % 5 + 1) for i in images]


def once(factory: Callable):
    """The worker's own instance: loaded once in each Python process."""
    key = (factory.__module__, factory.__qualname__)
    if key not in _loaded:
        _loaded[key] = factory()
    return _loaded[key]


def infer(images: DataFrame, factory: Callable[[], ImageScorer] = StubImageScorer, lang: str = "en", batch_size: int = 4, prompt: str | None = None) -> DataFrame:
    """(mesh_id, png) -> (mesh_id, raw_response, error) in batches of batch_size; a batch that fails gives its error for each of its rows. The prompt is that of the language if not given."""
    prompt = prompt or PROMPTS.get(lang, PROMPTS["en"])
    key = images.schema["mesh_id"].dataType.simpleString()

    def run(batches):
        scorer = once(factory)
        for batch in batches:
            replies, errors = [], []
            for at in range(0, batch.num_rows, batch_size):
                part = batch.slice(at, batch_size)
                try:
                    some, why = list(scorer.generate(part.column(1).to_pylist(), prompt)), None
                    if len(some) != part.num_rows:
                        raise ValueError(f"{len(some)} replies to {part.num_rows} images")
                except Exception as problem:  # noqa: BLE001
                    some, why = [None] * part.num_rows, f"{type(problem).__name__}:{str(problem)[:200]}"
                replies += some
                errors += [why] * part.num_rows
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(replies, pa.string()), pa.array(errors, pa.string())], ["mesh_id", "raw_response", "error"])

    return images.select("mesh_id", "png").mapInArrow(run, f"mesh_id {key}, raw_response string, error string")


def cache_key(sha256, model: str, lang: str, render: str):
    return F.sha2(F.concat_ws("|", sha256, F.lit(model), F.lit(lang), F.lit(render)), 256)


def with_cache(requests: DataFrame, cache: DataFrame, score: Callable[[DataFrame], DataFrame], key: str = "cache_key") -> DataFrame:
    """Replies of the requests: those in the cache (key, raw_response; corrupt ones have null) and the rest from `score`."""
    good = cache.where("raw_response is not null").groupBy(key).agg(F.first("raw_response").alias("raw_response"))
    hits = requests.join(good, key).select("mesh_id", key, "raw_response", F.lit(None).cast("string").alias("error"), F.lit(True).alias("cached"))
    missing = requests.join(good, key, "left_anti")
    new = score(missing).join(missing.select("mesh_id", key), "mesh_id").select("mesh_id", key, "raw_response", "error", F.lit(False).alias("cached"))
    return hits.unionAll(new)


def with_caches(requests: DataFrame, caches: DataFrame, score: Callable[[DataFrame], DataFrame], cache: str = "cache", key: str = "cache_key", order: str = "n") -> DataFrame:
    """with_cache() for requests that name a cache each, in the order of the requests (order, unique and not null). An answer counts only in its own cache, and a mesh may be asked for repeatedly."""
    both = lambda t: t.withColumn("_at", F.struct(cache, key))
    asked = both(requests).withColumn("mesh_id", F.col(order))  # scorers answer by request, not by mesh
    found = with_cache(asked, both(caches).select("_at", "raw_response"), score, "_at").withColumnRenamed("mesh_id", order)
    return requests.select(order, "mesh_id").join(found, order).select(order, "mesh_id", "_at.*", "raw_response", "error", "cached").orderBy(order)


def decide(replies: DataFrame, config: AcceptConfig = AcceptConfig()) -> DataFrame:
    """Replies with verdict, rejection_reasons and accepted; the rules apply to cached replies too."""
    out = replies.withColumn("verdict", parse_reply(F.col("raw_response")))
    out = out.withColumn("rejection_reasons", accept_reasons(F.col("verdict"), config))
    return out.withColumn("accepted", F.size("rejection_reasons") == 0)

