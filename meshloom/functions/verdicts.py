"""Model replies: tolerant JSON extraction, coercion of fields, accept decisions and pose labels. All SQL functions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The spellings of booleans, and the flags with the reasons they give.
TRUE_WORDS, FALSE_WORDS = ("true", "yes", "1"), ("false", "no", "0")
FLAGS = (("is_primitive", "primitive"), ("is_ground_plane", "ground_plane"), ("is_noisy_scan", "noisy_scan"), ("is_fragmented", "fragmented"))
AXES = {"+X": (1, 0, 0), "-X": (-1, 0, 0), "+Y": (0, 1, 0), "-Y": (0, -1, 0), "+Z": (0, 0, 1), "-Z": (0, 0, -1)}

_OBJECT = r"(\{[^{}]*(?:\{[^{}]*\}[^{}]*)*\})"


def strip(text: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def unfenced(text: Column) -> Column:
    """Without surrounding white space and a leading or trailing code fence."""
    return F.regexp_replace(F.regexp_replace(strip(text), r"(?i)^```(?:json)?\s*", ""), r"\s*```$", "")


def first_object(text: Column) -> Column:
    """The first JSON object as a variant: the whole text, else the first brace group (one level of nesting) that parses; null if none does."""
    found = F.filter(
        F.concat(F.array(text), F.regexp_extract_all(text, F.lit(_OBJECT), F.lit(1))),
        lambda c: F.coalesce(F.schema_of_variant(F.try_parse_json(c)).startswith("OBJECT"), F.lit(False)),
    )
    return F.try_parse_json(F.get(found, F.lit(0)))


def _kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def _text(v: Column) -> Column:
    return F.try_variant_get(v, "$", "string")


def to_boolean(v: Column) -> Column:
    """A boolean as it is, a spelling of one, else null; numbers are null."""
    word = F.lower(strip(_text(v)))
    return F.when(_kind(v) == "BOOLEAN", F.try_variant_get(v, "$", "boolean")).when(_kind(v) == "STRING", F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False))


def to_integer(v: Column) -> Column:
    """An integer as it is, the first one in a string, a number cut towards zero; booleans are null."""
    number = F.try_variant_get(v, "$", "double")
    cut = F.when(number < 0, F.ceil(number)).otherwise(F.floor(number)).cast("long")
    exact = F.try_variant_get(v, "$", "long")
    return (
        F.when(_kind(v) == "BIGINT", exact)
        .when(_kind(v) == "STRING", F.regexp_extract(_text(v), r"-?[0-9]+", 0).try_cast("long"))
        .when(_kind(v).startswith("DECIMAL") | _kind(v).isin("DOUBLE", "FLOAT"), F.when(F.abs(number) < 9.2e18, cut))
    )


def parse_reply(reply: Column) -> Column:
    """The reply as a struct: aesthetic_quality, the four flags, object_class, reasoning (at most 1000 characters, 500 of the text if nothing parses), parse_error.

    Bare scalars and arrays count as not parsed.
    """
    text = unfenced(F.coalesce(reply, F.lit("")))
    v = first_object(text)
    get = lambda k: F.try_variant_get(v, f"$.{k}", "variant")
    reasoning = F.coalesce(_text(get("reasoning")), F.lit(""))
    return F.struct(
        to_integer(get("aesthetic_quality")).alias("aesthetic_quality"), *[to_boolean(get(k)).alias(k) for k, _ in FLAGS], _text(get("object_class")).alias("object_class"),
        F.when(v.isNull(), F.substring(text, 1, 500)).otherwise(F.substring(reasoning, 1, 1000)).alias("reasoning"), v.isNull().alias("parse_error"),
    )


@dataclass(frozen=True)
class AcceptConfig:
    min_quality: int = 2
    reject_primitive: bool = True
    reject_ground: bool = True
    reject_noisy: bool = True
    reject_fragmented: bool = True


def accept_reasons(verdict: Column, config: AcceptConfig = AcceptConfig()) -> Column:
    """Why a parsed reply is rejected, in order; nulls give no reason, so a reply that doesn't parse is accepted."""
    q = verdict["aesthetic_quality"]
    on = (config.reject_primitive, config.reject_ground, config.reject_noisy, config.reject_fragmented)
    reasons = [F.when(q < config.min_quality, F.concat(F.lit("aesthetic_quality="), q.cast("string"), F.lit(f" < {config.min_quality}")))]
    reasons += [F.when(F.coalesce(verdict[k], F.lit(False)), F.lit(said)) for (k, said), use in zip(FLAGS, on, strict=True) if use]
    return F.array_compact(F.array(*reasons))


def parse_pose(reply: Column) -> Column:
    """(up, front, ok): upper-cased axis labels of a pose reply; ok if both are known and at right angles. The whole text is tried, else from the first brace to the last."""
    whole = F.try_parse_json(unfenced(F.coalesce(reply, F.lit(""))))
    v = F.coalesce(whole, F.try_parse_json(F.regexp_extract(reply, r"(?s)\{.*\}", 0)))
    up, front = (F.upper(strip(F.coalesce(F.try_variant_get(v, f"$.{k}", "string"), F.lit("")))) for k in ("up_axis", "front_axis"))
    known = up.isin(*AXES) & front.isin(*AXES)
    return F.struct(up.alias("up"), front.alias("front"), F.coalesce(known & (F.substring(up, 2, 1) != F.substring(front, 2, 1)), F.lit(False)).alias("ok"))
