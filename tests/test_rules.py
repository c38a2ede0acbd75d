import pytest
from pyspark.sql import functions as F

from meshloom.functions import rules, verdicts

CASES = [
    ('{"aesthetic_quality": 4, "is_primitive": "false", "object_class": "chair"}', 4, False, False),
    ('```json\n{"aesthetic_quality": 4, "is_primitive": "false"}\n```', 4, False, False),
    ("no json here", None, None, True),
    ("42", None, None, True),
    ("[1]", None, None, True),
    ('pre {"a": {"b": 1}, "aesthetic_quality": "-3 of 5"} post', -3, None, False),
    ('{"aesthetic_quality": true, "is_primitive": 1}', None, None, False),
    ('{"aesthetic_quality": 3.9, "is_primitive": " YES "}', 3, True, False),
    ('{"aesthetic_quality": -3.9}', -3, None, False),
    ('{"aesthetic_quality": 1e3}', 1000, None, False),
    ('{"aesthetic_quality": null}', None, None, False),
    ('{bad} {"aesthetic_quality": 2}', 2, None, False),
    ('{"aesthetic_quality": 2,}', None, None, True),
    (None, None, None, True),
    ("", None, None, True),
    (' \n```JSON {"aesthetic_quality": "none"} ```', None, None, False),
]


@pytest.mark.parametrize("reply,quality,primitive,failed", CASES)
def test_parse_reply(spark, reply, quality, primitive, failed):
    v = spark.createDataFrame([(reply,)], "r string").select(verdicts.parse_reply(F.col("r")).alias("v")).first().v
    assert (v.aesthetic_quality, v.is_primitive, v.parse_error) == (quality, primitive, failed)


def test_unparsed_text_is_cut_and_accepted(spark):
    row = spark.createDataFrame([("x" * 900,)], "r string").select(verdicts.parse_reply(F.col("r")).alias("v")).select("v", verdicts.accept_reasons(F.col("v")).alias("why")).first()
    assert len(row.v.reasoning) == 500 and row.why == []


def test_switches_of_the_accept_decision(spark):
    reply = '{"aesthetic_quality": 1, "is_primitive": true, "is_ground_plane": true, "is_noisy_scan": true, "is_fragmented": true}'
    df = spark.createDataFrame([(reply,)], "r string").select(verdicts.parse_reply(F.col("r")).alias("v"))
    assert df.select(verdicts.accept_reasons(F.col("v"))).first()[0] == ["aesthetic_quality=1 < 2", "primitive", "ground_plane", "noisy_scan", "fragmented"]
    config = verdicts.AcceptConfig(0, False, True, False, True)
    assert df.select(verdicts.accept_reasons(F.col("v"), config)).first()[0] == ["ground_plane", "fragmented"]


def test_geometry_reasons_in_order(spark):
    config = rules.GeometryConfig(volume_area_ratio_min=0.01, ray_agreement_min=0.92)
    df = spark.createDataFrame([(9, 0.001, 0.02, 0.5, 0.2, 10, 0.9)], "num_components int, volume_area_ratio double, interior_ratio double, ray_agreement double, chamfer double, num_vertices int, axis_share double")
    got = df.select(rules.geometry_reasons({c: F.col(c) for c in df.columns}, config)).first()[0]
    assert got == ["too_many_components=9", "thin_shell_vol_area=0.0010", "thin_shell interior_ratio=0.0200 < 0.03", "ray_sign_disagreement=0.500", "vae_chamfer=0.2000 > 0.15", "primitive_like"]
    assert df.select(rules.geometry_reasons({})).first()[0] == []


def test_infinite_chamfer_rejects(spark):
    df = spark.createDataFrame([(float("inf"),)], "c double")
    assert df.select(rules.geometry_reasons({"chamfer": F.col("c")})).first()[0] == ["vae_chamfer=Infinity > 0.15"]


def test_error_messages_are_cut(spark):
    df = spark.createDataFrame([("m" * 500,)], "m string")
    assert len(df.select(rules.error_reason(F.lit("load"), F.col("m"))).first()[0]) == len("error:load:") + 200
    assert df.select(rules.split_reasons(F.lit("a||b|"))).first()[0] == ["a", "b"]
