"""Column functions, codecs and schemas on hand-worked cases."""

from datetime import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windflow import schemas
from windflow.functions import durations, hashing, power, text
from windflow.functions.codecs import Codec, decode_json, decoded, encode_records, rejects
from windflow.sources import avro

from helpers import rows


def test_power_curve(spark):
    df = spark.createDataFrame([(x,) for x in (2.99, 3.0, 7.5, 12.0, 24.99, 25.0)], "w DOUBLE")
    out = df.select(power.power_curve(F.col("w"), F.lit(7e6)).alias("p"))
    assert [r.p for r in out.collect()] == [0, 0, 875_000, 7e6, 7e6, 0]


def test_convert_and_clamp(spark):
    df = spark.createDataFrame([(1500.0,)], "p DOUBLE")
    out = df.select(power.convert_power(F.col("p"), "W", "kW"), power.convert_power(F.col("p"), "kW", "MW"),
                    power.convert_power(F.col("p"), "MW", "W"), power.clamp(F.col("p"), 0.0, 1000.0))
    assert tuple(out.first()) == (1.5, 1.5, 1.5e9, 1000.0)
    none = spark.createDataFrame([(None,)], "p DOUBLE").select(power.clamp(F.col("p"), 0.0, 30.0))
    assert none.first()[0] is None


def test_murmur2_vectors(spark):
    df = spark.createDataFrame([("21",), ("foobar",), ("abc",), ("",)], "k STRING")
    out = [r[0] for r in df.select(hashing.murmur2(F.col("k"))).collect()]
    assert out[:3] == [-973932308, -790332482, 479470107]
    assert spark.createDataFrame([(None,)], "k STRING").select(hashing.murmur2(F.col("k"))).first()[0] is None
    # The public vectors of the client library for longer keys.
    df = spark.createDataFrame([("a-little-bit-long-string",), ("a-little-bit-longer-string",),
                                ("lkjh234lh9fiuh90y23oiuhsafujhadof229phr9h19h89h8",)], "k STRING")
    assert [r[0] for r in df.select(hashing.murmur2(F.col("k"))).collect()] == [
        -985981536, -1486304829, -58897971]


@pytest.mark.parametrize("hash_name", ["md5", "murmur2"])
def test_heavy_partition(spark, hash_name):
    keys = [f"HeavyProducer_{i}" for i in range(200)] + [f"Turbine{i}" for i in range(400)]
    df = spark.createDataFrame([(k,) for k in keys], "k STRING")
    out = df.select("k", hashing.heavy_partition(F.col("k"), 12, hash_name=hash_name).alias("p")).collect()
    heavy = {r.p for r in out if r.k.startswith("HeavyProducer_")}
    assert heavy == set(range(4))
    assert {r.p for r in out if not r.k.startswith("HeavyProducer_")} == set(range(4, 12))


def test_heavy_partition_rejects_bad_settings(spark):
    for partitions, heavy in ((4, 4), (3, 4), ("12", 4), (12, 0)):
        with pytest.raises(ValueError):
            hashing.heavy_partition(F.col("k"), partitions, heavy)
    df = spark.createDataFrame([(None,)], "k STRING")
    assert df.select(hashing.heavy_partition(F.col("k"), 12)).first()[0] is None


def test_add_months_keeps_the_time(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 31, 8), 1)], "t TIMESTAMP, n INT")
    out = df.select(text.add_months(F.col("t"), F.col("n")).alias("t"))
    assert out.first().t == datetime(2024, 2, 29, 8)
    assert out.select(text.time_text(F.col("t"))).first()[0] == "2024-02-29 08:00:00"


def test_texts(spark):
    df = spark.createDataFrame([(70, False), (5, True)], "amount INT, flagged BOOLEAN")
    labels = [r[0] for r in df.select(text.amount_label(F.col("amount"), F.col("flagged"))).collect()]
    assert labels == ["70€", "5€ <-Suspicious!"]
    out = df.select(text.turbine_key(F.col("amount")), text.park_key(F.col("amount")),
                    text.metric_line(F.lit("T1"), F.lit("P1"), F.lit(2.005)),
                    text.two_decimals(F.lit(1.0))).first()
    assert tuple(out) == ("Turbine70", "Windpark0", "power{turbine=T1,windPark=P1} 2.01", "1.00")


def test_utf8_both_ways(spark):
    df = spark.createDataFrame([("Größe 5€",)], "t STRING")
    assert df.select(text.utf8_text(text.utf8_bytes(F.col("t")))).first()[0] == "Größe 5€"


def test_stable_uuid_and_json(spark):
    df = spark.createDataFrame([(1, '{"a":1}'), (2, "{bad"), (3, None)], "id INT, j STRING")
    first = [r[0] for r in df.select(text.stable_uuid(F.col("id"))).collect()]
    assert len(set(first)) == 3 and all(len(x) == 36 and x.count("-") == 4 for x in first)
    assert first == [r[0] for r in df.select(text.stable_uuid(F.col("id"))).collect()]
    assert [r[0] for r in df.select(text.valid_json(F.col("j"))).collect()] == [True, False, False]


def test_durations():
    assert durations.micros("1 hour 30 minutes") == 5_400_000_000
    assert durations.hours("1 minute") == 1 / 60
    for bad in ("", "hour", "1 fortnight"):
        with pytest.raises(ValueError):
            durations.micros(bad)


JSON_CASES = [
    (1, '{"wind_turbine_id":"T1","wind_park_id":"P1","current_power":5.5}'),
    (2, '{"wind_turbine_id":"T2"}'),
    (3, '{"wind_turbine_id":"T3","unknown":7,"current_power":1}'),
    (4, "{bad"),
    (5, None),
    (6, '{"wind_turbine_id":"T6","current_power":"12.5"}'),
    (7, '{"wind_turbine_id":"T7","current_power":"x"}'),
]


def test_decode_json(spark):
    df = spark.createDataFrame(JSON_CASES, "id INT, value STRING")
    out = {r.id: r for r in decode_json(df, Codec(schemas.READING)).collect()}
    assert out[1].state == "ok" and tuple(out[1].record) == ("T1", "P1", 5.5)
    assert out[2].state == "ok" and out[2].record.current_power is None
    assert out[3].state == "ok" and tuple(out[3].record) == ("T3", None, 1.0)
    assert out[4].state == "rejected" and out[4].record is None and out[4].value == "{bad"
    assert out[5].state == "tombstone" and out[5].record is None
    assert {r.id for r in rejects(df, Codec(schemas.READING)).collect()} >= {4, 7}
    assert decoded(df, Codec(schemas.READING)).columns == [
        "id", "wind_turbine_id", "wind_park_id", "current_power"]


def test_decode_json_java_defaults(spark):
    df = spark.createDataFrame(JSON_CASES, "id INT, value STRING")
    out = {r.id: r for r in decode_json(df, Codec(schemas.READING, java_defaults=True)).collect()}
    assert [out[i].record.current_power for i in (1, 2, 3, 6)] == [5.5, 0.0, 1.0, 12.5]
    assert [out[i].state for i in (4, 5, 7)] == ["rejected", "tombstone", "rejected"]


def test_encode_omits_nulls(spark):
    df = spark.createDataFrame([("T1", None, 2.5)], schemas.READING)
    out = encode_records(df, Codec(schemas.READING), "wind-turbine-data", F.col("wind_turbine_id"))
    assert tuple(out.first()) == (
        "wind-turbine-data", "T1", '{"wind_turbine_id":"T1","current_power":2.5}')


def test_codec_round_trip(spark):
    codec = Codec(schemas.TRANSFER)
    df = spark.createDataFrame([("Alice", "Bob", 70, False), ("Eve", 'D"v', 5, True)], schemas.TRANSFER)
    back = decoded(df.select(codec.encode().alias("value")), codec)
    assert rows(back) == rows(df)


def test_snake_case(spark):
    assert schemas.snake_name("generatedPowerInMwh") == "generated_power_in_mwh"
    assert schemas.snake_name("WindTurbine") == "wind_turbine"
    inner = T.StructType([T.StructField("windTurbineId", T.StringType())])
    df = spark.createDataFrame([(("a",), 1)], T.StructType([
        T.StructField("turbineData", inner), T.StructField("isOnline", T.IntegerType())]))
    out = schemas.snake_case(df)
    assert out.columns == ["turbine_data", "is_online"]
    assert out.select("turbine_data.wind_turbine_id").first()[0] == "a"


def required(name, dtype):
    return T.StructField(name, dtype, False)


def test_compatibility():
    old = T.StructType([required("a", T.StringType()), T.StructField("b", T.DoubleType())])
    optional = T.StructType([*old.fields, T.StructField("c", T.StringType())])
    forced = T.StructType([*old.fields, required("c", T.StringType())])
    retyped = T.StructType([old.fields[0], T.StructField("b", T.StringType())])
    assert schemas.check_compatible(old, optional) == []
    assert schemas.check_compatible(schemas.READING, schemas.READING_V2) == []
    assert schemas.check_compatible(old, forced)
    assert schemas.check_compatible(old, retyped)
    assert schemas.check_compatible(old, retyped, "NONE") == []
    assert schemas.check_compatible(old, forced, "FORWARD") == []
    assert schemas.check_compatible(forced, old, "BACKWARD") == []
    assert schemas.check_compatible(forced, old, "FORWARD")
    nested = T.StructType([T.StructField("n", old)])
    assert schemas.check_compatible(nested, T.StructType([T.StructField("n", retyped)])) == [
        "field n.b changed from double to string"]
    with pytest.raises(ValueError):
        schemas.check_compatible(old, old, "SOME")


def test_read_together(spark):
    old = spark.createDataFrame([("T1", "P1", 1.0)], schemas.READING)
    new = spark.createDataFrame([("T2", "P2", 2.0, "Maker1")], schemas.READING_V2)
    assert rows(schemas.read_together(old, new), "wind_turbine_id", "manufacturer") == [
        ("T1", None), ("T2", "Maker1")]


def test_avro_declaration():
    import json
    declared = json.loads(schemas.avro_schema(schemas.READING_V2, "WindTurbineData",
                                              required=("wind_turbine_id",)))
    assert declared["namespace"] == "wind" and declared["name"] == "WindTurbineData"
    assert declared["fields"][0] == {"name": "wind_turbine_id", "type": "string"}
    assert declared["fields"][2] == {"name": "current_power", "type": ["null", "double"], "default": None}
    nested = json.loads(schemas.avro_schema(schemas.READING_WITH_WEATHER, "Joined"))
    assert nested["fields"][1]["type"][1]["name"] == "WeatherData"


def test_avro_header(spark):
    df = spark.createDataFrame([(bytearray(b"\x00\x00\x00\x01\x02payload"),), (bytearray(b"\x01abc"),)],
                               "value BINARY")
    out = df.select(avro.has_header(F.col("value")), avro.schema_id(F.col("value")),
                    avro.payload(F.col("value"))).first()
    assert (out[0], out[1], bytes(out[2])) == (True, 258, b"payload")
    assert not df.select(avro.has_header(F.col("value"))).collect()[1][0]
    framed = df.limit(1).select(avro.with_header(F.lit(bytearray(b"xy")), 258)).first()[0]
    assert bytes(framed) == b"\x00\x00\x00\x01\x02xy"


def test_avro_round_trip_or_a_clear_error(spark):
    df = spark.createDataFrame([("T1", "P1", 1.0)], schemas.READING)
    try:
        framed = avro.encode_avro(df, schemas.READING, "WindTurbineData", 7)
    except AnalysisException as error:
        assert "spark-avro" in str(error)
        with pytest.raises(AnalysisException, match="spark-avro"):
            avro.decode_avro(df.withColumn("value", F.lit(bytearray(b""))), schemas.READING, "WindTurbineData")
    else:
        assert tuple(avro.decode_avro(framed, schemas.READING, "WindTurbineData").first().record) == (
            "T1", "P1", 1.0)


def test_text_behind_a_record_is_rejected(spark):
    codec = Codec(schemas.struct_of("a INT, s STRING"))
    texts = ['{"a":1}', ' {"a":1,"s":"x"} ', '{"a":1}]', '{"a":1}] xx', '{"a":1}} xx', '{"a":1},"end":"x"}', '{"a":1} xx',
             '{"a":1},{"a":2}', '[{"a":1}]', "null", "5", "", " ", '{"a":"z"}', '{"a":1', '{"s":"]}","a":2}', "{}"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, value string")
    states = {r["i"]: r["state"] for r in decode_json(df, codec).collect()}
    assert [i for i, s in states.items() if s == "ok"] == [0, 1, 15, 16]
    assert set(states.values()) == {"ok", "rejected"}
