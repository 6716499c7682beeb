from pyspark.sql import functions as F

from obsflow.functions.time import VALID_FORMAT
from obsflow.operators import clean
from obsflow.schema import FIELDS, RAW_SCHEMA

CLEAN_ROW = dict(
    station="FSO", valid="2013-01-04 19:55", tmpf="32.0", dwpf="25.7", relh="77.28", feel="27.42", drct="240.0",
    sped="4.6", alti="29.71", mslp="1012.0", p01m="0.00", vsby="10.0", skyc1="OVC", skyl1="3200.0", wxcodes="49",
    ice_acceretion_1hr="0.01",
)


def frame(spark, *changes):
    return spark.createDataFrame([[{**CLEAN_ROW, **c}[f] for f in FIELDS] for c in changes], RAW_SCHEMA)


def test_sentinels_only(spark):
    sentinels = dict(mslp="-1.0", skyl1="M", wxcodes="M", ice_acceretion_1hr="M", skyc1="M")
    df = clean.impute(frame(spark, {}, *[{k: v} for k, v in sentinels.items()], {"mslp": "-1"}, {"mslp": None}))
    got = [r.asDict() for r in df.collect()]
    assert got[0] == CLEAN_ROW
    want = dict(mslp="0", skyl1="0", wxcodes="88", ice_acceretion_1hr="0", skyc1="CLR")
    for row, (name, value) in zip(got[1:], want.items()):
        assert row == {**CLEAN_ROW, name: value}
    assert got[6]["mslp"] == "0" and got[7]["mslp"] is None


def test_replacement_is_a_parameter(spark):
    row = clean.impute(frame(spark, {"wxcodes": "M"}), {"wxcodes": "CLR"}).first()
    assert row["wxcodes"] == "CLR"


def test_codes_keep_unknown_labels(spark):
    df = frame(spark, {}, {"station": "ZZZ", "skyc1": "XX"}, {"station": "6B0", "skyc1": "CLR"}, {"station": None})
    got = df.transform(clean.encode_sky).transform(clean.encode_station).select("station", "skyc1").collect()
    assert [tuple(r) for r in got] == [("2", "4"), ("ZZZ", "XX"), ("10", "0"), (None, "4")]


def test_engineered_features(spark):
    df = clean.feature_engineering(clean.with_valid(frame(spark, {"mslp": "-1", "skyl1": "M", "skyc1": "M"}, {"tmpf": "M"})))
    first, second = df.collect()
    assert first["tmpf"] == 0.32 and first["mslp"] == 0.0 and first["skyl1"] == 0.0
    assert first["skyc1"] == "0" and first["station"] == "2" and first["wxcodes"] == "49" and first["p01m"] == "0.00"
    assert str(first["valid"]) == "2013-01-04 19:55:00"
    assert second["tmpf"] is None and second["mslp"] == 1.012


def test_steps_equal_the_composition(spark):
    df = frame(spark, {}, {"mslp": "-1.0", "skyl1": "M", "station": "BTV"})
    steps = df.transform(clean.impute).transform(clean.encode_sky).transform(clean.encode_station).transform(clean.scale)
    assert steps.collect() == clean.feature_engineering(df).collect()


def test_messages_round_trip(spark):
    df = frame(spark, {}, {"tmpf": "M"})
    messages = clean.to_messages(df, key="dummykey", topic="t")
    assert messages.columns == ["key", "value", "topic"]
    binary = messages.select(F.col("key").cast("binary"), F.col("value").cast("binary"), "topic")
    back = clean.observations(binary)
    assert back.columns == ["event_key", "event_topic", *FIELDS]
    expected = clean.with_valid(df).collect()
    assert back.select(*FIELDS).collect() == expected


def test_bad_messages_become_nulls(spark):
    df = spark.createDataFrame([("{not json",), ('{"station": "FSO", "valid": "never"}',)], "value string")
    first, second = clean.observations(df).collect()
    assert all(v is None for v in first)
    assert second["station"] == "FSO" and second["valid"] is None


def test_valid_by_pattern_and_by_cast(spark):
    df = spark.createDataFrame([("2013-01-04 19:55",), ("2013-01-04 19:55:30",), ("x",), (None,)], "valid string")
    cast = [str(r[0]) for r in clean.with_valid(df).collect()]
    pattern = [str(r[0]) for r in clean.with_valid(df, pattern=VALID_FORMAT).collect()]
    assert cast == ["2013-01-04 19:55:00", "2013-01-04 19:55:30", "None", "None"]
    assert pattern == ["2013-01-04 19:55:00", "None", "None", "None"]


def test_mean_imputation(spark):
    df = spark.createDataFrame([("1000",), ("1010",), ("-1.0",), ("M",)], "mslp string")
    assert [r[0] for r in clean.impute_mean(df, "mslp", marker=-1).collect()] == [1000.0, 1010.0, 1005.0, 1005.0]
