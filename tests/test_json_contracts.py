"""Contracts from JSON Schema: equal to the written-out rules on rows, and the schema's own meaning on messages."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tickbars.functions.scalars import ID_PATTERN
from tickbars.operators import contracts, json_contracts
from tickbars.plans.feed import emitted_ms
from tickbars.sinks import messages, versioned
from tickbars.sources import streams
from tickbars.streaming import stages

T0 = 1_735_822_800_000
LOAD = dt.datetime(2025, 1, 3)
WHOLE = {"start_ts_ms", "end_ts_ms", "window_ms", "trade_count", "bin_count", "max_lateness_ms", "api_send_ts_ms", "source_event_ts_ms", "ingest_ts_ms"}
TEXT = {"bin_id", "bar_id", "symbol", "source"}


def schema_of(id_field, required, minimum, sources, const):
    """The contract of the written-out rules as JSON Schema."""
    properties = {}
    for name in [*required, *minimum, "source"]:
        kind = "string" if name in TEXT else "integer" if name in WHOLE else "number"
        properties[name] = {"type": kind, "description": "a field"}
    for name, low in minimum.items():
        properties[name]["minimum"] = low
    properties[id_field]["pattern"] = ID_PATTERN
    properties["symbol"]["minLength"] = 1
    properties["source"]["enum"] = sources
    for name, value in const.items():
        properties[name]["const"] = value
    return {"$schema": "http://json-schema.org/draft-07/schema#", "type": "object", "required": required, "properties": properties}


BIN_SCHEMA = schema_of("bin_id", contracts.BIN_REQUIRED, contracts.BIN_MINIMUM, contracts.BIN_SOURCES, {"window_ms": 10})
BAR_SCHEMA = schema_of("bar_id", contracts.BAR_REQUIRED, contracts.BAR_MINIMUM, contracts.BAR_SOURCES, {})


def _spoiled(rows, id_field):
    """Each record spoiled in one way, and one in two."""
    ways = [
        {}, {id_field: F.lit("a-1")}, {"volume": F.lit(-1).cast("decimal(38,6)")}, {"symbol": F.lit("")}, {"source": F.lit("x")}, {"open": F.lit(None).cast("decimal(18,6)")},
        {"api_send_ts_ms": F.lit(None).cast("long"), "ingest_ts_ms": F.lit(-5).cast("long")}, {"source": F.lit(None).cast("string")},
    ]
    if id_field == "bin_id":
        ways += [{"window_ms": F.lit(20).cast("long")}, {"trade_count": F.lit(0).cast("long")}]
    out = None
    for k, way in enumerate(ways):
        bad = rows.withColumns({"at": F.lit(k), **way})
        out = bad if out is None else out.unionByName(bad)
    return out


@pytest.mark.parametrize("kind", ["bin", "bar"])
def test_rows_give_the_written_out_violations(bins_of, bars_of, kind):
    rows = (bins_of if kind == "bin" else bars_of)([("A", T0, 5, 1)])
    schema, rules = (BIN_SCHEMA, contracts.bin_rules()) if kind == "bin" else (BAR_SCHEMA, contracts.bar_rules())
    bad = _spoiled(rows, f"{kind}_id")
    compiled = json_contracts.row_rules(schema, rows)
    got = bad.select("at", F.explode(json_contracts.broken_rules(compiled)))
    want = bad.select("at", F.explode(json_contracts.broken_rules(rules)))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and want.count() >= 7
    good, kept_out = json_contracts.quarantine(bad, compiled)
    assert [r.at for r in good.orderBy("at").collect()] == [0, 7] and kept_out.count() == bad.count() - 2


CASES = [
    ('{"a": 1, "b": "xy"}', []),
    ('{"a": 1.0, "b": "xy"}', []),
    ('{"a": 1e2, "b": "xy"}', ["a:maximum"]),
    ('{"a": 1.5, "b": "xy"}', ["a:type"]),
    ('{"a": "1", "b": "xy"}', ["a:type"]),
    ('{"a": null, "b": "xy"}', ["a:type"]),
    ('{"a": true, "b": "xy"}', ["a:type"]),
    ('{"b": "xy"}', ["a:required"]),
    ('{"a": 0, "b": "x"}', ["a:minimum", "b:pattern", "b:min_length"]),
    ('{"a": 1, "b": "xyxyx"}', ["b:max_length"]),
    ('{"a": 1, "b": "xy", "c": 3}', ["c:const"]),
    ('{"a": 1, "b": "xy", "c": 2.0, "d": "on"}', []),
    ('{"a": 1, "b": "xy", "d": false}', []),
    ('{"a": 1, "b": "xy", "d": "false"}', ["d:enum"]),
    ('{"a": 1, "b": "xy", "d": null}', ["d:enum"]),
    ('{"a": 1, "b": "xy", "e": []}', []),
    ('{"a": 1, "b": "xy", "e": {"x": 1}}', ["e:type"]),
    ('{"a": 1, "b": "xy", "f": 0}', ["f:exclusive_minimum"]),
    ('{"a": 1, "b": "xy", "f": "text"}', []),
    ('{"a": 1, "b": "xy", "g": 1}', ["record:additional"]),
    ("[1, 2]", ["record:type"]),
    ("not json", ["record:type"]),
    ('{"a": 1, "b": "xy"', ["record:type"]),
    ("", ["record:type"]),
    (None, ["record:type"]),
]
SMALL = {
    "type": "object",
    "required": ["a", "b"],
    "additionalProperties": False,
    "properties": {
        "a": {"type": "integer", "minimum": 1, "maximum": 50},
        "b": {"type": "string", "pattern": "^xy", "minLength": 2, "maxLength": 4},
        "c": {"const": 2},
        "d": {"enum": ["on", False]},
        "e": {"type": ["array", "null"]},
        "f": {"exclusiveMinimum": 0},
    },
}


def test_messages(spark):
    rows = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "at INT, value STRING")
    got = {r.at: r.broken for r in rows.select("at", json_contracts.broken_rules(json_contracts.message_rules(SMALL)).alias("broken")).collect()}
    assert got == {i: rules for i, (_, rules) in enumerate(CASES)}


def test_messages_of_bins_and_bars(spark, bins_of, bars_of):
    for rows, made, schema in ((bins_of, messages.bin_messages, BIN_SCHEMA), (bars_of, messages.bar_messages, BAR_SCHEMA)):
        good = made(rows([("A", T0, 5, 1), ("B", T0, 6, 0)]))
        rules = json_contracts.message_rules(schema)
        kept, out = json_contracts.quarantine(good, rules)
        assert (kept.count(), out.count()) == (2, 0)
        bad = good.withColumn("value", F.regexp_replace("value", '"symbol":"A"', '"symbol":7'))
        _, out = json_contracts.quarantine(bad, rules)
        assert [r.broken for r in out.collect()] == [["symbol:type"]]


@pytest.mark.parametrize("schema", [{"properties": {"a": {"format": "date"}}}, {"oneOf": []}, {"type": "array"}])
def test_unknown_keywords_are_refused(schema):
    with pytest.raises(ValueError):
        json_contracts.message_rules(schema)


def test_load(tmp_path):
    (tmp_path / "c.json").write_bytes(b"\xef\xbb\xbf" + json.dumps(SMALL).encode())
    assert json_contracts.load(str(tmp_path / "c.json")) == SMALL


def test_bad_messages_never_reach_facts(spark, bins_of, bars_of, tmp_path):
    """A pipeline with a contract stores what breaks it, with the reasons, and folds the rest."""
    rows = bins_of([("A", T0 + 10 * k, 5, 1) for k in range(5)]).drop("window_ms").withColumn("window_ms", F.lit(10).cast("long"))
    good = rows.withColumn("arrival_seq", F.col("start_ts_ms"))
    bad = good.limit(2).withColumn("bin_id", F.concat(F.lit("x"), "bin_id")).withColumn("volume", F.lit(-9).cast("decimal(18,6)"))
    pipeline = stages.BinPipeline(spark, str(tmp_path / "bins"), ingest=emitted_ms(), load_ts=LOAD, contract=BIN_SCHEMA)
    pipeline(good.unionByName(bad), 0)
    pipeline.drain(1, good)
    kept_out = spark.read.option("recursiveFileLookup", True).parquet(str(tmp_path / "bins" / "rejected_bins"))
    assert sorted(r.broken for r in kept_out.collect()) == [["bin_id:pattern", "volume:minimum"]] * 2
    made = spark.read.option("recursiveFileLookup", True).parquet(str(tmp_path / "bins" / "bars"))
    assert [(r.bin_count, float(r.volume)) for r in made.collect()] == [(5, 5.0)]

    seconds = bars_of([("A", T0, 5, 1), ("A", T0 + 1000, 6, 1)]).withColumn("arrival_seq", F.col("start_ts_ms"))
    spoiled = seconds.withColumn("notional", F.when(F.col("start_ts_ms") == T0, F.lit(-1).cast("decimal(18,6)")).otherwise(F.col("notional")))
    pipeline = stages.BarPipeline(spark, str(tmp_path / "bars"), ingest=emitted_ms(), load_ts=LOAD, contract=BAR_SCHEMA)
    pipeline(spoiled, 0)
    assert [(r.n_rows, r.file != "") for r in versioned.manifest(spark, f"{tmp_path}/bars/fact_1s").select("n_rows", "file").collect()] == [(1, True)]
    kept_out = spark.read.option("recursiveFileLookup", True).parquet(str(tmp_path / "bars" / "rejected_bars"))
    assert [r.broken for r in kept_out.collect()] == [["notional:minimum"]]


def test_contract_before_decoding(spark, bins_of, tmp_path):
    """Messages that aren't even JSON are kept with their text when the contract is held against the messages."""
    topic = messages.bin_messages(bins_of([("A", T0, 5, 1)])).withColumn("arrival_seq", F.lit(0).cast("long"))
    broken = topic.withColumn("value", F.lit("{oops"))
    good, letters = json_contracts.quarantine(topic.unionByName(broken), json_contracts.message_rules(BIN_SCHEMA))
    assert [r.value for r in letters.collect()] == ["{oops"]
    assert streams.decode(good, streams.BIN).count() == 1
