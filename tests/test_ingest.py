import json

from hypothesis import given, settings
from hypothesis import strategies as st

from feedrank.schemas import CLICK
from feedrank.sources import ingest as ing

from conftest import rows

GOOD = {"type": "track", "event": "Viewed Shoppable Fit", "timestamp": "2019-09-21T20:31:07.942Z",
        "userId": "u1", "properties": {"shoppable_post_id": 42, "display": "preview"}}


def frame(spark, docs):
    return spark.createDataFrame([(i, d if isinstance(d, str) else json.dumps(d))
                                  for i, d in enumerate(docs)], "doc_id long, value string")


def test_reasons(spark):
    docs = [
        GOOD,
        "{not json",
        {k: v for k, v in GOOD.items() if k != "type"},
        dict(GOOD, timestamp="2019-09-21 20:31:07"),
        dict(GOOD, properties={"display": "preview"}),
        {"type": "track", "event": "Assigned AB Test Shard", "timestamp": "2019-09-21T20:31:07.9Z"},
        {"type": "identify", "event": "Other", "timestamp": "2019-09-21T20:31:07.942123Z"},
    ]
    out = ing.ingest(frame(spark, docs), 123, keep=["doc_id"])
    got = dict(rows(out, "doc_id", "reason"))
    assert got == {0: None, 1: "invalid_json", 2: "missing_type_or_event", 3: "bad_timestamp",
                   4: "missing_post_id", 5: "missing_user_id", 6: None}
    ok = {r.doc_id: r for r in out.collect()}
    assert ok[0].topic == "trackViewedShoppableFit_00_raw_flatJSON" and ok[0].key == "42"
    assert ok[6].key == "0" and ok[6].topic == "identifyOther_00_raw_flatJSON"
    assert ok[0].segment_timestamp == 1569097867942 and ok[0].ingest_timestamp == 123
    assert ok[6].segment_timestamp == 1569097867942          # 6 digits truncate to ms


def test_fraction_digits(spark):
    docs = [dict(GOOD, timestamp=t) for t in
            ("2019-09-21T20:31:07.9Z", "2019-09-21T20:31:07.942Z", "2019-09-21T20:31:07.942999Z")]
    got = [r[0] for r in rows(ing.ingest(frame(spark, docs), 0, keep=["doc_id"]), "segment_timestamp")]
    assert got == [1569097867900, 1569097867942, 1569097867942]


def flat_of(spark, docs):
    out = ing.ingest(frame(spark, docs), 0, keep=["doc_id"])
    return {r.doc_id: json.loads(r.flat) for r in out.collect() if r.flat}


def test_flatten_nested_arrays_and_collisions(spark):
    docs = [dict(GOOD, context={"tags": ["a", "b", "c"], "deep": {"x": [1, [2, {"y": 3}]]}}),
            dict(GOOD, a_b=1, a={"b": 2}), dict(GOOD, a={"b": 2}, a_b=1),
            dict(GOOD, **{"e.f": 1, "K": 1, "k": 2, "empty": {}, "none": []})]
    got = flat_of(spark, docs)
    assert got[0]["context_tags_2"] == "c" and got[0]["context_deep_x_1_1_y"] == 3
    assert got[1]["a_b"] == 2 and got[2]["a_b"] == 1          # later in document order wins
    assert got[3]["e.f"] == 1 and (got[3]["K"], got[3]["k"]) == (1, 2)
    assert got[3]["empty"] == {} and got[3]["none"] == []


def test_numbers_keep_their_text(spark):
    raw = json.dumps(GOOD)[:-1] + ', "a": 9007199254740993, "b": 1.10, "c": 123456789012345678901234567890}'
    flat = ing.ingest(frame(spark, [raw]), 0, keep=["doc_id"]).first().flat
    assert '"a":9007199254740993' in flat and '"b":1.10' in flat
    assert '"c":123456789012345678901234567890' in flat


def test_bad_documents_never_stop_or_hide_others(spark):
    post = lambda v: dict(GOOD, properties={"shoppable_post_id": v})
    docs = [GOOD, "[1, 2]", "5", "null", post("42"), post("abc"), post(None), post([1]), post(7.0),
            '{"a": NaN}', "[" * 3000, dict(GOOD, type=5), dict(GOOD, x="\ud800"), "", post(10 ** 30)]
    out = {r.doc_id: r for r in ing.ingest(frame(spark, docs), 0, keep=["doc_id"]).collect()}
    assert [out[i].reason for i in range(len(docs))] == [
        None, "not_an_object", "not_an_object", "not_an_object", None, "bad_post_id",
        "missing_post_id", "missing_post_id", None, "invalid_json", "invalid_json",
        "missing_type_or_event", None, "invalid_json", None]
    assert out[4].key == "42" and out[8].key == "7" and out[14].key == "1" + "0" * 30
    dead = {r.doc_id: r.value for r in ing.dead_letters(
        ing.ingest(frame(spark, docs), 0, keep=["doc_id"]), keep=["doc_id"]).collect()}
    assert dead[1] == "[1, 2]" and dead[9] == '{"a": NaN}' and dead[5] == json.dumps(docs[5])


def test_null_value(spark):
    df = spark.createDataFrame([(1, None)], "doc_id long, value string")
    assert ing.ingest(df, 0).first().reason == "invalid_json"


def test_routed_click_scan(spark):
    docs = [GOOD, dict(GOOD, event="Created Story", properties={"shoppable_post_id": 7})]
    recs = ing.records(ing.ingest(frame(spark, docs), 99, keep=["doc_id"]))
    clicks = ing.scan_topic(recs, ing.CLICK_TOPIC, CLICK)
    assert rows(clicks, "properties_shoppable_post_id", "segment_timestamp", "ingest_timestamp",
                "properties_display") == [(42, 1569097867942, 99, "preview")]
    assert recs.filter("topic = 'trackCreatedStory_00_raw_flatJSON'").count() == 1


def test_string_post_id_is_read_by_the_scan(spark):
    recs = ing.records(ing.ingest(frame(spark, [dict(GOOD, properties={"shoppable_post_id": "42"})]), 9))
    assert ing.scan_topic(recs, ing.CLICK_TOPIC, CLICK).first()[0] == 42


def test_records_carry_stamps_once_and_every_field(spark):
    doc = dict(GOOD, extra={"z": 1}, segment_timestamp="old", ingest_timestamp=1)
    value = json.loads(ing.records(ing.ingest(frame(spark, [doc]), 99)).first().value)
    assert value["extra_z"] == 1 and value["ingest_timestamp"] == 99
    assert value["segment_timestamp"] == 1569097867942


def test_one_parse_per_document(spark):
    plan = ing.records(ing.ingest(frame(spark, [GOOD]), 0))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_post_ids_of_any_length_keep_their_value(spark):
    cases = (("0" * 5000 + "7", "7"), (" -000 ".strip(), "0"), ("+012", "12"), ("-07", "-7"),
             (" 7\n", "7"), ("0", "0"), ("9" * 6000, "9" * 6000), ("abc", None), ("1 2", None))
    docs = [dict(GOOD, properties={"shoppable_post_id": text}) for text, _ in cases]
    got = rows(ing.ingest(frame(spark, docs), 0, keep=["doc_id"]), "doc_id", "key")
    assert [key for _, key in sorted(got)] == [value for _, value in cases]


def test_number_post_ids(spark):
    cases = (("7.9", "7"), ("-0.5", "0"), ("7.9e0", "7"), ("1e22", "1" + "0" * 22), ("true", None),
             ("1e400", None), ("1152921504606846977", "1152921504606846977"), ("{}", None))
    docs = [json.dumps(dict(GOOD, properties={"shoppable_post_id": "?"})).replace('"?"', text)
            for text, _ in cases]
    got = rows(ing.ingest(frame(spark, docs), 0, keep=["doc_id"]), "doc_id", "key")
    assert [key for _, key in sorted(got)] == [value for _, value in cases]


def test_only_whole_documents_are_json(spark):
    good = json.dumps(GOOD)
    bad = [good + " x", good + "]", good + "}", good + ',{"#end":"1"}', good + "," + good, good + '],[1',
           "1,2", '1,"y":2', "1]", '1},{"v":1', "'a'", "{'a':1}", "NaN", '{"a":01}', '{"a":1,}', "", " ",
           "[" * 20_000, '{"a":"\t"}', "\ufeff" + good]
    deep = good[:-1] + ',"x":' + "[" * 20_000 + "]" * 20_000 + "}"
    fine = [" " + good + "\n", deep, good[:-1] + ',"q":{"a":1,"a":2},"type":"track"}']
    other = ["[" * 20_000 + "]" * 20_000, " null", '"s"', "-1.5e3", "[{}]"]
    out = {r.doc_id: r for r in ing.ingest(frame(spark, bad + fine + other), 0, keep=["doc_id"]).collect()}
    reasons = [out[i].reason for i in range(len(out))]
    assert reasons == ["invalid_json"] * len(bad) + [None] * len(fine) + ["not_an_object"] * len(other)
    flat = [json.loads(out[i].flat) for i in range(len(bad), len(bad) + len(fine))]
    assert flat[1]["x" + "_0" * 19_999] == [] and flat[1]["userId"] == "u1" and flat[2]["q_a"] == 2


def test_partly_flat_names(spark):
    docs = [dict({k: v for k, v in GOOD.items() if k != "properties"}, **more) for more in (
        {"properties_shoppable_post_id": 1}, {"properties_shoppable": {"post": {"id": "2"}}},
        {"properties": {"shoppable": {"post_id": 3}}}, {"properties": "s", "properties_shoppable_post": {"id": 4}},
        {"properties": {"shoppable_post_id": None}, "properties_shoppable_post_id": 5})]
    got = rows(ing.ingest(frame(spark, docs), 0, keep=["doc_id"]), "doc_id", "key")
    assert [key for _, key in sorted(got)] == ["1", "2", "3", "4", "5"]


def nested():
    leaf = st.one_of(st.none(), st.booleans(), st.integers(), st.floats(allow_nan=False, allow_infinity=False),
                     st.text(max_size=4))
    return st.dictionaries(st.text("ab_", max_size=2), st.recursive(
        leaf, lambda x: st.one_of(st.lists(x, max_size=3), st.dictionaries(st.text("ab_", max_size=2), x, max_size=3)),
        max_leaves=8), max_size=4)


@given(nested())
@settings(max_examples=300, deadline=None)
def test_deep_flatten_equals_flatten(doc):
    text = json.dumps(doc)
    want = ing.flatten_value(json.loads(text, parse_int=ing._Number, parse_float=ing._Number))
    got = ing.flatten_deep(text)
    assert list(got.items()) == list(want.items())


def test_declared_scan_of_documents_equals_the_routed_one(spark):
    docs = [GOOD, dict(GOOD, properties={"shoppable_post_id": "42", "display": 7}), dict(GOOD, properties={"shoppable_post_id": 1}, properties_display="x"),
            dict(GOOD, event="Created Story"), "[1]", dict(GOOD, timestamp="?")]
    ingested = ing.ingest(frame(spark, docs), 9, keep=["doc_id"])
    fields = [f.name for f in CLICK.fields]
    assert (rows(ing.scan_declared(ingested, ing.CLICK_TOPIC, CLICK), *fields)
            == rows(ing.scan_topic(ing.records(ingested), ing.CLICK_TOPIC, CLICK), *fields))
    both = ing.ingest(frame(spark, [dict(GOOD, properties_display="x")]), 9)     # most levels win
    assert ing.scan_declared(both, ing.CLICK_TOPIC, CLICK).first().properties_display == "preview"
