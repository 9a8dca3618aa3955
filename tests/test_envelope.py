import json

from lines import T0, frame

from topicflow.operators import envelope, parse


def raw(**changes):
    body = {
        "id_str": "1", "timestamp_ms": str(T0), "text": "t", "coordinates": {"coordinates": [1, 2]},
        "entities": {"hashtags": [{"text": "a", "indices": [0, 1]}], "user_mentions": [{"screen_name": "b"}]},
        "user": {"id_str": "9", "screen_name": "nine", "location": "here"},
        "place": {"place_type": "city", "name": "X", "country_code": "US", "full_name": "X, US"},
    }
    body.update(changes)
    return json.dumps({k: v for k, v in body.items() if v is not ...})


def made(spark, text):
    rows = envelope.to_envelopes(frame(spark, [text])).collect()
    return json.loads(rows[0].value) if rows else None


def tags(spark, hashtags):
    return made(spark, raw(entities={"hashtags": hashtags, "user_mentions": []}))["entities"]["hashtags"]


def test_envelope(spark):
    e = made(spark, raw())
    assert e["entities"] == {"hashtags": ["a"], "user_mentions": ["b"]}
    assert e["coordinates"] == [1.0, 2.0]
    assert e["user"] == {"id_str": "9", "screen_name": "nine", "location": "here"}
    assert e["place"]["full_name"] == "X, US"


def test_malformed_elements_are_skipped_alone(spark):
    assert tags(spark, [{"text": "a"}, "raw", {"text": "c"}]) == ["a", "c"]
    assert tags(spark, [{"text": "a"}, {"id": 1}]) == ["a"]
    assert tags(spark, [None, {"text": "c"}]) == ["c"]
    assert tags(spark, {"text": "a"}) == []
    assert tags(spark, []) == []


def test_absent_parts(spark):
    assert made(spark, raw(coordinates=None))["coordinates"] == []
    assert made(spark, raw(coordinates="x"))["coordinates"] == []
    assert made(spark, raw(entities=...))["entities"] == {"hashtags": [], "user_mentions": []}
    assert made(spark, raw(text=None))["text"] is None
    assert made(spark, raw(text=...)) is None
    assert made(spark, '{"limit": {"track": 5}}') is None
    assert made(spark, "junk") is None


def test_a_null_text_survives_both_steps(spark):
    lines = envelope.to_envelopes(frame(spark, [raw(text=None)]))
    assert parse.parse_lines(lines).first().verdict == "ok"


def test_tsv_has_twelve_columns(spark):
    def cells(text):
        return envelope.to_tsv(frame(spark, [text])).first().value.split("\t")

    assert cells(raw()) == ["1", str(T0), "[1.0,2.0]", "a", "b", "9", "here", "city", "X", "US", "X, US", "t"]
    bare = cells(raw(user=..., place=..., coordinates=None, entities=...))
    assert bare == ["1", str(T0)] + [""] * 9 + ["t"]
    mixed = cells(raw(entities={"hashtags": [{"text": "a"}, "raw", {"id": 1}], "user_mentions": []}))
    assert mixed[3] == 'a,raw,{"id":1}'
    assert envelope.to_tsv(frame(spark, ["{}"])).count() == 0
