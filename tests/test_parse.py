import pytest
from lines import T0, frame, line

from topicflow.operators import parse

FULL = line()

VERDICTS = {
    FULL: "ok",
    "not json": "malformed",
    FULL[:-1]: "malformed",
    "": "malformed",
    "5": "malformed",
    "null": "malformed",
    f"[{FULL}]": "malformed",
    f"{FULL} x": "malformed",
    f"{FULL} {FULL}": "malformed",
    f"{FULL},{FULL}": "malformed",
    f"{FULL}]": "malformed",
    f"{FULL}],[{FULL}": "malformed",
    f"{FULL},null]": "malformed",
    f"{FULL},null],[{FULL}": "malformed",
    f'{FULL},{{"timestamp_ms":"1"}}],[{FULL}': "malformed",
    FULL.replace('"', "'"): "malformed",
    f"  {FULL} ": "ok",
    "{}": "missing_key",
    line(text=...): "missing_key",
    line(id_str=...): "missing_key",
    line(timestamp_ms=...): "missing_key",
    line(text=None): "ok",
    line(id_str=None): "ok",
    line(user="bob"): "no_user",
    line(user=...): "no_user",
    line(user={"screen_name": "x"}): "no_user",
    line(place=...): "no_place",
    line(place=None): "no_place",
    line(place={"name": "X"}): "no_place",
    line(timestamp_ms=T0): "ok",
    line(timestamp_ms="abc"): "bad_timestamp",
    line(timestamp_ms=None): "bad_timestamp",
    line(timestamp_ms="9" * 18): "bad_timestamp",
    line(timestamp_ms=str(-(10 ** 17))): "bad_timestamp",
    line(coordinates=None): "ok",
    line(coordinates=...): "ok",
    line(entities=...): "ok",
    line(entities="x"): "ok",
    FULL.replace("[1, 2]", "[NaN, 2]"): "ok",
    FULL.replace('"id_str": "1"', '"id_str": "0", "id_str": "1"'): "ok",
}


def test_every_line_gets_its_verdict(spark):
    parsed = parse.parse_lines(frame(spark, VERDICTS)).select("value", "verdict").collect()
    assert {r.value: r.verdict for r in parsed} == VERDICTS
    assert len(parsed) == len(VERDICTS)


def test_null_line_is_malformed(spark):
    assert parse.parse_lines(frame(spark, [None])).first().verdict == "malformed"


def test_message_fields(spark):
    def first(text):
        return parse.parse_messages(frame(spark, [text])).first()

    m = first(FULL)
    assert (m.t_id, m.u_id, m.user_name, m.coords, m.tags) == ("1", "9", "nine", [1.0, 2.0], ["a", "b"])
    assert (m.city, m.country, m.time_ms, m.text) == ("X", "US", T0, "t")
    assert (m.dayslot, m.hourslot, m.minuteslot) == (20150917, 2015091705, 201509170550)
    assert first(line(user={"id_str": "9"})).user_name == "9"
    assert first(line(coordinates=None)).coords == []
    assert first(line(entities={"hashtags": None, "user_mentions": ["b"]})).tags == ["b"]
    assert first(line(entities={"hashtags": [5, None], "user_mentions": []})).tags == ["5"]
    assert first(line(entities={"hashtags": ["x", "x"], "user_mentions": ["x"]})).tags == ["x", "x", "x"]
    dup = first(FULL.replace('"id_str": "1"', '"id_str": "0", "id_str": "1"'))
    assert dup.t_id == "1"


def test_rejects_keep_the_line_and_the_reason(spark):
    rows = parse.rejects(parse.parse_lines(frame(spark, [FULL, "not json"]))).collect()
    assert [(r.value, r.reason) for r in rows] == [("not json", "malformed")]


def test_errors_can_fail_the_run(spark):
    parsed = parse.refuse_errors(parse.parse_lines(frame(spark, [FULL, "not json"])))
    with pytest.raises(Exception, match="malformed message line"):
        parse.messages(parsed).collect()
    assert parse.messages(parse.refuse_errors(parse.parse_lines(frame(spark, [FULL])))).count() == 1


def test_only_fields_of_messages_are_decoded(spark):
    plan = parse.parse_messages(frame(spark, [FULL]))._jdf.queryExecution().executedPlan().toString()
    assert "screen_name" in plan and "full_name" not in plan and "location" not in plan


def test_the_json_is_read_once_and_without_python(spark, tmp_path):
    path = str(tmp_path / "lines")
    frame(spark, [FULL]).write.text(path)
    messages = parse.parse_messages(spark.read.text(path))
    plan = messages.where("country = 'US' and size(tags) > 0")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1
    assert "Python" not in plan
