"""Hand-made envelope lines."""

import json

T0 = 1442469035685  # 2015-09-17 05:50:35.685 UTC


def message(**changes):
    body = {
        "id_str": "1", "timestamp_ms": str(T0), "text": "t", "coordinates": [1, 2],
        "entities": {"hashtags": ["a"], "user_mentions": ["b"]},
        "user": {"id_str": "9", "screen_name": "nine"},
        "place": {"name": "X", "country_code": "US"},
    }
    body.update(changes)
    return {k: v for k, v in body.items() if v is not ...}


def line(**changes):
    return json.dumps(message(**changes))


def at(ms, *tags, country="US", city="X", **changes):
    return line(timestamp_ms=str(ms), entities={"hashtags": list(tags), "user_mentions": []},
                place={"name": city, "country_code": country}, **changes)


def frame(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")
