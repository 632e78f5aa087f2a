"""Strict reading of answers as expressions against the models of answers."""

import json
import random

from pyspark.sql import functions as F

from millrace.functions.strict_json import strict_json
from millrace.schemas import EXTRACTION_FIELDS, TICKETS
from millrace.sources.provider import parse_answer

RAW = [
    "1", "0", "2", "-1", "true", "false", "null", "1.0", "1.5", "0.0", "0.5", "1e3", "1.5e1", "-0", "-0.0", '"1"', '" 1 "', '"+1"', '"-1"', '"1_0"', '"1__0"', '"_1"', '"1."', '"1.0"', '"1.00"', '"1.5"', '"1e3"', '"０１"', '""', '"007"',
    '"0x1"', '"1 0"', "[]", "{}", '"1_0.0"', '"\\u00a01"', '"1\\n"', '"+ 1"', '".0"', '"true"', '"True"', '"YES"', '"Y"', '"on"', '"oN"', '" true"', '"off"', '"f"', '"no"', '"2"', '"x"', '["a"]', '["a", 1]', "[null]", '[["a"]]', '{"a": 1}',
    f'"{TICKETS[0]}"', f'"{TICKETS[0].lower()}"', '"ALLOWED"', '"NONE"', '"\\u0000"', '"\\ud83d\\ude00"', '"\\ud800"', '"\\ude00\\ud83d"', '"\\\\ud800"', '"a\\\\\\ud83d"', '[{"artist_raw": "A"}]', '[{"artist_raw": "A", "day": "2", "is_secret": "yes", "x": 1}, {"artist_raw": "B", "day": null}]',
    '[{"day": 1}]', '[{"artist_raw": null}]', '[{"artist_raw": "A", "is_secret": null}]', '[{"artist_raw": "A"}, 3]', '[{"artist_raw": "A", "day": 1.5}]', "[3, {}]",
]
WHOLE = [
    "", "no object", "{", "}{", "{}", '{"found": true}', '{"university_name": "U"}', '{"found": true, "university_name": "U",}', '{"found": true, "university_name": "U"} {}', '{"found": true, "university_name": "U"}x}', '{"found": true, "university_name": "U"},{}',
    "{'found': true}", '{/*c*/"found": true, "university_name": "U"}', '{"found": true, "university_name": "U\t"}', '{"found": true, "university_name": "U\n"}', '{"found": 01, "university_name": "U"}', '{"Found": true, "university_name": "U"}', None,
    'Here: ```json\n{"found": true, "university_name": "U", "extra": {"deep": [1, {"x": null}]}}\n``` done', '{"found": true, "university_name": "U", "a.b": 1, "$": 2}', '{"found": true, "university_name": "\\x"}', '{"found": true, "university_name": "U"', '{"found": true "university_name": "U"}',
]


def model(raw):
    try:
        return parse_answer(raw, "extraction"), None
    except ValueError as e:
        return None, e.errors()[0]["type"] if hasattr(e, "errors") else str(e)


def test_agrees_with_the_models(spark):
    names = [n for n, _ in EXTRACTION_FIELDS]
    rng = random.Random(3)
    rows = list(WHOLE)
    for name in names:
        for raw in RAW:
            have = {"found": "true", "university_name": '"U"', name: raw}
            rows.append("{" + ", ".join(f"{json.dumps(k)}: {v}" for k, v in have.items()) + "}")
    for _ in range(500):  # several fields at once: the first error by the order of fields counts
        have = {n: rng.choice(RAW) for n in rng.sample(names, rng.randint(1, 6))}
        have = {"found": "true", "university_name": '"U"'} | have if rng.random() < 0.8 else have
        rows.append("{" + ", ".join(f"{json.dumps(k)}: {v}" for k, v in sorted(have.items(), key=lambda x: rng.random())) + "}")
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, raw string").select("i", strict_json(F.col("raw")).alias("a"))
    got = {r.i: r.a for r in df.collect()}
    good = 0
    for i, raw in enumerate(rows):
        value, error = model(raw)
        assert got[i].error == error, raw
        assert (got[i].value.asDict(True) if got[i].value else None) == value, raw
        good += value is not None
    assert good > 300 and len(rows) - good > 800
    assert "Python" not in df._jdf.queryExecution().toString()


def test_what_differs_is_an_error(spark):
    rows = ['"found": true, "found": false', '"found": true, "year": 99999999999', '"found": true, "year": "99999999999"', '"found": true, "year": NaN', '"found": true, "year": 1E400', '"found": true, "festival_name": -1E400']
    df = spark.createDataFrame([("{" + r + ', "university_name": "U"}',) for r in rows], "raw string").select(strict_json(F.col("raw")).alias("a")).collect()
    assert [r.a.error for r in df] == ["json_invalid", "int_parsing_size", "int_parsing_size", "json_invalid", "int_parsing", "string_type"] and all(r.a.value is None for r in df)
