"""The jobs: runs over growing input, repeats, failures between steps, single years, and their queries against SQL."""

import glob
import json
import logging
import os
import re
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from jobs import common, page_intake, queries, season_tables
from millrace.sources import seed

SF = "/root/testdata/sf0.001"
REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
PAGES = "page_id long, url string, html string"


def page(words, extra=""):
    return f"{extra}<article><p>{'word ' * words}</p></article>"


def add_file(spark, folder, rows, at):
    """One more file of pages, as if written at the given second."""
    new = f"{folder}.part{at}"
    spark.createDataFrame(rows, PAGES).coalesce(1).write.parquet(new)
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, f"{at}.parquet")
    os.rename(glob.glob(f"{new}/part-*.parquet")[0], path)
    os.utime(path, (1_700_000_000 + at,) * 2)


FIRST = [
    (1, "https://a.example/1", page(50)), (2, "https://a.example/2", page(3)), (3, "https://b.example/3", None), (4, "https://namu.wiki/4", page(60)),
    (5, None, page(40)), (None, " ", page(40)), (None, None, None), (6, "https://b.example/6", page(30)), (6, "https://b.example/6", page(31)), (6, "https://b.example/6", page(31)),
]
SECOND = [
    (1, "https://a.example/1", page(1)),  # in vain: the earlier success stays
    (2, "https://a.example/2", page(70, '<meta property="og:image" content="https://i/x.png">')),  # collected at last
    (3, "https://b.example/3", page(2)),  # another failure: the later one stands
    (7, "https://c.example/7", page(80, '<time datetime="2024-05-01"></time>')),
]
THIRD = [(7, "https://c.example/7", page(90)), (1, "https://a.example/1", None)]


def state(spark, output, *drop):
    rows = page_intake.read_state(spark, output).drop("as_of_batch", "as_of_rows", "bucket", *drop).collect()
    return sorted((r.asDict() for r in rows), key=lambda r: r["address"])


def files(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


@pytest.fixture
def place(tmp_path):
    return str(tmp_path / "pages"), str(tmp_path / "out"), str(tmp_path / "check")


def test_intake_over_growing_input(spark, place):
    source, output, check = place
    add_file(spark, source, FIRST, 1)
    assert page_intake.run(spark, source, output, check) == {"taken": 10, "judged": 7}
    one = {r["address"]: r for r in state(spark, output)}
    assert {a: (r["flag"], r["n_attempts"]) for a, r in one.items()} == {
        "https://a.example/1": ("ok", 1), "https://a.example/2": ("empty_body", 1), "https://b.example/3": ("fetch_failed", 1), "https://namu.wiki/4": ("ok", 1), "page 5": ("ok", 1), "": ("ok", 2), "https://b.example/6": ("ok", 3),
    }
    assert one["https://namu.wiki/4"]["blocked"] and not one["page 5"]["blocked"] and one["page 5"]["url"] is None
    before = files(output)
    assert page_intake.run(spark, source, output, check) == {"taken": 0, "judged": 0} and files(output) == before  # nothing new: nothing written
    add_file(spark, source, SECOND, 2)
    got = page_intake.run(spark, source, output, check)
    two = {r["address"]: r for r in state(spark, output)}
    assert got["taken"] == 4 and set(two) == set(one) | {"https://c.example/7"}
    assert {a: (two[a]["flag"], two[a]["n_attempts"], two[a]["n_chars"]) for a in ("https://a.example/1", "https://a.example/2", "https://b.example/3")} == {
        "https://a.example/1": ("ok", 2, one["https://a.example/1"]["n_chars"]), "https://a.example/2": ("ok", 2, 349), "https://b.example/3": ("empty_body", 2, None),
    }
    assert two["https://a.example/2"]["poster_url"] == "https://i/x.png" and two["https://c.example/7"]["date_warning"].endswith("2024 != 요청 연도 2026")
    kept = {f for f in before if "/state/" in f} & set(files(output))
    assert len(kept) > 0 and all(files(output)[f] == before[f] for f in kept)  # buckets of other hosts aren't written again


def test_intake_is_the_same_however_files_come(spark, tmp_path):
    results = []
    for k, groups in enumerate(([[1, 2, 3]], [[1], [2], [3]], [[1, 2], [3]])):
        source, output, check = (str(tmp_path / f"{k}-{n}") for n in ("pages", "out", "check"))
        for group in groups:
            for at in group:
                add_file(spark, source, (FIRST, SECOND, THIRD)[at - 1], at)
            page_intake.run(spark, source, output, check, {"files": 1})
        results.append(state(spark, output))
    assert results[0] == results[1] == results[2] and len(results[0]) == 8
    last = {r["address"]: r for r in results[0]}
    assert (last["https://a.example/1"]["flag"], last["https://a.example/1"]["n_attempts"]) == ("ok", 3) and last["https://c.example/7"]["n_chars"] == 449


def test_the_larger_id_stands_whatever_the_times_of_files(spark, place):
    source, output, check = place
    add_file(spark, source, [(9, "https://a.example/1", page(50)), (8, "https://a.example/2", None), (3, "https://a.example/3", page(50))], 1)
    add_file(spark, source, [(4, "https://a.example/1", page(60)), (5, "https://a.example/2", page(2)), (3, "https://a.example/3", page(60))], 2)
    page_intake.run(spark, source, output, check)
    got = {r["address"][-1]: (r["page_id"], r["flag"], r["n_chars"], r["n_attempts"]) for r in state(spark, output)}
    assert got == {"1": (9, "ok", 249, 2), "2": (8, "fetch_failed", None, 2), "3": (3, "ok", 299, 2)}  # of one id the later file


def test_intake_is_made_good_after_failures(spark, place, monkeypatch):
    source, output, check = place
    add_file(spark, source, FIRST, 1)
    whole, refresh = common.write_partitions, page_intake.refresh_state

    def fails_after(df, path, *args, **counts):
        whole(df, path, *args, **counts)
        raise OSError("lost")

    monkeypatch.setattr(page_intake, "write_partitions", fails_after)  # the batch is written, and not committed
    with pytest.raises(Exception, match="lost"):
        page_intake.run(spark, source, output, check)
    monkeypatch.setattr(page_intake, "write_partitions", whole)
    monkeypatch.setattr(page_intake, "refresh_state", lambda *a: 1 / 0)  # the attempts are committed, and the state is not made
    with pytest.raises(ZeroDivisionError):
        page_intake.run(spark, source, output, check)
    assert state(spark, output) == []
    monkeypatch.setattr(page_intake, "refresh_state", refresh)
    assert page_intake.run(spark, source, output, check) == {"taken": 0, "judged": 7}
    assert {r["address"]: r["n_attempts"] for r in state(spark, output)}["https://a.example/1"] == 1  # no row twice
    again = state(spark, output)
    assert page_intake.run(spark, source, output, f"{check}-new")["taken"] == 10  # a lost checkpoint: all is taken again
    assert state(spark, output) == again


def test_intake_of_one_file_and_of_none(spark, place, caplog):
    source, output, check = place
    add_file(spark, source, FIRST, 1)
    with caplog.at_level(logging.INFO):
        assert page_intake.run(spark, f"{source}/1.parquet", output, check)["taken"] == 10
    said = "\n".join(caplog.messages)
    assert f"pages {source}/1.parquet" in said and "batch 0 written: rows 10" in said and "state written: buckets" in said
    spark.createDataFrame([], PAGES).write.parquet(f"{source}-none")
    assert page_intake.run(spark, f"{source}-none", f"{output}-none", f"{check}-none") == {"taken": 0, "judged": 0} and state(spark, f"{output}-none") == []


def paths():
    return {n: f"{SF}/{n}.parquet" for n in season_tables.INPUTS}


def tables_of(spark, output):
    got = season_tables.read_tables(spark, output)
    return sorted((repr(r) for r in got.select(*sorted(got.columns)).collect()))


@needs_tables
def test_season_tables_by_year(spark, tmp_path):
    whole, parts = str(tmp_path / "whole"), str(tmp_path / "parts")
    counts = season_tables.run(spark, paths(), whole)
    want = tables_of(spark, whole)
    years = [r[0] for r in season_tables.read_tables(spark, whole).select("year").distinct().orderBy("year").collect()]
    assert len(years) > 3 and counts["festivals"] == spark.read.parquet(paths()["orders"]).count()
    season_tables.run(spark, paths(), parts, {"years": years[:2]})
    assert tables_of(spark, parts) == [r for r in want if f"year={years[0]}" in r or f"year={years[1]}" in r]
    before = files(parts)
    season_tables.run(spark, paths(), parts, {"years": years[2:]})
    assert tables_of(spark, parts) == want and all(files(parts)[f] == t for f, t in before.items())  # other years are untouched
    season_tables.run(spark, paths(), parts, {"years": [years[0]]})  # again
    assert tables_of(spark, parts) == want
    fewer = str(tmp_path / "orders")
    spark.read.parquet(paths()["orders"]).where(F.year("o_orderdate") > years[1]).write.parquet(fewer)
    season_tables.run(spark, paths() | {"orders": fewer}, parts, {"years": [years[0], years[2]]})
    assert tables_of(spark, parts) == want  # nothing collected for a year: its tables stay
    season_tables.run(spark, paths() | {"orders": fewer}, parts)
    assert tables_of(spark, parts) == [r for r in want if f"year={years[0]}" not in r and f"year={years[1]}" not in r]


@needs_tables
def test_lines_stay_rows(spark):
    """No lists of an order's lines are made, and the mapping meets raw names that are counted already."""
    read = lambda n: spark.read.parquet(paths()[n])
    recs = season_tables.records(season_tables.of_years(read("orders"), None), season_tables.seed_rows(read("customer"), read("nation")))
    keys = season_tables.lineup.keyed(recs.where("flag = 'ok'")).select("rec_id", "import_key", "year")
    items = season_tables.performers(read("lineitem"), keys)
    plan = items._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "Window" in plan
    twice = spark.createDataFrame([("x", "X"), ("x", "X")], "artist_raw string, artist_canonical string")
    rows = spark.createDataFrame([(1, 1995, "x", "X", True), (1, 1995, "y", "X", True), (2, 1995, "x", "X", True), (2, 1995, "z", "z", True), (3, 1995, "", "", False), (3, 1996, "x", "X", True)], "rec_id long, year int, artist_raw string, artist_canonical string, revealed boolean")
    got = season_tables.artists(rows, twice)
    assert sorted(map(tuple, got.collect())) == [("X", 1, 1, 1, False, 1996), ("X", 2, 3, 2, False, 1995), ("z", 1, 1, 1, True, 1995)]
    assert "Expand" not in got._jdf.queryExecution().optimizedPlan().toString()


@needs_tables
def test_season_tables_read_one_year_only(spark):
    scan = season_tables.of_years(spark.read.parquet(paths()["orders"]), [1995, 1996])._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate,1995-01-01" in scan and "LessThan(o_orderdate,1" in scan


@needs_tables
def test_season_tables_guards_and_empty_input(spark, tmp_path):
    with pytest.raises(seed.SeedError, match="repeated keys"):
        season_tables.run(spark, paths(), str(tmp_path / "strict"), {"strict": True})
    with pytest.raises(ValueError, match="years"):
        season_tables.run(spark, paths(), str(tmp_path / "none"), {"years": []})
    assert not os.path.exists(tmp_path / "strict")
    empty = str(tmp_path / "orders")
    spark.read.parquet(paths()["orders"]).limit(0).write.parquet(empty)
    assert season_tables.run(spark, paths() | {"orders": empty}, str(tmp_path / "out")) == {"festivals": 0, "lineup": 0, "artists": 0}
    assert tables_of(spark, str(tmp_path / "out")) == []


def test_config(spark, tmp_path):
    (tmp_path / "c.json").write_text('{"years": [1995]}')
    assert common.read_config(spark, str(tmp_path / "c.json"), season_tables.SETTINGS) == {"years": [1995], "strict": False}
    (tmp_path / "c.json").write_text('{"yeers": [1995]}')
    with pytest.raises(ValueError, match="yeers"):
        common.read_config(spark, str(tmp_path / "c.json"), season_tables.SETTINGS)
    for name, known in (("page_intake", page_intake.SETTINGS), ("season_tables", season_tables.SETTINGS)):
        assert set(json.load(open(f"{REPO}/jobs/{name}.json"))) <= set(known)


@needs_tables
@pytest.mark.parametrize("job", ["page_intake", "season_tables"])
def test_command_lines(spark, tmp_path, job):
    out = str(tmp_path / "out")
    inputs = {"pages": f"{SF}/pages.parquet", "checkpoint": str(tmp_path / "check")} if job == "page_intake" else paths()
    args = [x for k, v in (inputs | {"output": out, "config": f"{REPO}/jobs/{job}.json"}).items() for x in (f"--{k}", v)]
    conf = "--master local[2] --conf spark.ui.enabled=false --conf spark.sql.shuffle.partitions=2 pyspark-shell"
    done = subprocess.run([sys.executable, "-m", f"jobs.{job}", *args], cwd=REPO, env=os.environ | {"PYSPARK_SUBMIT_ARGS": conf}, capture_output=True, text=True, timeout=200)
    assert done.returncode == 0, done.stderr[-2000:]
    assert f"{job} reading: " in done.stderr and "written: rows" in done.stderr
    got = page_intake.read_state(spark, out) if job == "page_intake" else season_tables.read_tables(spark, out)
    assert got.count() > 0


@needs_tables
@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_job_queries(spark, name):
    import duckdb

    import __spark_entry__

    assert name in __spark_entry__.queries() and name in __spark_entry__.oracle_sql()
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    changed = {k: v for k, v in spark.conf.getAll.items()}
    got = queries.QUERIES[name](spark, SF)
    assert {k: v for k, v in spark.conf.getAll.items()} == changed
    columns = sorted(got.columns)
    want = c.execute(f"SELECT {', '.join(chr(34) + x + chr(34) for x in columns)} FROM ({queries.ORACLES[name]})").fetchall()
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in got.select(*(f"`{x}`" for x in columns)).collect())


def test_jobs_stand_alone():
    for f in glob.glob(f"{REPO}/jobs/*.py"):
        assert not re.search(r"\bllm\b|corpus_pipeline", open(f).read())
