"""Whole runs where rows share a slug, requests that fail, stores, prompts, the server and its guards."""

import json
import shutil
import threading
import time
import urllib.error
import urllib.request

import pytest
from pyspark.sql import functions as F

from millrace import __main__ as cli
from millrace import jobs, server
from millrace.functions import text
from millrace.operators import attempts, crawl
from millrace.schemas import DOMAINS, EXTRACTION_FIELDS, LINEUP_FIELDS, RECORD, SEARCHES
from millrace.sources import provider, seed, tables, web
from tests.test_operators import GOOD, PAGE, Web, fake_get, fake_provider, fetcher, write_seed


def asked_once(tmp_path, answer):
    """A provider that notes each search in a file, as it runs in workers."""
    log = tmp_path / "asked.txt"

    def ask(prompt):
        if "candidates" in prompt:
            with open(log, "a") as f:
                f.write("search\n")
            return answer
        return fake_provider(prompt)

    return ask, log


@pytest.mark.parametrize("url", ["", "https://site/a"])
def test_two_campuses_of_one_university(spark, tmp_path, url):
    """Rows of one slug: one request and one stored record, a row of output for each, however often it runs."""
    base = write_seed(tmp_path, [f"A,north,r1,2026,{url},1,2", f"A,south,r2,2026,{url},3,4"])
    ask, log = asked_once(tmp_path, '{"candidates": []}')
    for _ in range(3):
        counts = crawl.run(spark, base, 2026, ask, fake_get)
        assert counts == ({"ok": 2} if url else {"no_candidate": 2})
        rows = (tmp_path / "2026" / "festivals.csv").read_text("utf-8-sig").splitlines()[1:]
        assert len(rows) == 2 and rows[0].startswith("A-north-2026-") and rows[1].startswith("A-south-2026-")
        assert spark.read.parquet(str(tmp_path / "records")).count() == 1
        assert len(log.read_text().splitlines() if log.exists() else []) == (0 if url else 1)
    assert sorted(p.name for p in tmp_path.iterdir() if p.is_dir()) == (["2026", "records"] if url else ["2026", "discovered", "records"])


def test_campuses_with_own_addresses(spark, tmp_path):
    """Two requests of one slug: the last one's record is kept, and the other is asked again."""
    base = write_seed(tmp_path, ["A,north,r,2026,https://site/a,1,2", "A,south,r,2026,https://dead/b,3,4", "A,west,r,2026,https://site/c,5,6"])
    ask, log = asked_once(tmp_path, '{"candidates": []}')
    assert crawl.run(spark, base, 2026, ask, fake_get) == {"ok": 2, "fetch_failed": 1}
    kept = spark.read.parquet(str(tmp_path / "records")).collect()
    assert [(r.slug, r.seed_url) for r in kept] == [("A", "https://site/c")] and len(log.read_text().splitlines()) == 1
    assert crawl.run(spark, base, 2026, ask, fake_get) == {"ok": 2, "fetch_failed": 1}


class OneClock:
    """A clock in a file, for all workers: sleeping moves it on, and each request is noted with its time."""

    def __init__(self, folder):
        self.now, self.log = f"{folder}/now", f"{folder}/requests"

    def read(self):
        return float(open(self.now).read())

    def sleep(self, s):
        later = self.read() + s
        with open(self.now, "w") as f:
            f.write(repr(later))

    def get(self, url):
        with open(self.log, "a") as f:
            f.write(f"{self.read()} {url}\n")
        if url.endswith("robots.txt"):
            if "open" in url:
                raise OSError("404")
            return b"User-agent: *\nDisallow: /no", None
        return ("<article>" + "word " * 40 + "</article>").encode(), None

    def fetcher(self, get):
        return web.Fetcher(get, self.read, self.sleep)


def test_pauses_and_robots_last_through_rounds(spark, tmp_path):
    clock = OneClock(str(tmp_path))
    (tmp_path / "now").write_text("1000.0")
    urls = lambda *names: spark.createDataFrame([(n,) for n in names], "url string").coalesce(1)
    rounds = []
    for names in (("https://h/a", "https://h/b", "https://open/c"), ("https://h/d", "https://h/no", "https://open/e"), ("https://h/f", "https://new/g")):
        got = web.fetch_pages(urls(*names), clock.get, web.seen_hosts(*rounds) if rounds else None, clock.fetcher)
        got.coalesce(1).write.parquet(str(tmp_path / f"round{len(rounds)}"))
        rounds.append(spark.read.parquet(str(tmp_path / f"round{len(rounds)}")))
    rows = {r.url: r for x in rounds for r in x.collect()}
    assert {u: r.status for u, r in rows.items() if "no" not in u} == {u: "ok" for u in rows if "no" not in u} and rows["https://h/no"].error == "robots"
    asked = [x.split() for x in (tmp_path / "requests").read_text().splitlines()]
    assert sorted(u for _, u in asked if u.endswith("robots.txt")) == ["https://h/robots.txt", "https://new/robots.txt", "https://open/robots.txt"]  # once each
    for site in ("https://h/", "https://open/"):
        times = sorted(float(t) for t, u in asked if u.startswith(site) and not u.endswith("robots.txt"))
        assert len(times) == (4 if site == "https://h/" else 2) and all(b - a >= web.PAUSE for a, b in zip(times, times[1:]))
    last = {r.site: r.asked_at for r in web.seen_hosts(*rounds).collect()}
    assert set(last) == {"h", "open", "new"} and last["h"] == max(float(t) for t, u in asked if u.startswith("https://h/"))


def test_bad_addresses_fail_alone(spark, tmp_path):
    base = write_seed(tmp_path, ["A,c,r,2026,notaurl,1,2", "B,c,r,2026,http://[bad/x,1,2", "D,c,r,2026,https://site/a,1,2"])
    ask = lambda p: '{"candidates": []}' if "candidates" in p else fake_provider(p.replace("'D'", "'A'"))
    counts = crawl.run(spark, base, 2026, ask, lambda u: fake_get(u) if u.startswith("https://") else web.http_get(u))
    assert counts.get("fetch_failed") == 2 and sum(counts.values()) == 3
    import http.client

    f = fetcher(Web({"https://h/a": http.client.IncompleteRead(b""), "https://h/b": ValueError("odd")}))
    assert f.page("https://h/a", "https://h/a")["status"] == f.page("https://h/b", "https://h/b")["status"] == "fetch_failed"
    assert f.text("http://[bad/x") is None and f.page("http://[bad/x", "http://[bad/x")["status"] == "fetch_failed"


KEYED = "k int, v string"


def stored(spark, path):
    return sorted(map(tuple, tables.read_store(spark, path, KEYED).collect()), key=repr)


def test_store_updates_touched_buckets_only(spark, tmp_path):
    path = str(tmp_path / "t")
    put = lambda rows, **more: tables.update_store(spark, path, KEYED, ("k",), spark.createDataFrame(rows, KEYED), **more)
    assert stored(spark, path) == []
    put([])
    assert stored(spark, path) == [] and not (tmp_path / "t").exists()
    put([(i, "a") for i in range(100)] + [(None, "null")])
    before = {f: f.stat().st_mtime_ns for f in (tmp_path / "t").rglob("part-*.parquet")}
    assert len(before) == tables.STORE_BUCKETS
    put([(7, "b"), (None, "new")])
    want = sorted([(i, "b" if i == 7 else "a") for i in range(100)] + [(None, "new")], key=repr)
    after = {f: f.stat().st_mtime_ns for f in (tmp_path / "t").rglob("part-*.parquet")}
    assert stored(spark, path) == want and len(set(before.items()) - set(after.items())) in (1, 2)
    tables.update_store(spark, path, KEYED, ("k",), tables.read_store(spark, path, KEYED).where("k < 2").withColumn("v", F.lit("own")), gone=spark.createDataFrame([(7,), (8,), (1000,)], "k int"))  # reads what it writes
    assert stored(spark, path) == sorted([(k, "own" if k in (0, 1) else v) for k, v in want if k not in (7, 8)], key=repr)
    for _ in range(2):
        tables.update_store(spark, path, KEYED, ("k",), gone=tables.read_store(spark, path, KEYED).select("k"))  # also the last row of a bucket goes
        assert stored(spark, path) == []
    put([(7, "back")])
    assert stored(spark, path) == [(7, "back")] and [p.name for p in tmp_path.iterdir()] == ["t"]


def test_store_survives_lost_updates(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    put = lambda df: tables.update_store(spark, path, KEYED, ("k",), df)
    put(spark.createDataFrame([(i, "a") for i in range(50)], KEYED))
    with pytest.raises(Exception):  # noqa: B017
        put(spark.createDataFrame([(1, "b")], KEYED).withColumn("v", F.raise_error(F.lit("lost")).cast("string")))
    assert stored(spark, path) == sorted(((i, "a") for i in range(50)), key=repr)  # before the update was whole: nothing has changed
    finish, calls = tables._finish_update, []
    monkeypatch.setattr(tables, "_finish_update", lambda *a: calls.append(1) or (finish(*a) if len(calls) == 1 else 1 / 0))
    with pytest.raises(ZeroDivisionError):
        put(spark.createDataFrame([(i, "b") for i in range(40, 60)], KEYED))
    monkeypatch.setattr(tables, "_finish_update", finish)
    bucket = spark.range(1).select(F.pmod(F.xxhash64(F.lit(45)), F.lit(tables.STORE_BUCKETS))).first()[0]
    shutil.rmtree(tmp_path / "t" / f"bucket={bucket}")  # stopped while it was taken in
    assert stored(spark, path) == sorted(((i, "b" if i >= 40 else "a") for i in range(60)), key=repr)
    assert not (tmp_path / "t.update").exists()


def test_clear_cache(spark, tmp_path):
    row = spark.createDataFrame([("A", 2026), ("A", 2025), ("B", 2026)], "slug string, year int")
    empty = spark.createDataFrame([], RECORD)
    full = row.select(*(F.col(c) if c in ("slug", "year") else F.lit(None).cast(empty.schema[c].dataType).alias(c) for c in empty.columns))
    tables.update_store(spark, str(tmp_path / "records"), RECORD, crawl.STORE_KEYS, full)
    tables.update_store(spark, str(tmp_path / "discovered"), SEARCHES, crawl.STORE_KEYS, row.select("slug", "year", F.lit(None).cast("string").alias("season"), F.array(F.lit("u")).alias("candidates")))
    left = lambda name: sorted((r.slug, r.year) for r in tables.read_store(spark, str(tmp_path / name), {"records": RECORD, "discovered": SEARCHES}[name]).collect())
    for _ in range(2):
        crawl.clear_cache(spark, str(tmp_path), 2026, "A")
        assert left("records") == [("A", 2025), ("B", 2026)] and len(left("discovered")) == 3
    crawl.clear_cache(spark, str(tmp_path), 2026, "A", rediscover=True)
    assert left("discovered") == [("A", 2025), ("B", 2026)]
    crawl.clear_cache(spark, str(tmp_path / "none"), 2026, "A", True)


def test_guards(spark, tmp_path):
    with pytest.raises(seed.SeedError, match="there are: universities-2025.csv"):
        (tmp_path / "universities-2025.csv").write_text("x")
        seed.load_seed(spark, str(tmp_path), 2026)
    base = write_seed(tmp_path, ["A,c,r,2026,,1,2"])
    (tmp_path / "festivals.csv").write_text("x")
    with pytest.raises(crawl.OldLayout):
        crawl.run(spark, base, 2026, fake_provider, fake_get)


def test_prompt_names_all_fields_and_values(spark):
    prompt = spark.range(1).select(attempts.extraction_prompt(F.lit("A"), F.lit(2026), F.array(F.lit("handle1")), F.lit("body"))).first()[0]
    for name, _ in (*EXTRACTION_FIELDS, *LINEUP_FIELDS):
        assert f"- {name}" in prompt
    for values in DOMAINS.values():
        assert all(f'"{v}"' in prompt for v in values)
    assert "- university_name* (" in prompt and "handle1" in prompt and "{" not in prompt.replace("{ ", "")
    got = provider.parse_answer(GOOD, "extraction")
    assert set(got) == {n for n, _ in EXTRACTION_FIELDS}
    with pytest.raises(ValueError):
        provider.parse_answer('{"found": true, "university_name": "A", "lineup": [{"day": 1}]}', "extraction")


def test_search_has_tools_and_time(tmp_path):
    c = provider.CommandLine(("python", "-c", "import sys, json; print(json.dumps({'result': '|'.join(sys.argv[1:])}))"))
    assert c("q") == "q" and c.for_search("--tools", "web")("q") == "--tools|web|q"
    assert (c.timeout, c.for_search().timeout, provider.NAMING_TIMEOUT) == (120, 300, 900)
    a = cli.arguments(["serve", "--year", "2026", "--base", "b", "--search-tools", "web", "--provider", "cmd", "x"])
    assert cli.command(a, "crawl")[1:] == ["-m", "millrace", "crawl", "--year", "2026", "--base", "b", "--search-tools", "web", "--provider", "cmd", "x"]
    assert "--year" not in cli.command(a, "enrich")
    with pytest.raises(SystemExit):
        cli.arguments(["crawl", "--provider", "x"])


def test_retries_add_errors():
    p = provider.Recorded({"q": ["bad", "{}", GOOD]})
    assert provider.ask(p, "q", "extraction", tries=3)["found"]
    assert p.asked[2].startswith(p.asked[1]) and len(p.asked[2]) > len(p.asked[1]) > len(p.asked[0])


def test_decode():
    words = "가나다 축제"
    head = '<meta charset="{}">'
    for data, charset in (
        (words.encode(), None), (words.encode("cp949"), None), (words.encode("cp949"), "euc-kr"), (b"\xef\xbb\xbf" + words.encode(), None), (words.encode("utf-16"), None), ((head.format("euc-kr") + words).encode("cp949"), None),
        (words.encode(), "no-such-charset"), (('<?xml version="1.0" encoding="euc-kr"?>' + words).encode("cp949"), None),
    ):
        assert web.decode(data, charset).endswith(words), (data, charset)
    assert web.decode((head.format("shift_jis") + "日本語テスト").encode("cp932"), None).endswith("日本語テスト")
    assert "café" in web.decode((head.format("iso-8859-1") + "café!").encode("latin-1"), None)
    assert web.decode(b"ok \xff", "utf-8") == "ok �"


def test_percent_decode_around_a_bad_escape(spark):
    got = spark.createDataFrame([("%EA%B0%80/%zz%2",), ("100%",), ("a+b%20c",), ("x",), (None,)], "c string").select(text.percent_decode(F.col("c"))).collect()
    assert [r[0] for r in got] == ["가/%zz%2", "100%", "a+b c", "x", None]


def call(url, body=None, kind="application/json"):
    request = urllib.request.Request(url, data=body, headers={"Content-Type": kind} if body is not None else {})
    try:
        with urllib.request.urlopen(request, timeout=20) as r:
            return r.status, r.read().decode()
    except urllib.error.HTTPError as e:
        return e.code, e.read().decode()


def test_server():
    import sys

    cleared, state = [], {"broken": False}

    def data():
        if state["broken"]:
            raise tables.CsvUnreadable("festivals.csv")
        return {"festivals": [{"name": "가"}], "lineup": [], "artists": []}

    s = server.make_server(data, lambda: {"A"}, lambda job: [sys.executable, "-c", f"import time; print('{job}'); time.sleep(1)"], lambda slug, again: cleared.append((slug, again)))
    threading.Thread(target=s.serve_forever, daemon=True).start()
    at = f"http://127.0.0.1:{s.server_address[1]}"
    try:
        assert call(f"{at}/")[0] == 200 and json.loads(call(f"{at}/api/data")[1])["festivals"] == [{"name": "가"}]
        state["broken"] = True
        assert call(f"{at}/api/data")[0] == 503 and call(f"{at}/nowhere")[0] == 404
        assert call(f"{at}/api/log?from=x")[0] == 400 and call(f"{at}/api/log")[0] == 200
        run = lambda value, **k: call(f"{at}/api/run", json.dumps(value).encode() if not isinstance(value, bytes) else value, **k)[0]
        assert run({"job": "crawl"}, kind="text/plain") == run({"job": "crawl"}, kind="application/x-www-form-urlencoded") == 400
        assert [run(b"{"), run([1]), run({"job": "rm"}), run({"job": "crawl", "university": "../A"}), run({"job": "enrich", "university": "A"})] == [400] * 5
        assert cleared == [] and call(f"{at}/api/else", b"{}")[0] == 404
        assert run({"job": "crawl", "university": "A", "rediscover": True}, kind="application/json; charset=utf-8") == 200
        assert run({"job": "enrich"}) == 409 and cleared == [("A", True)]
        for _ in range(50):
            log = json.loads(call(f"{at}/api/log?from=0")[1])
            if not log["running"]:
                break
            time.sleep(0.1)
        assert log["lines"] == ["crawl"] and log["returncode"] == 0
        assert run({"job": "crawl", "university": "A"}) == 200 and cleared[-1] == ("A", False)
    finally:
        s.shutdown()
        s.server_close()
    assert [jobs.from_index(q) for q in ("", "from=", "from=7", "a=1&from=3", "from=x")] == [0, 0, 7, 3, None]


def test_serve_reads_the_reviewed_tables(spark, tmp_path):
    base = write_seed(tmp_path, ["A,c,r,2026,https://site/a,1,2"])
    crawl.run(spark, base, 2026, fake_provider, fake_get)
    s = cli.serve(spark, cli.arguments(["serve", "--year", "2026", "--base", base, "--port", "0", "--provider", "x"]))
    threading.Thread(target=s.serve_forever, daemon=True).start()
    try:
        got = json.loads(call(f"http://127.0.0.1:{s.server_address[1]}/api/data")[1])
        assert [f["cache_slug"] for f in got["festivals"]] == ["A"] and len(got["lineup"]) == 2 and got["artists"] == []
    finally:
        s.shutdown()
        s.server_close()
    assert PAGE
