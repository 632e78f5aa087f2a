"""Tables: seed, sitemaps, waterfall, cache, line-ups, festivals, names, review, files."""

import json

import pytest
from pyspark.sql import functions as F

from millrace import streaming
from millrace.functions.strict_json import strict_json
from millrace.operators import attempts, cache, candidates, crawl, enrich, festivals, lineup, names, review
from millrace.schemas import ATTEMPT, FESTIVAL_COLUMNS, LINEUP_COLUMNS, RECORD
from millrace.sources import mapping, provider, seed, sitemap, tables, web

HEAD = "university,campus,region,year,url,latitude,longitude"


def write_seed(folder, lines, head=HEAD, year=2026):
    path = folder / f"universities-{year}.csv"
    path.write_bytes(b"\xef\xbb\xbf" + "\r\n".join([head, *lines, ""]).encode())
    return str(folder)


def test_seed(spark, tmp_path):
    base = write_seed(tmp_path, ['" A ",c,r,2026,,37.50,"127"', "B,c,r,2026, https://x ,,"])
    got = seed.load_seed(spark, base, 2026).orderBy("seed_pos").collect()
    assert [(r.university, r.url, r.latitude, r.longitude, r.season) for r in got] == [("A", None, "37.50", "127", None), ("B", "https://x", "", "", None)]
    assert seed.load_seed(spark, base, 2026, 1).count() == 1 and seed.load_seed(spark, base, 2026, 0).count() == 2


@pytest.mark.parametrize(
    ("head", "lines", "text"),
    [
        ("university,campus,region,year,url", ["A,c,r,2026,"], "lacks"), (HEAD, ["A,c,r,2025,,,"], "year"), (HEAD, ["A,c,r,x,,,"], "year"), (HEAD, ["A,c,r,2026,,,"] * 2, "repeated"),
        (HEAD + ",season", ["A,c,r,2026,,,,winter"], "unknown"), (HEAD + ",season", ["A,c,r,2026,,,,spring", "A,d,r,2026,,,,"], "some rows"), (HEAD + ",season", ["A,c,r,2026,,,,fall"] * 2, "repeated"),
    ],
)
def test_seed_guards(spark, tmp_path, head, lines, text):
    with pytest.raises(seed.SeedError, match=text):
        seed.load_seed(spark, write_seed(tmp_path, lines, head), 2026)


def test_seed_of_two_seasons_and_campuses(spark, tmp_path):
    base = write_seed(tmp_path, ["A,c,r,2026,,,,spring", "A,c,r,2026,,,,fall", "B,c,r,2026,,,,", "B,d,r,2026,,,,"], HEAD + ",season")
    assert seed.load_seed(spark, base, 2026).count() == 4


def test_sitemaps(spark):
    xml = "<urlset><loc> https://t/entry/2026-%EC%84%9C%EC%9A%B8%EB%8C%80+x\n</loc><loc>https://t/category/2026-서울대</loc><loc>https://t/entry/서울대-2025</loc><loc>https://m.google.com/entry/2026서울대</loc><loc>https://t/entry/2026-서울대</loc><loc>https://t/entry"
    maps = spark.createDataFrame([(0, None), (1, xml), (2, "<loc>https://s/entry/서울대 2026</loc>")], "source_pos int, xml string")
    rows = spark.createDataFrame([(7, "서울대", 2026), (8, "연세대", 2026)], "seed_pos int, university string, year int")
    got = sitemap.sitemap_candidates(rows, sitemap.sitemap_entries(maps)).orderBy("rank").collect()
    assert [(r.seed_pos, r["rank"], r.url) for r in got] == [(7, 1, "https://t/entry/2026-서울대+x"), (7, 2, "https://t/entry/2026-서울대"), (7, 3, "https://s/entry/서울대 2026")]


def test_sitemap_in_parts(spark):
    """Places are counted through the parts of a sitemap, also through one without entries; other sitemaps count their own."""
    loc = lambda *names: "".join(f"<loc>{n}</loc>" for n in names)
    parts = [(0, 20, loc("/entry/c", "/entry/d")), (0, 3, loc("/entry/a", "/x", "/entry/b")), (0, 7, ""), (0, 9, None), (1, 3, loc("/entry/e")), (2, 0, None)]
    got = sitemap.sitemap_entries(spark.createDataFrame(parts, "source_pos int, part int, xml string")).select("source_pos", "loc_pos", "url").collect()
    assert sorted(map(tuple, got)) == [(0, 0, "/entry/a"), (0, 2, "/entry/b"), (0, 3, "/entry/c"), (0, 4, "/entry/d"), (1, 0, "/entry/e")]


def test_waterfall_truth_table(spark):
    """Every final state: (manual flag, sitemap ok rank, search answered, search ok rank) to (flag, discovery, url, cached)."""
    cases = [
        ("ok", 1, True, 1, ("ok", "manual", "seed", True)), ("mismatch", 2, True, 1, ("ok", "sitemap", "s1-2", True)), (None, 1, True, None, ("ok", "sitemap", "s1-1", True)),
        ("fetch_failed", None, True, 3, ("ok", "search", "s2-3", True)), (None, 4, True, None, ("no_candidate", "", None, True)), ("mismatch", None, True, None, ("mismatch", "", "seed", True)),
        ("fetch_failed", None, True, 4, ("fetch_failed", "", "seed", False)), ("extract_failed", None, True, None, ("extract_failed", "", "seed", False)), ("mismatch", None, False, None, ("mismatch", "", "seed", False)),
        (None, None, True, None, ("no_candidate", "", None, True)), (None, None, False, None, ("no_source", "", None, False)),
    ]
    rows = spark.createDataFrame([(i, "seed" if c[0] else None) for i, c in enumerate(cases)], "seed_pos int, url string")
    tried = [(i, 0, 1, "seed", c[0]) for i, c in enumerate(cases) if c[0]]
    for i, c in enumerate(cases):
        tried += [(i, s, k, f"s{s}-{k}", "ok" if c[s * 2 - 1] == k else "mismatch") for s in (1, 2) for k in range(1, 5) if s == 1 or c[2]]
    search = spark.createDataFrame([(i, c[2]) for i, c in enumerate(cases)], "seed_pos int, answered boolean")
    got = candidates.waterfall(rows, spark.createDataFrame(tried, "seed_pos int, source int, rank int, url string, flag string"), search).orderBy("seed_pos").collect()
    assert [tuple(r)[1:] for r in got] == [c[4] for c in cases]


def test_live_waterfall_pays_no_more_than_needed(spark):
    rows = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "seed_pos int, url string")
    paid, asked = [], []

    def found(source, want):
        def of(left):
            asked.append((source, sorted(r.seed_pos for r in left.collect())))
            return left.select("seed_pos", F.lit(source).alias("source"), F.explode(F.array(*(F.lit(k) for k in range(1, want + 1)))).alias("rank"), F.lit("u").alias("url"))

        return of

    ok = {(0, 0, 1), (1, 1, 2)}

    def attempt(c):
        batch = [(r.seed_pos, r.source, r["rank"], r.url) for r in c.collect()]
        paid.extend(x[:3] for x in batch)
        return spark.createDataFrame([(*x, "ok" if x[:3] in ok else "mismatch") for x in batch], "seed_pos int, source int, rank int, url string, flag string")

    done = candidates.live_waterfall(rows, [found(0, 1), found(1, 4), found(2, 1)], attempt, lambda df: df)
    assert asked == [(0, [0, 1, 2]), (1, [1, 2]), (2, [2])]
    assert sorted(paid) == [(0, 0, 1), (1, 0, 1), (1, 1, 1), (1, 1, 2), (2, 0, 1), (2, 1, 1), (2, 1, 2), (2, 1, 3), (2, 2, 1)] and done.count() == 9


def record(**values):
    base = {"slug": "A", "schema_version": 4, "university": "A", "campus": "old", "region": "old", "year": 2026, "latitude": "1", "longitude": "2", "seed_url": "u", "url": "u", "discovery": "manual", "flag": "ok", "poster_image_url": None, "image_urls": [], "extraction": None, "published_at": None, "date_warning": None}
    return tuple((base | values).values())


def test_cache_probe(spark):
    cases = [({}, True, False), ({"schema_version": None}, False, True), ({"schema_version": 3, "flag": "mismatch"}, False, False), ({"seed_url": "v"}, False, False), ({"seed_url": None}, False, False), ({"flag": "fetch_failed"}, True, False)]
    for values, hit, stale in cases:
        rows = spark.createDataFrame([("A", 2026, "u")], "slug string, year int, url string")
        got = cache.probe(rows, spark.createDataFrame([record(**values)], RECORD)).first()
        assert (got.hit, got.stale) == (hit, stale), values
    none = cache.probe(spark.createDataFrame([("A", 2026, None)], "slug string, year int, url string"), spark.createDataFrame([record(seed_url=None)], RECORD)).first()
    assert none.hit
    assert not cache.probe(spark.createDataFrame([("B", 2026, None)], "slug string, year int, url string"), spark.createDataFrame([record()], RECORD)).first().hit


SEED_ROW = "university string, campus string, region string, year int, url string, latitude string, longitude string, season string, seed_pos int"
JUDGED = "seed_pos int, source int, rank int, url string, " + ATTEMPT


def extraction(name="A", start="2026-05-20", items=()):
    return {"found": True, "university_name": name, "year": 2026, "festival_name": "F", "start_date": start, "hashtags": ["x", "y"], "instagram_handle": "h", "admission_raw": "가" * 300, "lineup": [{"artist_raw": a, "day": d, "is_secret": s} for a, d, s in items]}


def test_records_and_outputs(spark):
    rows = spark.createDataFrame([("A", "c", "r", 2026, "ua", "1", "2", None, 0), ("B", "c", "r", 2026, "ub", "1", "2", "fall", 1), ("C", "c", "r", 2026, None, "1", "2", None, 2), ("D", "new", "r", 2026, "ud", "9", "9", None, 3)], SEED_ROW)
    items = [("IU & 10CM", 1, False), ("", 1, True), ("Zion.T (feat. X, Y)", None, False), ("밴드", 1, False)]
    tried = [
        (0, 0, 1, "ua", "ok", "p", ["i1", "i2"], extraction("A", items=items), None, "w"), (1, 0, 1, "ub", "mismatch", None, [], extraction("Z", items=items), None, None),
        (1, 1, 1, "s", "fetch_failed", None, [], None, None, None), (3, 0, 1, "ud", "fetch_failed", None, [], None, None, None),
    ]
    old = spark.createDataFrame([record(slug="D", university="D", schema_version=3, seed_url="ud", url="ud", extraction=extraction("D"))], RECORD)
    search = spark.createDataFrame([(0, True), (1, True), (2, False), (3, True)], "seed_pos int, answered boolean")
    got = crawl.records(rows, spark.createDataFrame(tried, JUDGED), search, old)
    by = {r.seed_pos: r for r in got.collect()}
    assert [by[i].flag for i in range(4)] == ["ok", "mismatch", "no_source", "ok"]
    assert by[3].restored and by[3].campus == "new" and by[3].latitude == "9" and by[1].extraction.university_name == "Z"
    assert sorted(r.slug for r in cache.to_write(got).collect()) == ["A", "B-fall"]

    table = {r.host_name: r for r in festivals.build_festivals(got).collect()}
    assert list(table["A"].asDict()) == FESTIVAL_COLUMNS and len(table) == 4
    assert table["A"].import_key == "A-c-2026-05" and table["C"].import_key == "C-c-2026-00" and table["C"].flag == "NO_SOURCE"
    assert (table["A"].image_urls, table["A"].hashtags, len(table["A"].admission_raw), table["A"].instagram_url) == ("i1|i2", "x|y", 200, "https://www.instagram.com/h/")

    m = spark.createDataFrame([("10CM", "십센치"), ("", "never")], "artist_raw string, artist_canonical string")
    acts = lineup.build_lineup(got.withColumn("rec_id", F.col("seed_pos")), m).orderBy("rec_id", "item_pos", "split_pos").collect()
    assert [(r.day, r.order, r.artist_raw, r.artist_canonical, r.revealed) for r in acts] == [(1, 1, "IU", "IU", True), (1, 2, "10CM", "십센치", True), (1, 3, "", "", False), (None, 1, "Zion.T (feat. X, Y)", "Zion.T (feat. X, Y)", True), (1, 4, "밴드", "밴드", True)]


def test_split_joint(spark):
    rows = spark.createDataFrame([(0, "A & B&C & "), (1, " & "), (2, "A"), (3, "A& B")], "i int, x string")
    assert [r[1] for r in rows.select("i", lineup.split_joint(F.col("x"))).orderBy("i").collect()] == [["A", "B&C"], [" & "], ["A"], ["A& B"]]


def test_lineup_refresh(spark):
    rows = spark.createDataFrame([("k", "1", "1", "a", "old", "true"), ("k", "1", "2", "", "", "false"), ("k", "1", "3", "z", "zz", "true")], ", ".join(f"`{c}` string" for c in LINEUP_COLUMNS))
    m = spark.createDataFrame([("a", "A"), ("", "never")], "artist_raw string, artist_canonical string")
    assert [r.artist_canonical for r in lineup.refreshed(rows, m).orderBy("order").collect()] == ["A", "", "z"]


def test_names(spark):
    m = spark.createDataFrame([("a", "A"), ("b", "B")], "artist_raw string, artist_canonical string")
    asked = spark.createDataFrame([("b",), ("c",)], "artist_raw string")
    answer = spark.createDataFrame([("b", "B2"), ("c", "C"), ("unasked", "U")], "artist_raw string, artist_canonical string")
    assert {tuple(r) for r in names.merged_mapping(m, answer, asked).collect()} == {("a", "A"), ("b", "B2"), ("c", "C")}
    old = spark.createDataFrame([("X", "img", 0), ("Y", "", 1)], "name string, image_url string, pos int")
    found = spark.createDataFrame([("Z", 0), ("X", 1), ("Z", 2), ("W", 3)], "name string, pos int")
    assert [tuple(r) for r in names.merge_artists(old, found).orderBy("pos").collect()] == [("X", "img", 0), ("Y", "", 1), ("Z", "", 2), ("W", "", 5)]
    legacy = spark.createDataFrame([("십센치", "10CM", "", "band", "10cm;  ;십센치;10CM", "false", 0), ("N", None, None, "", None, "true", 1)], "name_canonical string, name_en string, real_name string, category string, aliases string, needs_review string, pos int")
    got = names.migrate_artists(legacy, spark.createDataFrame([("십센치", "BAND")], "name string, genre string")).orderBy("pos").collect()
    assert [(r.name, r.other_names, r.genre) for r in got] == [("십센치", "10CM|10cm", "BAND"), ("N", "", "")]


def test_review(spark):
    rows = spark.createDataFrame([("U", "c", 2026, "fall", 1), ("U", "c", 2026, "spring", 0)], "university string, campus string, year int, season string, seed_pos int")
    f = spark.createDataFrame([("U-c-2026-05", "U", "OK", "MANUAL"), ("V-c-2026-05", "V", "MISMATCH", "SEARCH"), ("", "W", "NO_SOURCE", "")], "import_key string, host_name string, flag string, discovery string")
    assert {r.host_name: r.cache_slug for r in review.with_slugs(f, review.slug_map(rows)).collect()} == {"U": "U-spring", "V": "V", "W": "W"}
    assert [review.visible(f, v).count() for v in ("problem", "search", "all")] == [2, 1, 3]
    acts = spark.createDataFrame([("U-c-2026-05", "a"), ("", "b")], "import_key string, artist_raw string")
    assert review.details(f, acts).count() == 1
    a = spark.createDataFrame([("x", False, 0), ("y", True, 1), ("z", False, 2), ("w", True, 3)], "name string, needs_review boolean, pos int")
    assert [r.name for r in review.sorted_artists(a).collect()] == ["y", "w", "x", "z"]


def test_csv_files(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t.csv")
    rows = spark.createDataFrame([(1, "=a", 'q"\n,'), (0, None, "한글")], "n int, x string, y string")
    tables.export_csv(rows, path, ["x", "y"], ["n"])
    data = open(path, "rb").read()
    assert data == '﻿x,y\r\n,한글\r\n\'=a,"q""\n,"\r\n'.encode()
    assert [(r.x, r.y) for r in tables.read_table(spark, path, ["x", "y"]).orderBy("pos").collect()] == [("", "한글"), ("'=a", 'q"\n,')]
    assert tables.read_table(spark, str(tmp_path / "none.csv"), ["x"]).count() == 0
    monkeypatch.setattr("millrace.sources.files.Files.replace", lambda *a: (_ for _ in ()).throw(OSError("full")))
    with pytest.raises(OSError):
        tables.export_csv(rows.limit(1), path, ["x", "y"], ["n"])
    with pytest.raises(Exception):  # noqa: B017
        tables.export_csv(rows.withColumn("x", F.raise_error(F.lit("lost")).cast("string")), path, ["x", "y"], ["n"])
    assert open(path, "rb").read() == data and [p.name for p in tmp_path.iterdir()] == ["t.csv"]
    (tmp_path / "bad.csv").write_bytes(b"x\n\xff\xfe\n")
    with pytest.raises(tables.CsvUnreadable):
        tables.read_table(spark, str(tmp_path / "bad.csv"), ["x"])


def test_csv_is_what_the_csv_module_writes(spark, tmp_path):
    """Byte by byte, over many ranges, with cells of all kinds."""
    import csv
    import io
    import random

    rng = random.Random(5)
    cell = lambda: rng.choice([None, "", "plain", "a,b", 'q"q', "\r", "\n", "=1", "+x", "-", "@y", ' "', "한글", "'", ";", "\t"]) if rng.random() < 0.8 else "".join(rng.choices('ab,"\n\r=', k=5))
    rows = [(i, cell(), cell(), rng.random() < 0.5) for i in range(500)]
    path = str(tmp_path / "sub" / "t.csv")
    tables.export_csv(spark.createDataFrame(rows, "n int, x string, y string, z boolean").repartition(7), path, ["x", "y", "z", "n"], ["n"])
    guarded = lambda v: "" if v is None else ("'" + v if v[:1] in ("=", "+", "-", "@") else v)
    want = io.StringIO()
    w = csv.writer(want, lineterminator="\r\n")
    w.writerow(["x", "y", "z", "n"])
    w.writerows([guarded(x), guarded(y), str(z).lower(), str(n)] for n, x, y, z in rows)
    assert open(path, "rb").read() == b"\xef\xbb\xbf" + want.getvalue().encode() and [p.name for p in (tmp_path / "sub").iterdir()] == ["t.csv"]


def test_mapping_files(tmp_path):
    path = str(tmp_path / "m.json")
    assert mapping.load_mapping(path) == {}
    mapping.save_mapping(path, {"b": "1", "a": "2"})
    assert list(json.load(open(path))) == ["a", "b"] and mapping.load_mapping(path) == {"a": "2", "b": "1"}
    for bad in ("[1]", "{", '{"a": 1}'):
        (tmp_path / "m.json").write_text(bad)
        with pytest.raises(mapping.MappingError):
            mapping.load_mapping(path)


GOOD = '{"found": true, "university_name": "A", "year": 2026, "start_date": "2026-05-20", "lineup": []}'


def test_strict_json(spark):
    cases = [(f"```json\n{GOOD}\n```", None), ('{"found": true}', "missing"), (GOOD.replace("2026,", '"2026",', 1), None), (GOOD.replace("[]", "null"), "list_type"), (GOOD[:-1] + ', "ticket_type": "X"}', "literal_error"), ("no", "no JSON object in the answer"), (None, "no JSON object in the answer")]
    rows = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, raw string")
    got = [r.a for r in rows.select("i", strict_json(F.col("raw")).alias("a")).orderBy("i").collect()]
    assert [g.error for g in got] == [c[1] for c in cases] and got[0].value.year == 2026 and got[2].value.year == 2026 and got[1].value is None


def test_ask_again_only_for_bad_answers():
    p = provider.Recorded({"q": ["bad", GOOD]})
    assert provider.ask(p, "q", "extraction")["found"] and len(p.asked) == 2 and p.asked[1].startswith("q\n\n")
    twice = provider.Recorded({"q": ["bad", "bad", GOOD]})
    with pytest.raises(ValueError):
        provider.ask(twice, "q", "extraction")
    none = provider.Recorded({})
    with pytest.raises(provider.ProviderError):
        provider.ask(none, "q", "extraction")
    assert len(none.asked) == 1


def test_attempts(spark):
    rows = spark.createDataFrame([(0, "ok", "b", "2025-01-01", "A", 2026, None), (1, "fetch_failed", None, None, "A", 2026, None), (2, "ok", "b", None, "Z", 2026, None), (3, "ok", "b", None, "broken", 2026, None)], "seed_pos int, status string, body string, published_at string, university string, year int, season string")
    asked = rows.withColumn("prompt", attempts.extraction_prompt(F.col("university"), F.col("year"), F.array(), F.col("body")))
    assert "'A' 2026년" in asked.first().prompt and asked.first().prompt.endswith("글:\nb")
    p = provider.Recorded({"'A'": [GOOD], "'Z'": [GOOD]})
    got = {r.seed_pos: r for r in attempts.judged(attempts.extracted(asked, p)).collect()}
    assert [got[i].flag for i in range(4)] == ["ok", "fetch_failed", "mismatch", "extract_failed"]
    assert got[0].date_warning and "body" not in got[0].asDict()
    text = spark.range(1).select(attempts.discovery_prompt(F.lit("A"), F.lit(2026), F.lit("fall"))).first()[0]
    assert "2026년 가을" in text


def test_first_valid(spark):
    rows = spark.createDataFrame([("k", 1, "bad"), ("k", 2, "good"), ("j", 1, "bad"), ("j", 3, "good")], "k string, attempt int, v string")
    assert [tuple(r) for r in attempts.first_valid(rows, "k", F.col("v") == "good").collect()] == [("k", 2, "good")]


class Web:
    def __init__(self, answers):
        self.answers, self.asked, self.now = answers, [], 0.0

    def get(self, url):
        self.asked.append((url, self.now))
        x = self.answers.get(url, OSError("404"))
        if isinstance(x, list):
            x = x.pop(0)
        if isinstance(x, Exception):
            raise x
        return x

    def sleep(self, s):
        self.now += s


def fetcher(w):
    return web.Fetcher(w.get, lambda: w.now, w.sleep)


def test_fetcher():
    page = ("<article>" + "가나다라마바사 " * 30 + "</article>").encode()
    w = Web({"https://h/robots.txt": (b"User-agent: *\nDisallow: /no", None), "https://h/a": [OSError("500"), (page, None)], "https://h/b": (b"<p>x</p>", None), "https://k/c": (page.decode().encode("cp949"), None)})
    f = fetcher(w)
    assert f.page("https://h/a", "https://h/a")["status"] == "ok"
    times = [t for u, t in w.asked if u == "https://h/a"]
    assert times[1] - times[0] == web.PAUSE
    assert f.page("https://h/b", "https://h/b")["status"] == "empty_body"
    assert f.page("https://h/no/x", "https://h/no/x")["error"] == "robots" and not any("/no/" in u for u, _ in w.asked)
    assert f.page("https://k/c", "https://k/c")["body"].startswith("가나다") and f.page("https://k/none", "https://k/none")["status"] == "fetch_failed"
    assert f.text("https://k/none") is None and f.text("https://h/b") == "<p>x</p>"
    assert sum(u == "https://h/robots.txt" for u, _ in w.asked) == 1


def test_enrich(spark, tmp_path):
    year = tmp_path / "2026"
    year.mkdir()
    acts = spark.createDataFrame([("k", "1", "1", "IU", "IU", "true", 0), ("k", "1", "2", "", "", "false", 1)], ", ".join(f"`{c}` string" for c in LINEUP_COLUMNS) + ", pos int")
    tables.export_csv(acts, str(year / "lineup.csv"), LINEUP_COLUMNS, ["pos"])
    recs = spark.createDataFrame([("ok", extraction(items=[("IU", 1, False), ("secret", 1, True)])), ("mismatch", extraction(items=[("no", 1, False)]))], "flag string, " + [x for x in RECORD.split(", ") if x.startswith("extraction ")][0])
    p = provider.Recorded({"IU": ['{"mapping": {"IU": "아이유", "other": "x"}, "artists": [{"name": "아이유", "other_names": ["IU"], "genre": null, "needs_review": true}]}']})
    assert enrich.enrich(spark, str(tmp_path), recs, p) == {"names": 1, "new": 1, "to_review": 1, "with_genre": 0}
    assert mapping.load_mapping(str(tmp_path / "artist_mapping.json")) == {"IU": "아이유"}
    assert "아이유" in (year / "lineup.csv").read_text("utf-8-sig") and "아이유,IU,,,true" in (tmp_path / "artists.csv").read_text("utf-8-sig")
    assert enrich.enrich(spark, str(tmp_path), recs, p)["new"] == 0 and len(p.asked) == 1
    (year / "lineup.csv").write_text("other,header\n")
    with pytest.raises(tables.CsvUnreadable):
        enrich.enrich(spark, str(tmp_path), recs.withColumn("flag", F.lit("ok")), p)
    assert len(p.asked) == 1  # checked before any call
    assert enrich.classify_genres(p, []) == {}


def test_legacy_artists_are_migrated(spark, tmp_path):
    from millrace.schemas import LEGACY_ARTIST_COLUMNS

    path = str(tmp_path / "artists.csv")
    old = spark.createDataFrame([("십센치", "10CM", "", "band", "a;b", "false", 0), ("N", "", "", "", "", "true", 1)], ", ".join(f"{c} string" for c in LEGACY_ARTIST_COLUMNS) + ", pos int")
    tables.export_csv(old, path, LEGACY_ARTIST_COLUMNS, ["pos"])
    p = provider.Recorded({"십센치": ['{"genres": {"십센치": "BAND", "N": null}}']})
    got = enrich.load_artists(spark, path, p).orderBy("pos").collect()
    assert [(r.name, r.other_names, r.genre, r.image_url, r.needs_review) for r in got] == [("십센치", "10CM|a|b", "BAND", "", "false"), ("N", "", "", "", "true")]
    assert len(p.asked) == 1
    (tmp_path / "artists.csv").write_text("name,genre\n")
    with pytest.raises(tables.CsvUnreadable):
        enrich.load_artists(spark, path, p)


def test_offset(spark):
    rows = spark.createDataFrame([(i, "x") for i in range(5)], "pos int, line string")
    assert streaming.from_offset(rows, 3).count() == 2
    with pytest.raises(ValueError):
        streaming.from_offset(rows, -1)


PAGE = "<article>" + "축제 안내 글 " * 40 + "</article>"


def fake_get(url):
    if url.endswith("robots.txt") or "dead" in url:
        raise OSError("404")
    return PAGE.encode(), "utf-8"


def fake_provider(prompt):
    if "candidates" in prompt:
        if "'C'" in prompt:
            raise provider.ProviderError("no answer")
        return '{"candidates": [{"url": "https://youtube.com/x"}, {"url": "https://found/1"}]}'
    name = "B" if "'B'" in prompt else "A"
    return json.dumps({"found": True, "university_name": name, "year": 2026, "start_date": "2026-05-01", "lineup": [{"artist_raw": "X & Y", "day": 1}]})


def test_a_whole_run(spark, tmp_path):
    base = write_seed(tmp_path, ["A,c,r,2026,https://site/a,1,2", "B,c,r,2026,https://dead/b,1,2", "C,c,r,2026,,1,2", "D,c,r,2026,https://dead/d,1,2"])
    save = mapping.save_mapping
    save(str(tmp_path / "artist_mapping.json"), {"Y": "와이"})
    maps = spark.createDataFrame([(0, "<loc>https://map/entry/B-2026</loc>")], "source_pos int, xml string")
    counts = crawl.run(spark, base, 2026, fake_provider, fake_get, maps)
    assert counts == {"ok": 2, "no_source": 1, "fetch_failed": 1}
    festivals_csv = (tmp_path / "2026" / "festivals.csv").read_text("utf-8-sig").splitlines()
    flags = [line.split(",")[-2] for line in festivals_csv[1:]]
    assert flags == ["OK", "OK", "NO_SOURCE", "FETCH_FAILED"] and "SITEMAP" in festivals_csv[2]
    acts = (tmp_path / "2026" / "lineup.csv").read_text("utf-8-sig").splitlines()
    assert acts[1:] == ["A-c-2026-05,1,1,X,X,true", "A-c-2026-05,1,2,Y,와이,true", "B-c-2026-05,1,1,X,X,true", "B-c-2026-05,1,2,Y,와이,true"]
    cached = spark.read.parquet(str(tmp_path / "records"))
    assert sorted(r.slug for r in cached.collect()) == ["A", "B"]
    assert sorted((r.slug, tuple(r.candidates)) for r in spark.read.parquet(str(tmp_path / "discovered")).collect()) == [("D", ("https://found/1",))]

    def silent(prompt):
        raise provider.ProviderError("no call is needed for cached rows")

    again = crawl.run(spark, base, 2026, silent, fake_get, maps, limit=2)
    assert again == {"ok": 2}
    shown = review.load_review(spark, base, 2026, seed.load_seed(spark, base, 2026))
    assert shown["festivals"].count() == 2 and shown["lineup"].count() == 4 and shown["artists"].count() == 0
    (tmp_path / "raw").mkdir()
    with pytest.raises(crawl.OldLayout):
        crawl.run(spark, base, 2026, silent, fake_get)


def test_jobs():
    import sys

    from millrace import jobs

    j = jobs.Job()
    assert j.start([sys.executable, "-c", "import time; print('a'); print('b'); time.sleep(1)"]) and not j.start(["true"])
    j.process.wait()
    j.pump.join()
    assert j.snapshot(1) == {"lines": ["b"], "next": 2, "running": False, "returncode": 0}
    assert [jobs.offset(x) for x in ("3", "-1", "x", None, "")] == [3, 0, 0, 0, 0]
    cleared = []
    ask = lambda job, u=None, running=False, ok=True: jobs.handle_run(job, u, ["A"], running, lambda: ok, cleared.append)[0]
    assert [ask("x"), ask("enrich", "A"), ask("crawl", "../B"), ask("crawl", "A", True), ask("crawl", "A", False, False), ask("crawl", "A"), ask("enrich")] == [400, 400, 400, 409, 409, 200, 200]
    assert cleared == ["A", "A"]
