"""The naming run: new names are asked for once, the mapping, the lineups and the artists table follow."""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession

from millrace.operators.attempts import known_names_block
from millrace.operators.lineup import refreshed
from millrace.operators.names import merge_artists, migrate_artists, new_names, raw_names
from millrace.schemas import ARTIST_COLUMNS, LEGACY_ARTIST_COLUMNS, LINEUP_COLUMNS
from millrace.sources.mapping import load_mapping, mapping_frame, save_mapping
from millrace.sources.provider import Provider, ask, parse_answer
from millrace.sources.tables import CsvUnreadable, export_csv, read_table, year_dirs

NAMING_TASK = """다음 표기들을 정식 활동명으로 정리해 JSON 객체 하나로만 답하세요.
mapping에는 모든 표기를 열쇠로 넣고, 확실하지 않으면 원문을 그대로 쓰고 needs_review를 true로 합니다.
artists의 항목은 name, other_names, genre(HIPHOP, BALLAD_RNB, DANCE, BAND 또는 null), needs_review입니다.
{known}
표기:
{names}"""


def classify_genres(provider: Provider, names: list[str]) -> dict[str, str | None]:
    """Genres of names in one call without a second try; no call for no names."""
    if not names:
        return {}
    prompt = "다음 가수들의 genre를 HIPHOP, BALLAD_RNB, DANCE, BAND 또는 null로 JSON {\"genres\": {이름: genre}} 로만 답하세요.\n" + "\n".join(names)
    return parse_answer(provider(prompt), "genres")["genres"]


def load_artists(spark: SparkSession, path: str, provider: Provider) -> DataFrame:
    """The artists table; one with exactly the legacy header is migrated, with genres from one call."""
    try:
        return read_table(spark, path, ARTIST_COLUMNS)
    except CsvUnreadable:
        legacy = read_table(spark, path, LEGACY_ARTIST_COLUMNS)
    names = [r[0] for r in legacy.select("name_canonical").orderBy("pos").collect()]  # a table that people review
    genres = spark.createDataFrame(list(classify_genres(provider, names).items()), "name string, genre string")
    return migrate_artists(legacy, genres)


def enrich(spark: SparkSession, base: str, records: DataFrame, provider: Provider) -> dict[str, int]:
    """Returns counts. Every lineup's header is checked before any call is paid for; the mapping only takes names that were asked for."""
    names = raw_names(records)
    if names.isEmpty():
        return {"names": 0, "new": 0}
    lineups = {y: os.path.join(base, str(y), "lineup.csv") for y in year_dirs(base)}
    for path in lineups.values():
        read_table(spark, path, LINEUP_COLUMNS)
    artists_path = os.path.join(base, "artists.csv")
    artists = load_artists(spark, artists_path, provider)
    path = os.path.join(base, "artist_mapping.json")
    mapping = load_mapping(path)
    fresh = sorted(r[0] for r in new_names(names, mapping_frame(spark, mapping)).collect())  # names of performers, a bounded human list
    answer = {"mapping": {}, "artists": []}
    if fresh:
        prompt = NAMING_TASK.replace("{known}", known_names_block(mapping_frame(spark, mapping))).replace("{names}", "\n".join(fresh))
        answer = ask(provider, prompt, "names")
        mapping |= {k: v for k, v in answer["mapping"].items() if k in set(fresh)}
        save_mapping(path, mapping)
    frame = mapping_frame(spark, mapping)
    for file in lineups.values():
        if os.path.exists(file):
            export_csv(refreshed(read_table(spark, file, LINEUP_COLUMNS), frame), file, LINEUP_COLUMNS, ["pos"])
    rows = [(a["name"], "|".join(a["other_names"]), a["genre"] or "", "", json.dumps(a["needs_review"]), k) for k, a in enumerate(answer["artists"])]
    found = spark.createDataFrame(rows, "name string, other_names string, genre string, image_url string, needs_review string, pos int")
    export_csv(merge_artists(artists, found), artists_path, ARTIST_COLUMNS, ["pos"])
    return {"names": names.count(), "new": len(fresh), "to_review": sum(a["needs_review"] for a in answer["artists"]), "with_genre": sum(a["genre"] is not None for a in answer["artists"])}
