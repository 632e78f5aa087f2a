"""Extraction attempts: prompt, answer, strict parse, verification, flag."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.judge import date_warning, verify
from millrace.functions.text import season_word
from millrace.operators.candidates import attempts_flag
from millrace.operators.names import canonical_names
from millrace.schemas import DOMAINS, EXTRACTION, EXTRACTION_FIELDS, REQUIRED_FIELDS, struct
from millrace.sources.provider import Provider, ProviderError, ask

EXTRACTION_TASK = """아래 글에서 '{university}' {year}년 축제 정보를 뽑아 JSON 객체 하나로만 답하세요.
글에 없는 값은 null로 두고 지어내지 마세요. 필드와 형식은 다음과 같고, *가 붙은 것은 반드시 있어야 합니다.
{fields}
계정 후보: {handles}

글:
{body}"""


#: What each field of an answer is to hold.
HINTS = {
    "found": "글이 그 대학 그 해의 축제를 다루면 true, 다른 대학이나 다른 해면 false",
    "university_name": "글에 나온 주최 대학의 이름. 글에 없으면 빈 문자열이고, 물음에 적힌 이름을 베끼지 않음",
    "year": "글에 나온 개최 연도. 물음에 적힌 해를 베끼지 않음",
    "festival_name": "대학 이름을 뺀 축제 이름",
    "start_date": "첫날, YYYY-MM-DD",
    "end_date": "마지막 날, YYYY-MM-DD. 하루짜리면 첫날과 같음",
    "venue_name": "열리는 곳",
    "description": "글의 사실만으로 쓴 두세 문장",
    "hashtags": "글에 적힌 해시태그, # 없이",
    "external_visitor_policy": "외부인이 들어갈 수 있는지: 가능, 조건부, 불가의 순서",
    "verification_method": "입장할 때 확인하는 것: 없음, 학생증, 예매, 초대, 그 밖의 순서",
    "ticket_type": "무료인지 유료인지의 순서",
    "ticket_open_at": "예매가 열리는 때, YYYY-MM-DDTHH:MM:SS",
    "admission_raw": "입장과 표에 대한 글의 문장 그대로",
    "instagram_handle": "축제나 총학생회의 공식 계정임이 분명한 것. 계정 후보에 있는 것만",
    "lineup": "초청된 출연자만. 재학생 공연, 사회자, 내빈은 빼고, 알 수 없으면 넣음",
    "artist_raw": "글의 표기 그대로",
    "day": "1부터 센 몇째 날. 하루짜리면 1",
    "is_secret": "아직 밝히지 않은 출연자면 true",
}
_FORMS = {"boolean": "true/false", "int": "정수", "string": "문자열", "array<string>": "문자열의 목록"}


def fields_block(fields: tuple = EXTRACTION_FIELDS, indent: str = "") -> str:
    """A line a field, of list items too: name, form, values of closed domains, and what it holds."""
    out = []
    for name, kind in fields:
        form = " | ".join(f'"{v}"' for v in DOMAINS[name]) if name in DOMAINS else _FORMS[kind] if isinstance(kind, str) else "객체의 목록"
        empty = " | null" if kind in ("int", "string") and name not in REQUIRED_FIELDS else ""
        out.append(f"{indent}- {name}{'*' * (name in REQUIRED_FIELDS)} ({form}{empty}): {HINTS[name]}")
        if not isinstance(kind, str):
            out.append(fields_block(kind, indent + "  "))
    return "\n".join(out)


#: Texts of the extraction prompt with the names of the values between them.
_TASK = re.split(r"\{(\w+)\}", EXTRACTION_TASK.replace("{fields}", fields_block()))


def extraction_prompt(university: Column, year: Column, handles: Column, body: Column) -> Column:
    """The prompt for one page: the template's texts and the values one after another, so that marks within a value stay as they are. The season is no part of it: it only judges the answer."""
    values = {"university": university, "year": year.cast("string"), "handles": F.array_join(handles, ", "), "body": body}
    return F.concat(*(F.coalesce(values[x], F.lit("")) if k % 2 else F.lit(x) for k, x in enumerate(_TASK)))


def discovery_prompt(university: Column, year: Column, season: Column) -> Column:
    """The prompt for a search: the season's word follows the year."""
    return F.concat(F.lit("'"), university, F.lit("'의 "), year.cast("string"), F.lit("년"), season_word(season), F.lit(" 축제 라인업을 다룬 글의 주소를 관련도 순서로 최대 8개, JSON {\"candidates\": [{\"url\": ..., \"title\": ...}]} 로만 답하세요."))


def known_names_block(names: DataFrame) -> str:
    """The part of a naming prompt that lists canonical names already chosen; '' if there are none."""
    rows = [r[0] for r in canonical_names(names).orderBy("artist_canonical").collect()]
    return "\n이미 정한 표기입니다. 같은 사람이면 그대로 쓰세요:\n" + "\n".join(rows) + "\n" if rows else ""


def extracted(pages: DataFrame, provider: Provider) -> DataFrame:
    """pages (with prompt; status ok rows only are asked) plus extraction and error. Write the result before using it twice: each read asks anew."""
    names = pages.columns
    schema = pages.drop("prompt", "body").schema.add("extraction", struct(f"e {EXTRACTION}")["e"].dataType).add("error", "string")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values, errors = [], []
            for status, prompt in zip(batch["status"], batch["prompt"], strict=True):
                value = error = None
                if status == "ok":
                    try:
                        value = ask(provider, prompt, "extraction")
                    except (ValueError, ProviderError) as e:
                        error = str(e)[:500] or type(e).__name__
                values.append(value)
                errors.append(error)
            out = batch[[c for c in names if c not in ("prompt", "body")]].copy()
            out["extraction"], out["error"] = pd.Series(values, index=out.index, dtype=object), pd.Series(errors, index=out.index, dtype=object)
            yield out

    return pages.mapInPandas(run, schema)


def judged(attempts: DataFrame) -> DataFrame:
    """Attempts with flag and date_warning, from status, extraction, error, published_at and the asked university, year and season."""
    x = lambda name: F.col(f"extraction.{name}")
    right = verify(x("found"), x("university_name"), x("year"), x("start_date"), F.col("university"), F.col("year"), F.col("season"))
    return attempts.withColumn("flag", attempts_flag(F.col("status"), F.col("error"), right)).withColumn("date_warning", date_warning(F.col("published_at"), F.col("year")))


def first_valid(answers: DataFrame, key: str, valid: Column, order: str = "attempt", tries: int = 2) -> DataFrame:
    """Of each key the first valid one of at most `tries` recorded answers."""
    ok = answers.where(F.col(order) <= tries).where(valid)
    return ok.groupBy(F.col(key).alias("__key")).agg(F.min_by(F.struct(*answers.columns), order).alias("b")).select("b.*")
