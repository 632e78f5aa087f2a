"""The one place where a language model is met: a provider answers prompts with text; answers are parsed strictly.

Tests use a provider made of recorded answers. A live one is any picklable callable prompt -> text that raises ProviderError.
"""

from __future__ import annotations

import json
import subprocess
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import cache

from millrace.schemas import DOMAINS, EXTRACTION_FIELDS, GENRES, REQUIRED_FIELDS


#: Seconds that a search may take, and a naming run's call.
SEARCH_TIMEOUT, NAMING_TIMEOUT = 300, 900


class ProviderError(RuntimeError):
    """The call itself failed; the same prompt isn't sent again at once."""


Provider = Callable[[str], str]


@dataclass
class Recorded:
    """Answers by a part of the prompt, in turn; for tests and replays."""

    answers: dict[str, list[str]]
    asked: list[str] = field(default_factory=list)

    def __call__(self, prompt: str) -> str:
        self.asked.append(prompt)
        for part, answers in self.answers.items():
            if part in prompt:
                if not answers:
                    break
                return answers.pop(0) if len(answers) > 1 else answers[0]
        raise ProviderError("no recorded answer")


@dataclass
class CommandLine:
    """A command that takes the prompt as last argument and prints a JSON object with a `result`.

    tools: arguments before the prompt that let it use tools, such as a web search; none for plain questions.
    """

    command: tuple[str, ...]
    timeout: float = 120
    tools: tuple[str, ...] = ()

    def for_search(self, *tools: str) -> CommandLine:
        """The same command for searches: with tools, and as long as these take."""
        return CommandLine(self.command, SEARCH_TIMEOUT, tools)

    def __call__(self, prompt: str) -> str:
        try:
            done = subprocess.run([*self.command, *self.tools, prompt], capture_output=True, text=True, timeout=self.timeout)
        except (FileNotFoundError, subprocess.TimeoutExpired) as e:
            raise ProviderError(str(e)) from e
        if done.returncode:
            raise ProviderError(done.stderr[:500])
        try:
            return json.loads(done.stdout)["result"]
        except (ValueError, KeyError, TypeError) as e:
            raise ProviderError(f"no result in the answer: {e}") from e


@cache
def models() -> dict:
    """Models of strict parsing, built once a process. Kept in a function as pydantic is needed only where answers are parsed."""
    from typing import Literal

    from pydantic import BaseModel, Field, create_model

    plain = {"boolean": bool, "int": int, "string": str}

    def model(name: str, fields: tuple):
        """A model of a schema's fields: required ones, lists (empty by default), flags (false by default), and others that may be null."""
        made = {}
        for field, kind in fields:
            if field in REQUIRED_FIELDS:
                made[field] = (plain[kind], ...)
            elif kind == "boolean":
                made[field] = (bool, False)
            elif kind in plain:
                made[field] = ((Literal[DOMAINS[field]] if field in DOMAINS else plain[kind]) | None, None)
            else:
                made[field] = (list[str if isinstance(kind, str) else model(field, kind)], Field(default_factory=list))
        return create_model(name, **made)

    extraction = model("extraction", EXTRACTION_FIELDS)

    class Artist(BaseModel):
        name: str
        other_names: list[str] = Field(default_factory=list)
        genre: Literal[GENRES] | None = None
        needs_review: bool = False

    class Names(BaseModel):
        mapping: dict[str, str]
        artists: list[Artist]

    class Genres(BaseModel):
        genres: dict[str, Literal[GENRES] | None]

    class Candidate(BaseModel):
        url: str
        title: str | None = None

    class Discovery(BaseModel):
        candidates: list[Candidate] = Field(default_factory=list)

    return {"extraction": extraction, "names": Names, "genres": Genres, "discovery": Discovery}


def parse_answer(text: str | None, model: str) -> dict:
    """The checked object between the first { and the last }; ValueError otherwise."""
    start, end = (text or "").find("{"), (text or "").rfind("}")
    if start < 0 or end <= start:
        raise ValueError("no JSON object in the answer")
    return models()[model].model_validate_json(text[start : end + 1]).model_dump()


def ask(provider: Provider, prompt: str, model: str, tries: int = 2) -> dict:
    """Asks again, with the errors so far under the prompt, if an answer doesn't parse. A failed call raises at once."""
    errors: list[Exception] = []
    for _ in range(tries):
        try:
            return parse_answer(provider("\n\n".join([prompt, *map(str, errors)])), model)
        except ValueError as e:
            errors.append(e)
    raise errors[-1]
