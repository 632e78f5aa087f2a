"""The mapping of raw names to canonical names, shared by all years: a JSON object in a file."""

from __future__ import annotations

import json
import os
import tempfile
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession


class MappingError(ValueError):
    """The file isn't an object of strings; going on would lose what it holds."""


def load_mapping(path: str) -> dict[str, str]:
    """Empty if there is no file; anything but an object of strings raises."""
    try:
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
    except FileNotFoundError:
        return {}
    except ValueError as e:
        raise MappingError(f"{path}: {e}") from e
    if not isinstance(data, dict) or not all(isinstance(v, str) for v in data.values()):
        raise MappingError(f"{path}: not an object of strings")
    return data


def save_mapping(path: str, mapping: dict[str, str]) -> None:
    """Keys sorted; the old file stands until the new one is whole."""
    replace_file(path, (json.dumps(mapping, ensure_ascii=False, indent=2, sort_keys=True) + "\n").encode())


def mapping_frame(spark: SparkSession, mapping: dict[str, str]) -> DataFrame:
    return spark.createDataFrame(sorted(mapping.items()), "artist_raw string, artist_canonical string")


def replace_file(path: str, data: bytes | Iterable[bytes]) -> None:
    """Writes data, or its parts one after another, beside the target and renames; on failure nothing but the old file is left."""
    folder = os.path.dirname(os.path.abspath(path))
    os.makedirs(folder, exist_ok=True)
    handle, temp = tempfile.mkstemp(dir=folder, prefix=".", suffix=".tmp")
    try:
        with os.fdopen(handle, "wb") as f:
            f.writelines([data] if isinstance(data, bytes) else data)
        os.replace(temp, path)
    except BaseException:
        if os.path.exists(temp):
            os.unlink(temp)
        raise
