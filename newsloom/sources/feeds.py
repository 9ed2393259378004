"""Feed registry."""

from __future__ import annotations

import json
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.schemas import FEEDS

try:
    import yaml
except ImportError:  # JSON registries still work
    yaml = None


def _parse(path: Path) -> Any:
    text = path.read_text(encoding="utf-8")
    if path.suffix == ".json":
        return json.loads(text)
    if yaml is None:
        raise ValueError(f"{path}: reading YAML needs the yaml package; use JSON instead")
    try:
        return yaml.safe_load(text)
    except yaml.YAMLError as error:
        raise ValueError(f"{path}: invalid YAML: {error}") from error


def _row(i: int, entry: Any, path: Path) -> tuple:
    if not isinstance(entry, dict):
        raise ValueError(f"{path}: feed {i} is not a mapping")
    texts = {key: str("" if entry.get(key) is None else entry[key]).strip() for key in ("name", "url")}
    for key, value in texts.items():
        if not value:
            raise ValueError(f"{path}: feed {i} has no {key}")
    keywords = [list(entry.get(f"{kind}_keywords", [])) for kind in ("include", "exclude")]
    return (i, texts["name"], texts["url"], bool(entry.get("enabled", True)),
            str(entry.get("category_hint", "")), *keywords)


def load_feeds(spark: SparkSession, path: str) -> DataFrame:
    """Enabled feeds of a YAML or JSON registry file, keywords in lower case.

    Raises ``FileNotFoundError`` for a missing file and ``ValueError`` for a
    bad one. The file is a hand-kept list read on the driver; a registry kept
    as a table goes through ``enabled_feeds`` directly.
    """
    file = Path(path)
    if not file.exists():
        raise FileNotFoundError(f"no feed registry at {path}")
    registry = _parse(file)
    if not isinstance(registry, dict) or not isinstance(registry.get("feeds"), list):
        raise ValueError(f"{path}: needs a top-level list named feeds")
    rows = [_row(i, entry, file) for i, entry in enumerate(registry["feeds"])]
    names = [row[1] for row in rows]
    if len(set(names)) < len(names):
        raise ValueError(f"{path}: feed names must differ, documents are matched to feeds by name")
    return enabled_feeds(spark.createDataFrame(rows, FEEDS))


def enabled_feeds(registry: DataFrame) -> DataFrame:
    """Drop disabled feeds and lower the keywords of a registry table."""
    lowered = {c: F.transform(c, F.lower) for c in ("include_keywords", "exclude_keywords")}
    return registry.filter("enabled").withColumns(lowered)
