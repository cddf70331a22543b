"""Schedule, weather and aircraft feeds over the HTTP helpers. Answers are kept raw; operators parse them."""

from __future__ import annotations

import json
import os
import urllib.request
from collections.abc import Callable, Iterable
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from ..schemas import WEATHER_VARIABLES
from .http import Exhausted, HttpError, Pool, flight_status_url, get_json, weather_params


def first_vendor(base: str, keys: list[str], callsign: str, day: str, **how: Any) -> Any:
    """Vendor one: the key is a parameter, and keys rotate when one has used up its requests."""
    ask = lambda key: get_json(f"{base.rstrip('/')}/flights", None, {"access_key": key, "flight_icao": callsign, "flight_date": day}, **how)
    return Pool(keys, lambda e: isinstance(e, Exhausted) or isinstance(e, HttpError) and e.status in (401, 403, 429)).execute(ask)


def second_vendor_headers(key: str, host: str) -> dict[str, str]:
    """Keys of the marketplace have ``msh`` in them and need its two headers; others are sent as they are."""
    return {"X-RapidAPI-Key": key, "X-RapidAPI-Host": host} if "msh" in key else {"x-api-key": key}


def second_vendor(base: str, host: str, key: str, callsign: str, day: str, **how: Any) -> Any:
    return get_json(flight_status_url(base, callsign, day), second_vendor_headers(key, host), **how)


def schedule(callsign: str, day: str, vendors: Iterable[tuple[str, Callable[[str, str], Any]]]) -> tuple[str, Any] | None:
    """(name, answer) of the first vendor that has one; a vendor that fails counts as without."""
    for name, ask in vendors:
        try:
            answer = ask(callsign, day)
        except (HttpError, Exhausted):
            continue
        if answer and (not isinstance(answer, dict) or answer.get("data") or answer.get("flights")):
            return name, answer
    return None


def weather(base: str, coordinates: dict[str, tuple[float, float]], airport: str, first: str, last: str, **how: Any) -> Any:
    """Hourly weather of an airport; None if it has no coordinates or the feed fails."""
    if airport not in coordinates:
        return None
    try:
        return get_json(base, None, weather_params(*coordinates[airport], first, last, WEATHER_VARIABLES), **how)
    except (HttpError, Exhausted):
        return None


def envelopes(spark: SparkSession, answers: list[tuple[str, str, dict, Any]]) -> DataFrame:
    """Bronze rows from (source, endpoint, params, answer)."""
    from datetime import datetime, timezone

    now = datetime.now(timezone.utc)
    rows = [(s, e, json.dumps(p, ensure_ascii=False), json.dumps(a, ensure_ascii=False), now) for s, e, p, a in answers]
    return spark.createDataFrame(rows, "source string, endpoint string, params string, response string, fetched_at timestamp")


def download(url: str, path: str, open_url: Callable = urllib.request.urlopen, chunk: int = 1 << 20) -> str:
    """A file in pieces; it has its name only once it is whole."""
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open_url(url) as r, open(f"{path}.part", "wb") as f:
        while piece := r.read(chunk):
            f.write(piece)
    os.replace(f"{path}.part", path)
    return path
