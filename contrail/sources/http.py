"""HTTP feeds: retrying GET, rotating credentials, tokens, and a Spark data source over them.

Everything takes its transport as a parameter, so nothing here needs a network to be tested. A
transport is ``send(url, headers, params, timeout) -> Response``; ``urllib_send`` is the default.
"""

from __future__ import annotations

import json
import random
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone
from typing import Any, Generic, TypeVar

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

T = TypeVar("T")
ATTEMPTS = 3
#: Paths of the flight feed by endpoint.
PATHS = {
    "all": "/flights/all", "aircraft": "/flights/aircraft", "arrival": "/flights/arrival", "departure": "/flights/departure",
    "states": "/states/all", "own_states": "/states/own", "track": "/tracks/all",
}


@dataclass
class Response:
    status: int
    body: str = ""
    headers: dict[str, str] = field(default_factory=dict)


class HttpError(Exception):
    def __init__(self, status: int, message: str = ""):
        super().__init__(f"HTTP {status} {message}".strip())
        self.status = status


class Exhausted(Exception):
    """Every attempt, or every item of a pool, has failed."""


def urllib_send(url: str, headers: dict | None, params: dict | None, timeout: float) -> Response:
    full = f"{url}?{urllib.parse.urlencode(params)}" if params else url
    try:
        with urllib.request.urlopen(urllib.request.Request(full, headers=headers or {}), timeout=timeout) as r:
            return Response(r.status, r.read().decode(), dict(r.headers))
    except urllib.error.HTTPError as e:
        return Response(e.code, "", dict(e.headers))


def backoff(attempt: int, base: float = 1.0) -> float:
    """Twice as long after each attempt, and up to half a second more."""
    return base * 2 ** (attempt - 1) + random.uniform(0, 0.5)


def retry_after(response: Response) -> float | None:
    """Seconds that the server asks for, if it says so as a number."""
    try:
        return float(response.headers["Retry-After"])
    except (KeyError, ValueError):
        return None


def get_json(url: str, headers=None, params=None, timeout: float = 30, send: Callable = urllib_send, sleep: Callable = time.sleep, attempts: int = ATTEMPTS) -> Any:
    """A JSON body. Busy servers, failing servers and broken connections are tried again; other errors are raised."""
    last: Exception | None = None
    for attempt in range(1, attempts + 1):
        try:
            r = send(url, headers, params, timeout)
        except OSError as e:
            last, wait = e, backoff(attempt)
        else:
            if r.status < 400:
                return json.loads(r.body) if r.body else {}
            last = HttpError(r.status, url)
            if r.status != 429 and r.status < 500:
                raise last
            wait = (retry_after(r) if r.status == 429 else None) or backoff(attempt)
        if attempt < attempts:
            sleep(wait)
    raise Exhausted(f"{attempts} attempts failed for {url}") from last


def rate_limited(error: Exception) -> bool:
    return isinstance(error, HttpError) and error.status == 429


class Pool(Generic[T]):
    """Items (keys, clients) of which one is active; a failure that allows it moves on to the next."""

    def __init__(self, items: list[T], should_rotate: Callable[[Exception], bool] = rate_limited):
        if not items:
            raise ValueError("a pool needs an item")
        self.items, self.should_rotate, self.active = list(items), should_rotate, 0

    def __len__(self) -> int:
        return len(self.items)

    def execute(self, use: Callable[[T], Any]) -> Any:
        last: Exception | None = None
        for step in range(len(self.items)):
            at = (self.active + step) % len(self.items)
            try:
                result = use(self.items[at])
            except Exception as e:
                if not self.should_rotate(e):
                    raise
                last = e
            else:
                self.active = at
                return result
        raise Exhausted(f"all {len(self.items)} items failed") from last


class Token:
    """A bearer token that is fetched anew shortly before it ends."""

    MARGIN_S = 30

    def __init__(self, fetch: Callable[[], dict], clock: Callable[[], float] = time.time):
        self.fetch, self.clock, self.value, self.until = fetch, clock, None, 0.0

    def get(self) -> str:
        if self.value is None or self.clock() >= self.until:
            answer = self.fetch()
            self.value, self.until = answer["access_token"], self.clock() + float(answer.get("expires_in", 1800)) - self.MARGIN_S
        return self.value

    def drop(self) -> None:
        self.value = None


class Client:
    """The flight feed: 429 is raised at once (a pool may rotate), 401 renews the token, the rest is retried."""

    def __init__(self, base: str, token: Token | None = None, send: Callable = urllib_send, sleep: Callable = time.sleep, timeout: float = 60):
        self.base, self.token, self.send, self.sleep, self.timeout = base.rstrip("/"), token, send, sleep, timeout
        self.remaining: int | None = None

    def get(self, path: str, params: dict | None = None) -> Any:
        last: Exception | None = None
        for attempt in range(1, ATTEMPTS + 1):
            headers = {"Authorization": f"Bearer {self.token.get()}"} if self.token else {}
            try:
                r = self.send(self.base + path, headers, params, self.timeout)
            except OSError as e:
                last = e
            else:
                if (left := r.headers.get("X-Rate-Limit-Remaining")) is not None:
                    self.remaining = int(left)
                if r.status < 400:
                    return json.loads(r.body) if r.body else None
                last = HttpError(r.status, path)
                if r.status == 401 and self.token:
                    self.token.drop()
                    continue
                if r.status < 500:
                    raise last
            if attempt < ATTEMPTS:
                self.sleep(2)
        raise Exhausted(f"{ATTEMPTS} attempts failed for {path}") from last


def request(endpoint: str, begin: datetime | None = None, end: datetime | None = None, airport: str | None = None, icao24: str | None = None, box: tuple | None = None) -> tuple[str, dict[str, str]]:
    """Path and parameters of a request to the flight feed."""
    params: dict[str, str] = {}
    if airport:
        params["airport"] = airport.upper()
    if icao24:
        params["icao24"] = icao24.lower()
    seconds = lambda t: str(int(t.replace(tzinfo=t.tzinfo or timezone.utc).timestamp()))
    if begin is not None:
        params["time" if endpoint == "track" else "begin"] = seconds(begin)
    if end is not None:
        params["end"] = seconds(end)
    if box:
        params |= dict(zip(("lamin", "lamax", "lomin", "lomax"), map(str, box)))
    return PATHS[endpoint], params


def fetch(client: Client | Pool, endpoint: str, **what: Any) -> Any:
    """The raw answer, through a pool of clients if one is given; an unknown track is None."""
    path, params = request(endpoint, **what)
    try:
        return client.execute(lambda c: c.get(path, params)) if isinstance(client, Pool) else client.get(path, params)
    except HttpError as e:
        if endpoint == "track" and e.status == 404:
            return None
        raise


def clients(base: str, tokens: list[str], send: Callable = urllib_send, sleep: Callable = time.sleep) -> Client | Pool:
    """A client, or a pool of clients with a token each that moves on when one has no requests left."""
    made = [Client(base, Token(lambda t=t: {"access_token": t, "expires_in": 1e9}), send, sleep) for t in tokens]
    return Pool(made) if len(made) > 1 else made[0] if made else Client(base, None, send, sleep)


def can_extract(client: Client, calls: int, cost: int = 4) -> bool:
    """Whether the credit left, learnt by a cheap call, covers so many calls; unknown credit counts as enough."""
    client.get(PATHS["states"], {"lamin": "0", "lamax": "0.1", "lomin": "0", "lomax": "0.1"})
    return client.remaining is None or client.remaining >= calls * cost


def flight_status_url(base: str, callsign: str, day: str) -> str:
    return f"{base.rstrip('/')}/flights/callsign/{urllib.parse.quote(callsign)}/{day}"


def weather_params(latitude: float, longitude: float, first: str, last: str, variables: tuple[str, ...]) -> dict[str, str]:
    return {"latitude": str(latitude), "longitude": str(longitude), "start_date": first, "end_date": last, "hourly": ",".join(variables), "timezone": "UTC"}


@dataclass
class Call(InputPartition):
    endpoint: str
    airport: str
    day: str


class FlightFeed(DataSource):
    """``spark.read.format("flight_feed")``: one task for each airport, day and endpoint.

    Options: base, airports and days (comma-separated), endpoints (arrival,departure), or calls
    (endpoint:airport:day, comma-separated) instead of these three; tokens (comma-separated, a task
    moves on to the next when one has no requests left). Rows are bronze envelopes. With answers=all
    an empty answer has a row too, and a failed call one without a response, instead of an error.
    The server's limits bound the number of tasks that should run at once, which is the number of
    partitions after a coalesce.
    """

    transport: Callable = staticmethod(urllib_send)

    @classmethod
    def name(cls) -> str:
        return "flight_feed"

    def schema(self) -> str:
        return "endpoint string, params string, fetched_at timestamp, response string, ingestion_date date"

    def reader(self, schema) -> DataSourceReader:
        return FlightFeedReader(self.options, type(self).transport)


class FlightFeedReader(DataSourceReader):
    def __init__(self, options: dict, send: Callable):
        self.options, self.send = dict(options), send

    def partitions(self) -> list[Call]:
        split = lambda k, d="": [x for x in self.options.get(k, d).split(",") if x]
        if "calls" in self.options:
            return [Call(*c.split(":")) for c in split("calls")]
        return [Call(e, a, d) for d in split("days") for a in split("airports") for e in split("endpoints", "arrival,departure")]

    def read(self, partition: Call) -> Iterator[tuple]:
        begin = datetime.fromisoformat(partition.day).replace(tzinfo=timezone.utc)
        tokens = [t for t in self.options.get("tokens", self.options.get("token", "")).split(",") if t]
        every = self.options.get("answers") == "all"
        what = {"begin": begin, "end": begin + timedelta(seconds=86399), "airport": partition.airport}
        try:
            answer = fetch(clients(self.options["base"], tokens, self.send), partition.endpoint, **what)
        except (HttpError, Exhausted):
            if not every:
                raise
            body = None
        else:
            body = json.dumps(answer, ensure_ascii=False)
        if every or answer:  # else an empty answer leaves no row
            _, params = request(partition.endpoint, **what)
            yield partition.endpoint, json.dumps(params), datetime.now(timezone.utc), body, begin.date()
