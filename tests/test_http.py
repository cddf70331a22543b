import json
from datetime import datetime

import pytest

from contrail.sources import http as H


def server(*answers):
    left, seen = list(answers), []

    def send(url, headers, params, timeout):
        seen.append((url, headers, params))
        a = left.pop(0)
        if isinstance(a, Exception):
            raise a
        return a

    send.seen = seen
    return send


def test_retries_and_waits():
    waits = []
    send = server(H.Response(429, headers={"Retry-After": "7"}), OSError(), H.Response(200, "[1]"))
    assert H.get_json("u", send=send, sleep=waits.append) == [1] and waits[0] == 7 and 2 <= waits[1] <= 2.5
    with pytest.raises(H.Exhausted):
        H.get_json("u", send=server(*[H.Response(503)] * 3), sleep=waits.append)
    with pytest.raises(H.HttpError):
        H.get_json("u", send=server(H.Response(404)), sleep=waits.append)
    assert H.retry_after(H.Response(429, headers={"Retry-After": "Wed, 1"})) is None


def test_pool_moves_on_and_remembers():
    pool = H.Pool(["a", "b", "c"])

    def use(item):
        if item == "a":
            raise H.HttpError(429)
        return item

    assert pool.execute(use) == "b" and pool.active == 1
    with pytest.raises(H.Exhausted):
        pool.execute(lambda _: (_ for _ in ()).throw(H.HttpError(429)))
    with pytest.raises(KeyError):
        pool.execute(lambda _: {}["x"])


def test_client_renews_its_token_and_reads_credit():
    now = [0.0]
    made = []
    token = H.Token(lambda: made.append(1) or {"access_token": f"t{len(made)}", "expires_in": 100}, lambda: now[0])
    send = server(H.Response(401), H.Response(200, '{"a": 1}', {"X-Rate-Limit-Remaining": "12"}))
    client = H.Client("http://x/", token, send, lambda s: None)
    assert client.get("/p") == {"a": 1} and client.remaining == 12 and [h["Authorization"] for _, h, _ in send.seen] == ["Bearer t1", "Bearer t2"]
    now[0] = 71
    assert token.get() == "t3"
    assert H.fetch(H.Client("x", send=server(H.Response(404))), "track", icao24="AB") is None
    ask = H.Client("x", send=server(*[H.Response(200, "[]", {"X-Rate-Limit-Remaining": "12"})] * 2))
    assert H.can_extract(ask, 3) and not H.can_extract(ask, 4)


def test_requests():
    day = datetime(2026, 6, 12)
    assert H.request("arrival", day, day, airport="lemd") == ("/flights/arrival", {"airport": "LEMD", "begin": "1781222400", "end": "1781222400"})
    assert H.request("states", box=(1, 2, 3, 4))[1] == {"lamin": "1", "lamax": "2", "lomin": "3", "lomax": "4"}


def test_reader_makes_envelopes():
    send = server(H.Response(200, '[{"icao24": "é"}]'), H.Response(200, "[]"))
    reader = H.FlightFeedReader({"base": "http://x", "airports": "LEMD", "days": "2026-06-12", "token": "k"}, send)
    calls = reader.partitions()
    assert [c.endpoint for c in calls] == ["arrival", "departure"]
    rows = [r for c in calls for r in reader.read(c)]
    assert len(rows) == 1 and json.loads(rows[0][3]) == [{"icao24": "é"}] and json.loads(rows[0][1])["airport"] == "LEMD" and "é" in rows[0][3]
