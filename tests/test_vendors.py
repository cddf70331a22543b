import io
import json

from contrail import config
from contrail.sources import vendors as V
from contrail.sources.http import HttpError, Response
from tests.test_http import server


def test_keys_rotate_and_vendors_stand_in():
    send = server(Response(429), Response(429), Response(429), Response(200, '{"data": [{"flight": {}}]}'))
    assert V.first_vendor("http://x", ["a", "b"], "IB1", "2026-06-12", send=send, sleep=lambda s: None)["data"]
    assert [p["access_key"] for _, _, p in send.seen] == ["a", "a", "a", "b"]

    def fails(callsign, day):
        raise HttpError(404)

    assert V.schedule("IB1", "d", [("one", fails), ("two", lambda c, d: {"data": []}), ("three", lambda c, d: [{"number": c}])]) == ("three", [{"number": "IB1"}])
    assert V.schedule("IB1", "d", [("one", fails)]) is None


def test_headers_and_weather():
    assert set(V.second_vendor_headers("xxmshyy", "h")) == {"X-RapidAPI-Key", "X-RapidAPI-Host"} and V.second_vendor_headers("k", "h") == {"x-api-key": "k"}
    send = server(Response(200, '{"hourly": {}}'), Response(400))
    at = {"LEMD": (40.0, -3.0)}
    assert V.weather("http://w", at, "LEMD", "2026-06-12", "2026-06-13", send=send) == {"hourly": {}} and "temperature_2m" in send.seen[0][2]["hourly"]
    assert V.weather("http://w", at, "LEMD", "a", "b", send=send) is None and V.weather("http://w", at, "XXXX", "a", "b") is None


def test_envelopes_and_download(spark, tmp_path):
    row = V.envelopes(spark, [("one", "flights", {"a": "é"}, {"data": []})]).first()
    assert json.loads(row["response"]) == {"data": []} and "é" in row["params"]
    path = V.download("u", str(tmp_path / "d" / "f"), lambda u: io.BytesIO(b"x" * 3_000_000))
    assert (tmp_path / "d" / "f").stat().st_size == 3_000_000 and path.endswith("f")


def test_settings(tmp_path):
    env = {"FEED_CLIENT_ID": "a", "FEED_CLIENT_SECRET": "b", "FEED_CLIENT_ID_2": "c", "FEED_CLIENT_SECRET_2": "d", "FEED_CLIENT_ID_4": "x", "V_KEYS": "k, l,", "W_KEY": "m"}
    assert [c["client_id"] for c in config.credentials(env)] == ["a", "c"] and config.keys("V", env) == ["k", "l"] and config.keys("W", env) == ["m"] and config.keys("X", env) == []
    both = {"AZURE_STORAGE_ACCOUNT": "s", "AZURE_STORAGE_KEY": "k", "AWS_ACCESS_KEY_ID": "i", "AWS_SECRET_ACCESS_KEY": "j"}
    assert list(config.storage_settings(both)) == ["fs.azure.account.key.s.dfs.core.windows.net"] and config.storage_settings({}) == {}
    assert "fs.s3a.endpoint" in config.storage_settings({"STORE_ENDPOINT": "e", "STORE_KEY_ID": "i", "STORE_SECRET": "s"})
    assert config.table_uri("s3://b/x/", "silver/flights") == "s3a://b/x/silver/flights" and config.table_uri("/d", "t") == "/d/t" and config.is_remote("abfss://x") and not config.is_remote("/d")
    log = config.logger("contrail.test", str(tmp_path / "l.log"))
    assert config.logger("contrail.test", str(tmp_path / "l.log")) is log and len(log.handlers) == 2
