"""A client for remote parsers. It runs on the driver, before Spark reads what was fetched.

Nothing is sent unless that is allowed explicitly and a token is set; the token stands in
no result. ``send`` does the transport, so that tests and other clients can give their own.
"""

from __future__ import annotations

import hashlib
import io
import json
import os
import time
import urllib.error
import urllib.request
import uuid
import zipfile
from collections.abc import Callable
from dataclasses import dataclass, field
from pathlib import Path

#: (method, url, headers, body, timeout) -> (status, body)
Send = Callable[[str, str, dict, bytes | None, float], tuple[int, bytes]]

#: Paths of the signed-upload protocol (fixed values).
SUBMIT, RESULT = "/api/v4/file-urls/batch", "/api/v4/extract-results/batch/"


class RemoteError(RuntimeError):
    """The service refused or failed."""


def http_send(method: str, url: str, headers: dict, body: bytes | None, timeout: float) -> tuple[int, bytes]:
    request = urllib.request.Request(url, data=body, headers=headers, method=method)
    try:
        with urllib.request.urlopen(request, timeout=timeout) as answer:
            return answer.status, answer.read()
    except urllib.error.HTTPError as e:
        return e.code, e.read()


@dataclass
class RemoteParser:
    base_url: str
    token: str = ""
    allow_upload: bool = False
    timeout: float = 300
    poll_seconds: float = 10
    max_polls: int = 60
    headers: dict = field(default_factory=dict)
    send: Send = http_send
    sleep: Callable[[float], None] = time.sleep

    def gate(self, endpoint: str | None = None) -> str | None:
        """Why nothing may be sent; None if it may."""
        if not self.allow_upload:
            return "remote upload not explicitly allowed"
        if not (endpoint or self.base_url):
            return "no endpoint"
        return None if self.token else "no token"

    def _json(self, method: str, url: str, body: bytes | None = None, kind: str | None = "application/json") -> dict:
        headers = self.headers | {"Authorization": f"Bearer {self.token}"} | ({"Content-Type": kind} if kind else {})
        status, raw = self.send(method, url, headers, body, self.timeout)
        try:
            payload = json.loads(raw)
        except ValueError:
            payload = {"raw_response": raw.decode(errors="replace")}
        payload = payload if isinstance(payload, dict) else {"response": payload}
        if not 200 <= status < 300 or payload.get("code", 0) not in (0, "0"):
            raise RemoteError(f"{method} {url}: HTTP {status}: {payload.get('msg') or payload}")
        return payload

    def multipart(self, endpoint: str, path: str, fields: dict[str, str] | None = None, name: str = "file") -> dict:
        """Posts one file with form fields."""
        if why := self.gate(endpoint):
            return {"status": "blocked", "reason": why}
        edge = uuid.uuid4().hex
        parts = [f'--{edge}\r\nContent-Disposition: form-data; name="{k}"\r\n\r\n{v}\r\n'.encode() for k, v in (fields or {}).items()]
        head = f'--{edge}\r\nContent-Disposition: form-data; name="{name}"; filename="{os.path.basename(path)}"\r\nContent-Type: application/pdf\r\n\r\n'
        body = b"".join([*parts, head.encode(), Path(path).read_bytes(), f"\r\n--{edge}--\r\n".encode()])
        return {"status": "completed", "payload": self._json("POST", endpoint, body, f"multipart/form-data; boundary={edge}")}

    def signed_upload(self, path: str, options: dict | None = None) -> dict:
        """Asks for a signed address, uploads the file there and polls until all results are done or failed."""
        if why := self.gate():
            return {"status": "blocked", "reason": why}
        data = Path(path).read_bytes()
        base = self.base_url.rstrip("/")
        asked = {"files": [{"name": os.path.basename(path), "data_id": hashlib.sha256(data).hexdigest()[:16]}]} | (options or {})
        got = self._json("POST", base + SUBMIT, json.dumps(asked).encode()).get("data", {})
        if not got.get("batch_id") or not got.get("file_urls"):
            raise RemoteError("the answer has no batch_id or file_urls")
        status, raw = self.send("PUT", got["file_urls"][0], {}, data, self.timeout)
        if not 200 <= status < 300:
            raise RemoteError(f"upload: HTTP {status}: {raw[:500]!r}")
        payload: dict = {}
        for k in range(self.max_polls):
            payload = self._json("GET", base + RESULT + got["batch_id"], kind=None)
            states = {r.get("state") for r in payload.get("data", {}).get("extract_result", []) if isinstance(r, dict)}
            if states and states <= {"done", "failed"}:
                return {"status": "completed", "polls": k + 1, "payload": payload}
            if k + 1 < self.max_polls:
                self.sleep(self.poll_seconds)
        return {"status": "timeout", "polls": self.max_polls, "payload": payload}

    def fetch_results(self, payload: dict, target: str) -> list[dict]:
        """Downloads finished results, unpacks them below ``target`` and names each first layout file."""
        out = []
        results = [r for r in payload.get("data", {}).get("extract_result", []) if isinstance(r, dict) and r.get("state") == "done"]
        urls = [u.strip() for r in results if isinstance(u := r.get("full_zip_url") or r.get("zip_url"), str) and u.strip()]
        for k, url in enumerate(urls, 1):
            status, raw = self.send("GET", url, {}, None, self.timeout)
            if not 200 <= status < 300:
                raise RemoteError(f"download: HTTP {status}: {url}")
            place = Path(target) / f"result_{k}"
            with zipfile.ZipFile(io.BytesIO(raw)) as archive:
                archive.extractall(place)
            layouts = sorted(map(str, place.rglob("layout.json")))
            out.append({"url": url, "dir": str(place), "layout_json": layouts[0] if layouts else None})
        return out
