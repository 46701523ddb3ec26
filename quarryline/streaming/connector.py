"""The change connector's service: register, ask, wait."""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request

from quarryline.streaming.cdc_stream import connector_healthy


class ConnectorError(RuntimeError):
    """The service refused, or the connector did not come up."""


class ConnectorService:
    """A connector service's REST interface."""

    def __init__(self, url: str, timeout: float = 10.0):
        self.url, self.timeout = url.rstrip("/"), timeout

    def _ask(self, method: str, path: str, body: dict | None = None) -> dict:
        data = None if body is None else json.dumps(body).encode()
        request = urllib.request.Request(f"{self.url}{path}", data, {"Content-Type": "application/json"}, method=method)
        try:
            with urllib.request.urlopen(request, timeout=self.timeout) as answer:
                text = answer.read().decode()
        except urllib.error.HTTPError as refused:
            raise ConnectorError(f"{method} {path}: {refused.code} {refused.read().decode(errors='replace')[:500]}") from refused
        except urllib.error.URLError as unreachable:
            raise ConnectorError(f"{self.url} cannot be reached: {unreachable.reason}") from unreachable
        return json.loads(text) if text else {}

    def register(self, payload: dict) -> dict:
        """Create or update a connector; the same payload twice changes nothing."""
        return self._ask("PUT", f"/connectors/{payload['name']}/config", payload["config"])

    def status(self, name: str) -> dict:
        return self._ask("GET", f"/connectors/{name}/status")

    def wait(self, name: str, seconds: float = 60.0, every: float = 2.0) -> dict:
        """The status once the connector and all its tasks run; an error if they do not in time."""
        stop, last = time.monotonic() + seconds, "no answer"
        while True:
            try:
                status = self.status(name)
                if connector_healthy(status):
                    return status
                last = json.dumps(status)
            except ConnectorError as failure:  # it may not be there yet
                last = str(failure)
            if time.monotonic() >= stop:
                raise ConnectorError(f"{name} does not run after {seconds:g} s: {last[:500]}")
            time.sleep(min(every, max(0.0, stop - time.monotonic())))
