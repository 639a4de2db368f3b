"""A client of a chat completions service, for labels."""

from __future__ import annotations

import http.client
import json
import random
import time
import urllib.error
import urllib.request
from collections.abc import Callable
from urllib.parse import urlsplit

from ..operators.labels import ContextTooLong, JobError

# What ends a job, what is asked for again, and how long to wait at most.
FATAL, LATER, LONGEST_WAIT, LONGEST_STATED = (401, 403, 422), (404, 429), 60.0, 300.0


class ServiceError(RuntimeError):
    """A request that failed for good; its text is a stable reason."""


class ConfigurationError(ServiceError, JobError):
    """One that no other request can get around: it ends a job."""


class ChatClient:
    """``client(prompt) -> answer``, with retries of what may pass: too many requests, faults of the service and of the network."""

    def __init__(self, url: str, model: str, key: str, system: str = "", retries: int = 5, timeout: float = 120.0, tokens: int = 4096, opener: Callable = urllib.request.urlopen, sleep: Callable = time.sleep, jitter: Callable = random.random):
        parts = urlsplit(url)
        if parts.scheme not in ("http", "https") or not parts.netloc or parts.username or not model or not key:
            raise ConfigurationError("url, model and key are needed")
        self.url, self.model, self._key, self.system, self.retries, self.timeout, self.tokens = url, model, key, system, retries, timeout, tokens
        self._open, self._sleep, self._jitter = opener, sleep, jitter

    def __repr__(self) -> str:
        return f"ChatClient({self.url!r}, {self.model!r})"

    def __call__(self, prompt: str) -> str:
        said = [{"role": "system", "content": self.system}] * bool(self.system) + [{"role": "user", "content": prompt}]
        body = json.dumps({"model": self.model, "messages": said, "temperature": 0, "max_tokens": self.tokens, "response_format": {"type": "json_object"}}).encode()
        reason, wait = "", None
        for attempt in range(self.retries + 1):
            if attempt:
                self._sleep(wait if wait is not None else min(LONGEST_WAIT, 2.0 ** (attempt - 1)) * (0.5 + 0.5 * self._jitter()))
            request = urllib.request.Request(self.url, data=body, method="POST", headers={"Authorization": f"Bearer {self._key}", "Content-Type": "application/json"})
            try:
                with self._open(request, timeout=self.timeout) as answer:
                    content = json.loads(answer.read())["choices"][0]["message"]["content"]
                if isinstance(content, str) and content:
                    return content
                reason, wait = "invalid_api_response", None
            except urllib.error.HTTPError as error:
                reason, wait = self._refused(error), _stated(error)
            except (urllib.error.URLError, TimeoutError, ConnectionError, http.client.IncompleteRead):
                reason, wait = "network_retry_exhausted", None
            except (ValueError, KeyError, IndexError, TypeError):
                reason, wait = "invalid_api_response", None
        raise (ConfigurationError if reason == "http_404" else ServiceError)(reason) from None

    def _refused(self, error: urllib.error.HTTPError) -> str:
        status = error.code
        if status == 413:
            raise ContextTooLong
        if status in (400, 422):
            told = error.read(65536).decode("utf-8", "replace").lower()
            if "context" in told and ("length" in told or "window" in told or "token" in told):
                raise ContextTooLong
        if status in FATAL:
            raise ConfigurationError(f"http_{status}")
        if status not in LATER and status < 500:
            raise ServiceError(f"http_{status}")
        return {404: "http_404", 429: "rate_limit_exhausted"}.get(status, "service_retry_exhausted")


def _stated(error: urllib.error.HTTPError) -> float | None:
    try:
        return min(LONGEST_STATED, max(0.0, float(error.headers.get("Retry-After"))))
    except (TypeError, ValueError, AttributeError):
        return None
