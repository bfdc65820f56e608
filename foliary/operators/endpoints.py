"""Clients of language-model servers: one over HTTP, and a pool of several with calls in flight, failover and time limits. They live in tasks."""

from __future__ import annotations

import itertools
import json
import threading
import time
import urllib.request
from collections.abc import Callable, Sequence
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait

Client = Callable[[str], str]


def http_client(url: str, *, timeout: float = 120.0, headers: dict[str, str] | None = None) -> Callable[[], Client]:
    """A maker of clients that post a request's body to a URL and return the answer's; whatever isn't an answer (another status, no connection, no answer in time)
    is an exception, hence the row's error."""

    def client() -> Client:
        def send(body: str) -> str:
            request = urllib.request.Request(url, body.encode(), {"Content-Type": "application/json", "Accept": "application/json"} | (headers or {}))
            with urllib.request.urlopen(request, timeout=timeout) as answer:
                return answer.read().decode("utf-8", "replace")

        return send

    return client


class _Pool:
    """Calls go round the endpoints; one that fails or is late passes its call on to the next, and a late answer counts while the others are asked. After `dead_after`
    failures in a row an endpoint is asked last, and again first once it has answered in time."""

    def __init__(self, clients: Sequence[Client], timeout: float, dead_after: int, in_flight: int) -> None:
        self.clients, self.timeout, self.dead_after = clients, timeout, dead_after
        self.failures, self.turn, self.lock = [0] * len(clients), itertools.count(), threading.Lock()
        self.calls = ThreadPoolExecutor(in_flight * (len(clients) + 1))  # late calls keep a thread until they end

    def _failed(self, i: int) -> None:
        with self.lock:
            self.failures[i] += 1

    def __call__(self, body: str) -> str:
        with self.lock:
            first = next(self.turn)
            order = sorted(range(len(self.clients)), key=lambda i: (self.failures[i] >= self.dead_after, (i - first) % len(self.clients)))
        asked, errors, end = {}, {}, time.monotonic() + self.timeout * len(order)
        for i in order:
            began = time.monotonic()
            own = self.calls.submit(self.clients[i], body)
            asked[own] = i, began
            last = i == order[-1]
            until = end if last else began + self.timeout
            while asked if last else own in asked:
                done = wait(asked, max(0, until - time.monotonic()), FIRST_COMPLETED).done
                if not done:
                    break
                for call in done:
                    at, since = asked.pop(call)
                    if call.exception() is None:
                        if time.monotonic() - since <= self.timeout:
                            with self.lock:
                                self.failures[at] = 0
                        for other in asked:
                            other.cancel()  # where it has no thread yet
                        return call.result()
                    if at not in errors:
                        self._failed(at)
                    errors[at] = f"{type(call.exception()).__name__}: {call.exception()}"
            if own in asked:
                self._failed(i)
                errors[i] = f"no answer in {self.timeout:g} s"
        for other in asked:
            other.cancel()
        raise ConnectionError("; ".join(errors[i] for i in order))


def pooled(makers: Sequence[Callable[[], Client]], *, in_flight: int = 4, timeout: float = 120.0, dead_after: int = 3) -> Callable[[], Client]:
    """A maker of clients over several endpoints, for responses.call(in_flight=...): calls are dealt over the endpoints, each has `timeout` seconds an endpoint, and
    fails only where all have failed it or none has answered within their seconds together."""
    if not makers:
        raise ValueError("no endpoint is configured")
    return lambda: _Pool([m() for m in makers], timeout, dead_after, in_flight)


def policy_pool(urls: Sequence[str], own: str | None = None, *, every: bool = False) -> list[str]:
    """The URLs that a run's calls go to: all that aren't blank, each once, if the pool is on; else its own, or the first."""
    found = list(dict.fromkeys(u.strip() for u in urls if u and u.strip()))
    if every and found:
        return found
    if own and own.strip():
        return [own.strip()]
    if not found:
        raise ValueError("no endpoint is configured")
    return found[:1]


def chat(url: str, model: str, messages: Sequence[dict[str, str]], **how) -> str:
    """One call outside of tables, to try an endpoint."""
    return http_client(url, **how)()(json.dumps({"model": model, "messages": list(messages), "temperature": 0.2, "stream": False}, ensure_ascii=False))
