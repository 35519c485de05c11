"""Driver-side fetching of pages, politely: token buckets, robots rules, retries, counters. The network itself is a callable that is passed in."""

from __future__ import annotations

import random
import re
import threading
import time
from collections import Counter
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from typing import Any, NamedTuple
from urllib.parse import urlsplit


class TokenBucket:
    """Takes at `rate` a second with bursts of `burst`; waits are jittered by the given share. Safe across threads."""

    def __init__(self, rate: float, burst: int = 1, jitter: float = 0.3, clock: Callable[[], float] = time.monotonic, rng: random.Random | None = None):
        self.rate, self.burst, self.jitter, self.clock, self.rng = rate, burst, jitter, clock, rng or random.Random()
        self.tokens, self.at, self.lock = float(burst), clock(), threading.Lock()

    def wait(self) -> float:
        """Seconds to wait before the next request; the request counts as made."""
        with self.lock:
            now = self.clock()
            self.tokens = min(self.burst, self.tokens + (now - self.at) * self.rate)
            self.at = now
            self.tokens -= 1
            due = max(0.0, -self.tokens / self.rate)
        return due * (1 + self.jitter * (2 * self.rng.random() - 1)) if due else 0.0


class Robots:
    """The rules of a robots.txt for one agent: the longest matching rule wins, allow before disallow; an empty file allows all."""

    def __init__(self, text: str, agent: str):
        self.rules, self.delay, self.sitemaps = [], None, re.findall(r"(?im)^\s*sitemap:\s*(\S+)", text or "")
        groups: list[tuple[set[str], list[tuple[str, str]]]] = []
        open_group = False
        for line in (text or "").splitlines():
            key, _, value = line.split("#")[0].partition(":")
            key, value = key.strip().lower(), value.strip()
            if key == "user-agent":
                if not open_group:
                    groups.append((set(), []))
                groups[-1][0].add(value.lower())
                open_group = True
            elif key in ("allow", "disallow", "crawl-delay") and groups:
                groups[-1][1].append((key, value))
                open_group = False
        own = [g for names, g in groups if any(n != "*" and n in agent.lower() for n in names)] or [g for names, g in groups if "*" in names]
        for key, value in (x for g in own for x in g):
            if key == "crawl-delay":
                self.delay = float(value) if re.fullmatch(r"\d+(\.\d+)?", value) else self.delay
            elif value:
                pattern = re.escape(value).replace(r"\*", ".*")
                self.rules.append((len(value), key == "allow", re.compile(pattern[:-2] + "$" if pattern.endswith(r"\$") else pattern)))

    def allows(self, path: str) -> bool:
        hits = [(n, allow) for n, allow, p in self.rules if p.match(path)]
        return max(hits)[1] if hits else True


# Requests a second of a domain unless told otherwise, tries after the first, hours for which robots rules are kept.
RATE, RETRIES, ROBOTS_HOURS = 0.5, 3, 24


class Page(NamedTuple):
    status: int
    headers: dict[str, str]
    body: str


class Refused(Exception):
    """The site's rules don't allow the address."""


class Failed(Exception):
    """The address gave no page."""


@dataclass
class Counters:
    """What a fetcher did: pages from the network by domain, from the cache, tries again, refusals, failures, seconds waited."""

    fetched: Counter = field(default_factory=Counter)
    cached: int = 0
    retried: int = 0
    refused: int = 0
    failed: int = 0
    waited: float = 0.0


def pause(tries: int, retry_after: str | None, rng: random.Random) -> float:
    """Seconds before the next try: what the server asks for in seconds, else doubling with a quarter of jitter."""
    asked = re.fullmatch(r"\s*(\d+(?:\.\d+)?)\s*", retry_after or "")
    return float(asked.group(1)) if asked else 2.0**tries * rng.uniform(0.75, 1.25)


class Fetcher:
    """Pages for addresses: from the cache, else, if robots rules allow, from the network at the domain's rate.

    `transport` takes an address and gives a `Page` or raises. Answers 429 and 5xx and exceptions are
    tried again, other errors are not. A domain's rules are kept for ROBOTS_HOURS; where they can't be
    had everything is allowed. A delay they ask for only ever makes requests rarer.
    """

    def __init__(self, transport: Callable[[str], Page], agent: str, cache: dict[str, Page] | None = None, rates: dict[str, float] | None = None, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep, rng: random.Random | None = None):
        self.transport, self.agent, self.cache, self.rates, self.clock, self.sleep, self.rng = transport, agent, cache, rates or {}, clock, sleep, rng or random.Random()
        self.counters, self.buckets, self.rules = Counters(), {}, {}

    def _rules(self, site: str) -> Robots:
        known = self.rules.get(site)
        if known is None or self.clock() - known[0] >= ROBOTS_HOURS * 3600:
            try:
                page = self.transport(f"{site}/robots.txt")
                text = page.body if page.status < 400 else ""
            except Exception:  # noqa: BLE001
                text = ""
            known = self.rules[site] = (self.clock(), Robots(text, self.agent))
        return known[1]

    def _wait(self, domain: str, rules: Robots) -> None:
        if domain not in self.buckets:
            rate = self.rates.get(domain, RATE)
            self.buckets[domain] = TokenBucket(min(rate, 1 / rules.delay) if rules.delay else rate, clock=self.clock, rng=self.rng)
        self._sleep(self.buckets[domain].wait())

    def _sleep(self, seconds: float) -> None:
        if seconds > 0:
            self.counters.waited += seconds
            self.sleep(seconds)

    def get(self, url: str) -> Page:
        if self.cache is not None and url in self.cache:
            self.counters.cached += 1
            return self.cache[url]
        parts = urlsplit(url)
        rules = self._rules(f"{parts.scheme}://{parts.netloc}")
        if not rules.allows((parts.path or "/") + (f"?{parts.query}" if parts.query else "")):
            self.counters.refused += 1
            raise Refused(url)
        for tries in range(RETRIES + 1):
            self._wait(parts.netloc, rules)
            try:
                page, told = self.transport(url), None
            except Exception as e:  # noqa: BLE001
                page, told = None, e
            if page is not None and page.status < 400:
                self.counters.fetched[parts.netloc] += 1
                if self.cache is not None:
                    self.cache[url] = page
                return page
            if page is not None and page.status != 429 and page.status < 500 or tries == RETRIES:
                break
            self.counters.retried += 1
            self._sleep(pause(tries, page.headers.get("Retry-After") if page else None, self.rng))
        self.counters.failed += 1
        raise Failed(f"{url}: {page.status if page else told}")


def drain_addresses(pending: Iterable[str], get: Callable[[str], Page], keep: Callable[[str, Page], int], mark: Callable[[str, str, str], Any], budget: int) -> Counter:
    """Counts by outcome after at most `budget` addresses: each is fetched, handed to `keep`, which tells how many postings it gave, and marked.

    Whatever goes wrong with one address marks it as failed with a note; the others go on. An address is
    marked only after its postings are kept, so that a run that is cut off takes it up again.
    """
    done: Counter = Counter()
    for url, _ in zip(pending, range(budget), strict=False):
        try:
            n = keep(url, get(url))
            mark(url, "done", "" if n else "no postings")
            done.update(addresses=1, postings=n)
        except Exception as e:  # noqa: BLE001
            mark(url, "failed", f"{type(e).__name__}: {e}"[:200])
            done["failed"] += 1
    return done
