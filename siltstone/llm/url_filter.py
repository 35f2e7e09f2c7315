"""URL filters: many glob rules over each canonical URL by one bit-parallel automaton.

A glob is matched against the whole canonical URL, ``.host/path`` with the host lower-cased and a
leading dot, so that ``*.org/**`` fits org and all its subdomains. ``**`` stands for any run of
bytes, ``*`` for any run without ``/``, ``?`` for one byte but ``/``; all else stands for itself.

All globs are packed into multiword Shift-And masks: one bit for each literal position of each glob
(plus a start bit), 64 bits a word. For an input byte c every state advances at once by

    D = ((D << 1) | carries) & B[c]  |  D & L[c]

where B holds the positions that c may enter and L the positions with a star behind them that c may
stay in. Batches of URLs run side by side as numpy rows, longest first, so that a step touches only
the URLs that still have a byte; long URLs are matched whole.

Defined cases: a null URL, or one without ``://``, has an empty host and path and matches only globs
that fit ``.``; repeated rows and equal URLs are judged alike; empty input gives no rows; other columns pass through,
but for those named like result columns.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.llm.registry import query
from siltstone.session import table


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path columns: both empty for null or without ``://``; only A-Z are lower-cased."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(host, upper, lower), path


#: Bytes of states that are simulated at a time.
STATES = 32 << 20


class GlobAutomaton:
    """Shift-And masks of all globs, and the vectorised simulation."""

    def __init__(self, globs: list[str]):
        states: list[tuple[int | None, int]] = []  # for each bit: the byte to enter it (-1: any but /, None: start), the star behind it
        self.first, self.last = [], []
        for g in globs:
            states.append((None, 0))
            self.first.append(len(states) - 1)
            raw, i = g.encode(), 0
            while i < len(raw):
                if raw[i : i + 2] == b"**":
                    states[-1] = (states[-1][0], 2)
                    i += 2
                elif raw[i : i + 1] == b"*":
                    states[-1] = (states[-1][0], max(1, states[-1][1]))
                    i += 1
                else:
                    states.append((-1 if raw[i : i + 1] == b"?" else raw[i], 0))
                    i += 1
            self.last.append(len(states) - 1)
        self.words = max(1, -(-len(states) // 64))
        self.enter, self.stay = np.zeros((256, self.words), np.uint64), np.zeros((256, self.words), np.uint64)
        self.start = np.zeros(self.words, np.uint64)
        # Each glob ends in a state of its own.
        self.accept, self.glob_of = np.zeros(self.words, np.uint64), np.full(64 * self.words, -1)
        for j, k in enumerate(self.last):
            self.accept[k // 64] |= np.uint64(1 << (k % 64))
            self.glob_of[k] = j
        for k, (byte, star) in enumerate(states):
            w, bit = k // 64, np.uint64(1 << (k % 64))
            if byte is None:
                self.start[w] |= bit
            elif byte == -1:
                self.enter[:, w] |= bit
                self.enter[ord("/"), w] &= ~bit
            else:
                self.enter[byte, w] |= bit
            if star:
                self.stay[:, w] |= bit
            if star == 1:
                self.stay[ord("/"), w] &= ~bit

    def _end(self, urls: list[bytes]) -> np.ndarray:
        """The states after the whole of each URL."""
        n, size = len(urls), np.fromiter(map(len, urls), np.int64, len(urls))
        order = np.argsort(-size, kind="stable")
        flat, at = np.frombuffer(b"".join(urls), np.uint8), np.concatenate([[0], np.cumsum(size)])[:-1][order]
        size = size[order]
        d = np.tile(self.start, (n, 1))
        alive = np.searchsorted(-size, -np.arange(int(size[0]) if n else 0), side="left")  # how many have over t bytes
        one, top = np.uint64(1), np.uint64(63)
        for t, k in enumerate(alive.tolist()):
            c, now = flat[at[:k] + t], d[:k]
            up = now << one
            up[:, 1:] |= now[:, :-1] >> top
            d[:k] = (up & self.enter[c]) | (now & self.stay[c])
        out = np.empty_like(d)
        out[order] = d
        return out

    def found(self, urls: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(URL, glob) pairs of whole fits, in order; as many URLs at a time as STATES bytes of states hold."""
        step = max(1, STATES // (8 * self.words))
        rows, globs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for lo in range(0, len(urls), step):
            hits = self._end(urls[lo : lo + step]) & self.accept
            r, w = np.nonzero(hits)
            for bit in range(64):
                on = (hits[r, w] >> np.uint64(bit)) & np.uint64(1) == 1
                rows.append(r[on] + lo)
                globs.append(self.glob_of[w[on] * 64 + bit])
        row, glob = np.concatenate(rows), np.concatenate(globs)
        order = np.lexsort((glob, row))
        return row[order], glob[order]

    def match(self, urls: list[bytes]) -> np.ndarray:
        """bool matrix: does URL i fit glob j as a whole?"""
        out = np.zeros((len(urls), len(self.last)), bool)
        out[self.found(urls)] = True
        return out


def match_globs(df: DataFrame, host: str, path: str, globs: list[str], out: str = "globs") -> DataFrame:
    """df with the array<int> of the globs (positions in the list) that fit each URL's host and path."""
    kept = [c for c in df.columns if c != out]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton = GlobAutomaton(globs)
        for b in batches:
            urls = [f".{h}{p}".encode() for h, p in zip(b[host].fillna(""), b[path].fillna(""), strict=True)]
            row, glob = automaton.found(urls)
            b[out] = np.split(glob.astype(np.int32), np.searchsorted(row, np.arange(1, len(urls)))) if urls else []
            yield b

    return df.select(*kept).mapInPandas(run, T.StructType([*df.select(*kept).schema.fields, T.StructField(out, T.ArrayType(T.IntegerType()))]))


def filter_urls(df: DataFrame, url: str, rules: list[tuple[bool, str, str]], blocked: list[str]) -> DataFrame:
    """df with host, path, rule and verdict.

    rules: (allow, host, path) - each fits its host and all subdomains where the path starts with the
    rule's; of those that fit, the longest (host and path together, then the earliest) decides.
    blocked: globs that block a URL which no rule fits; what fits nothing is allowed.
    """
    best = sorted(rules, key=lambda r: -len(r[1] + r[2]))  # stable: the earliest of equals first
    globs = [f"*.{h}{p}**" for _, h, p in best] + blocked
    host, path = split_url(F.col(url))
    kept = [c for c in df.columns if c not in ("host", "path", "rule", "verdict", "globs")]
    found = match_globs(df.select(*kept, host.alias("host"), path.alias("path")), "host", "path", globs)
    # Rules come first, in the order in which they win: the least place that is a rule's decides.
    place = F.array_min("globs")
    of = lambda values, otherwise: F.when(place < len(best), F.get(F.array(*map(F.lit, values)), place)).otherwise(otherwise) if best else otherwise
    default = F.when(F.size("globs") > 0, "block").otherwise("allow")
    return found.select(
        *kept,
        "host",
        "path",
        of([h + p for _, h, p in best], F.lit(None).cast("string")).alias("rule"),
        of(["allow" if a else "block" for a, _, _ in best], default).alias("verdict"),
    )


#: allow or block, host, path
RULES = [(True, "org", "/"), (False, "example.org", "/es/"), (False, "example.org", "/en/1"), (True, "com", "/fr/"), (False, "com", "/de/")]
#: The method's own globs: tracking hosts, advertising paths, and archives.
BLOCKED = ["**/ads/**", ".ads.*/**", "**/**.zip", "**/**.exe"]


@query(
    "op5_url_filter",
    """
    WITH u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
    h AS (SELECT page_id, translate(regexp_extract(rest, '(?s)^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                 regexp_extract(rest, '(?s)^[^/?#]*([^?#]*)', 1) AS path FROM u),
    r AS (SELECT *, '.' || host AS dotted, CASE
            WHEN ('.' || host) LIKE '%.example.org' AND starts_with(path, '/es/') THEN 'example.org/es/'
            WHEN ('.' || host) LIKE '%.example.org' AND starts_with(path, '/en/1') THEN 'example.org/en/1'
            WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/fr/') THEN 'com/fr/'
            WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/de/') THEN 'com/de/'
            WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/') THEN 'org/' END AS rule FROM h)
    SELECT page_id, host, path, rule, CASE
            WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN path LIKE '%/ads/%' OR (host LIKE 'ads.%' AND path <> '') OR path LIKE '/%.zip' OR path LIKE '/%.exe' THEN 'block'
            ELSE 'allow' END AS verdict
    FROM r
    """,
)
def op5_url_filter(spark, sf):
    """Judges every page's url by the rules, else by the method's globs."""
    return filter_urls(table(spark, sf, "pages").select("page_id", "url"), "url", RULES, BLOCKED).drop("url")
