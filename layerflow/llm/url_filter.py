"""URL rules: a bit-parallel wildcard automaton over canonical URLs.

Every rule is a glob (``*`` any run, ``?`` one byte) that must match the whole
canonical URL, which is the lower-cased host followed by the path. The globs
of all rules are laid side by side in one bit vector of as many 64-bit words as
needed; bit j of a glob says "its first j symbols are matched". One step of
the automaton advances all globs over one byte of all URLs of a batch: a
shift with carries between the words, a mask per byte value, and self-loops at
the stars, those of a host left out at a slash. The number of steps is the length of the longest URL, whatever the
number of rules.

A host rule ``example.com/en/`` becomes two globs, ``example.com/en/*`` and
``*.example.com/en/*``, whose first star stays inside the host: a host named in
the path of another one fits no rule. Of the host rules that fit the longest decides; where
none fits, the plain globs decide: block if one of the block list matches,
else allow.

Defined results: a null URL, or one without ``://``, has an empty host and
path, fits no host rule and is judged by the globs on the empty string;
several rows of one URL get the same answer; bytes are compared, so ``?``
stands for one byte of a non-ASCII character; an empty table gives an empty
result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerflow.llm.common import ship_code

#: The rules of the query, (verdict, host and path prefix).
HOST_RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
              ("block", "net/es/"), ("block", "net/fr/"))
#: What decides where no host rule fits.
BLOCK_GLOBS = ("*spam-farm.*", "*cheap-pills.*", "*casino*", "*/ads/*", "*.exe", "*.zip")


class GlobAutomaton:
    """Bit-parallel simulation of all ``globs`` at once; in the first ``hosts`` of them, no star
    ahead of the first slash runs over a slash."""

    def __init__(self, globs: list[str], hosts: int = 0):
        at, self.final, starts, symbols, loops, inside = 0, [], [], [], [], []
        for number, glob in enumerate(globs):
            starts.append(at)
            in_host = number < hosts
            for c in glob.encode():
                in_host = in_host and c != ord("/")
                if c == ord("*"):
                    (inside if in_host else loops).append(at)
                else:
                    symbols.append((at, c))
                    at += 1
            self.final.append(at)
            at += 1
        self.words = max(1, -(-at // 64))
        self.start = self._bits(starts)
        self.loop = np.tile(self._bits(loops + inside), (256, 1))
        self.loop[ord("/")] = self._bits(loops)
        self.mask = np.zeros((256, self.words), np.uint64)
        for where, c in symbols:
            for byte in range(256) if c == ord("?") else (c,):
                self.mask[byte, where // 64] |= np.uint64(1 << (where % 64))

    def _bits(self, places: list[int]) -> np.ndarray:
        out = np.zeros(self.words, np.uint64)
        for p in places:
            out[p // 64] |= np.uint64(1 << (p % 64))
        return out

    def matches(self, urls: list[bytes]) -> np.ndarray:
        """Boolean matrix: URL by glob."""
        lengths = np.array([len(u) for u in urls], np.int64)
        order = np.argsort(-lengths, kind="stable")
        flat = np.frombuffer(b"".join(urls), np.uint8)
        begins = np.concatenate([[0], np.cumsum(lengths)])[:-1][order] if len(urls) else lengths
        lengths = lengths[order]
        state = np.tile(self.start, (len(urls), 1))
        for step in range(int(lengths[0]) if len(urls) else 0):
            n = int(np.searchsorted(-lengths, -step, side="left"))  # URLs longer than step come first
            now = state[:n]
            byte = flat[begins[:n] + step]
            moved = now & self.mask[byte]
            shifted = moved << np.uint64(1)
            shifted[:, 1:] |= moved[:, :-1] >> np.uint64(63)
            state[:n] = shifted | (now & self.loop[byte])
        out = np.empty((len(urls), len(self.final)), bool)
        for k, f in enumerate(self.final):
            out[order, k] = (state[:, f // 64] >> np.uint64(f % 64)) & np.uint64(1)
        return out


_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def canonical(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path."""
    if url is None:
        return "", ""
    _, mark, rest = url.partition("://")
    if not mark:
        return "", ""
    cut = min((i for i in map(rest.find, "?#") if i >= 0), default=len(rest))
    rest = rest[:cut]
    at = rest.find("/")
    return (rest.translate(_LOWER), "") if at < 0 else (rest[:at].translate(_LOWER), rest[at:])


def judge(pages: DataFrame, rules=HOST_RULES, block_globs=BLOCK_GLOBS) -> DataFrame:
    """page_id, host, path, rule, verdict and the matching block globs of every page."""
    ship_code(pages.sparkSession)
    rules, block_globs = list(rules), list(block_globs)
    ranked = sorted(range(len(rules)), key=lambda k: -len(rules[k][1]))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        globs = [g for _, r in rules for g in (f"{r}*", f"*.{r}*")] + block_globs
        automaton = GlobAutomaton(globs, hosts=2 * len(rules))
        for batch in batches:
            parts = [canonical(u) for u in batch["url"]]
            distinct = list(dict.fromkeys(parts))
            hit = automaton.matches([(h + p).encode() for h, p in distinct])
            fits = hit[:, 0:2 * len(rules):2] | hit[:, 1:2 * len(rules):2]
            listed = hit[:, 2 * len(rules):]
            known = {}
            for k, part in enumerate(distinct):
                best = next((r for r in ranked if part[0] and fits[k, r]), None)
                globs_hit = [g for g, x in zip(block_globs, listed[k], strict=True) if x]
                verdict = rules[best][0] if best is not None else "block" if globs_hit else "allow"
                known[part] = (None if best is None else rules[best][1], verdict, globs_hit)
            rows = [known[part] for part in parts]
            yield pd.DataFrame({"page_id": batch["page_id"], "host": [p[0] for p in parts], "path": [p[1] for p in parts],
                                "rule": [r[0] for r in rows], "verdict": [r[1] for r in rows], "globs": [r[2] for r in rows]})

    kind = dict(pages.dtypes)["page_id"]
    return pages.select("page_id", F.col("url").cast("string")).mapInPandas(
        run, f"page_id {kind}, host string, path string, rule string, verdict string, globs array<string>")


def _sql() -> str:
    rows = ", ".join(f"('{v}', '{r.partition('/')[0]}', '/{r.partition('/')[2]}', '{r}')" for v, r in HOST_RULES)
    likes = " OR ".join(f"host || path LIKE '{g.replace('*', '%')}'" for g in BLOCK_GLOBS)
    return rf"""
WITH u AS (SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN regexp_extract(substr(url, position('://' IN url) + 3), '^[^?#]*') ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, translate(regexp_extract(rest, '^[^/]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             CASE WHEN position('/' IN rest) > 0 THEN substr(rest, position('/' IN rest)) ELSE '' END AS path FROM u),
r(verdict, rhost, rpath, rule) AS (VALUES {rows}),
m AS (SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
      FROM p, r WHERE (host = rhost OR host LIKE '%.' || rhost) AND path LIKE rpath || '%' GROUP BY page_id)
SELECT p.page_id, host, path, rule, coalesce(verdict, CASE WHEN {likes} THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN m USING (page_id)"""


SQL = _sql()
