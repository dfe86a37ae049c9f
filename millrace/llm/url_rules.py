"""URL rules by a bit-parallel wildcard automaton.

All glob patterns stand side by side in the bits of a multiword Shift-And state: one bit for each position of each pattern.
A step shifts the state, masks it with the positions that take the character, and keeps the positions of a
wildcard. Each URL has its own state words; all URLs of a batch step together.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Stands between host and path; no byte of a text (those are 1 to 256).
SEPARATOR = 0
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

Rule = tuple[str, str]


class ShiftAnd:
    """rules: "host/path" globs; * is any run within the host or within the path, ? one character. A rule
    takes its host and all subdomains, and all paths that start with its path."""

    def __init__(self, rules: list[str]):
        positions: list[tuple[set[int], set[int]]] = []  # taken by a step into the position, kept by a wildcard there
        inside, last = set(range(1, 257)), []
        starts = []
        for rule in rules:
            host, _, path = rule.partition("/")
            starts.append(len(positions))
            positions.append((set(), set(inside)))  # the pattern's start: any labels before
            for part in (b"." + host.encode(), None, b"/" + path.encode()):
                if part is None:
                    positions.append(({SEPARATOR}, set()))
                    continue
                for byte in part:
                    if byte == ord("*"):
                        positions[-1] = (positions[-1][0], set(inside))
                    else:
                        positions.append((set(inside) if byte == ord("?") else {byte + 1}, set()))
            positions[-1] = (positions[-1][0], set(inside))
            last.append(len(positions) - 1)
        words = max(1, -(-len(positions) // 64))
        self.take, self.keep = np.zeros((257, words), np.uint64), np.zeros((257, words), np.uint64)
        self.first = np.zeros(words, np.uint64)
        for p, (taken, kept) in enumerate(positions):
            bit = np.uint64(1 << (p % 64))
            self.take[sorted(taken), p // 64] |= bit
            self.keep[sorted(kept), p // 64] |= bit
        for p in starts:
            self.first[p // 64] |= np.uint64(1 << (p % 64))
        self.last = last

    def matches(self, hosts: list[str], paths: list[str]) -> np.ndarray:
        """hits[i, r]: whether rule r takes URL i."""
        codes = [np.concatenate([np.frombuffer(b"." + h.encode(), np.uint8).astype(np.int16) + 1, [SEPARATOR], np.frombuffer(p.encode(), np.uint8).astype(np.int16) + 1]) for h, p in zip(hosts, paths, strict=True)]
        order = np.argsort([-len(c) for c in codes], kind="stable")
        lengths = np.array([len(codes[i]) for i in order], np.int64)
        flat = np.concatenate([codes[i] for i in order]).astype(np.int64) if len(order) else np.zeros(0, np.int64)
        begin = np.cumsum(lengths) - lengths
        state = np.repeat(self.first[None, :], len(codes), axis=0)
        for step in range(int(lengths.max(initial=0))):
            n = int(np.searchsorted(-lengths, -step, side="left"))  # the URLs longer than step
            at = flat[begin[:n] + step]
            now = state[:n]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[:n] = (moved & self.take[at]) | (now & self.keep[at])
        out = np.zeros((len(codes), len(self.last)), bool)
        for r, p in enumerate(self.last):
            out[order, r] = (state[:, p // 64] >> np.uint64(p % 64)) & np.uint64(1) == 1
        return out


def judge(df: DataFrame, rules: list[Rule], url_col: str = "url", default: str = "allow") -> DataFrame:
    """df with host, path, rule and verdict. rules: ("allow" or "block", "host/path"); the longest that fits wins, at equal
    length the one with the longer host, then the earlier one. A URL that none fits has a null rule and the default verdict.

    Null, empty and malformed URLs have an empty host and path. Columns of df named like a result are replaced;
    repeated rows are judged alike; an empty table gives an empty table.
    """
    ranked = sorted(range(len(rules)), key=lambda i: (-len(rules[i][1]), -len(rules[i][1].partition("/")[0]), i))
    automaton = ShiftAnd([rules[i][1] for i in ranked])

    @F.pandas_udf("int")
    def best(host: pd.Series, path: pd.Series) -> pd.Series:
        hits = automaton.matches(host.tolist(), path.tolist())
        return pd.Series(np.where(hits.any(axis=1), hits.argmax(axis=1), -1) if hits.shape[1] else np.full(len(host), -1))

    url = F.col(url_col)
    known = F.instr(url, "://") > 0
    out = df.drop(*({"host", "path", "rule", "verdict"} - {url_col})).withColumn("_rest", F.when(known, F.expr(f"substring(`{url_col}`, instr(`{url_col}`, '://') + 3)")).otherwise(F.lit("")))
    out = out.withColumn("_raw", F.regexp_extract("_rest", r"^[^/?#]*", 0))
    out = out.withColumn("path", F.regexp_extract(F.expr("substring(_rest, length(_raw) + 1)"), r"^[^?#]*", 0)).withColumn("host", F.translate("_raw", UPPER, LOWER))
    out = out.withColumn("_best", best("host", "path") + 1)
    names, verdicts = F.array(F.lit(None).cast("string"), *(F.lit(rules[i][1]) for i in ranked)), F.array(F.lit(default), *(F.lit(rules[i][0]) for i in ranked))
    return out.withColumn("rule", names[F.col("_best")]).withColumn("verdict", verdicts[F.col("_best")]).drop("_rest", "_raw", "_best")


RULES: list[Rule] = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]


def op2_query(spark, sf_dir: str) -> DataFrame:
    from millrace.llm.shared import table

    return judge(table(spark, sf_dir, "pages").select("page_id", "url"), RULES).select("page_id", "host", "path", "rule", "verdict")


OP2_SQL = """
WITH u AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), h AS (
  SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM u
), p AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h
), r AS (
  SELECT *, CASE
    WHEN (host = 'www.example.com' OR suffix(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR suffix(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'net' OR suffix(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR suffix(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'com' OR suffix(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule FROM p
)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict FROM r
"""
