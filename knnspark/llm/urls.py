"""URL rules looked up by their rarest literal token.

A rule is a host suffix and a path prefix.  Its literal tokens are its host labels and the complete
segments of its path.  Spark counts in how many URLs each rule token occurs, and every rule is filed
under its rarest one.  The tokens of a URL fetch the candidate rules, and only those run their
regular expression.  The longest rule that fits decides; a URL that no rule fits gets the default.

Defined results: the host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end,
A-Z lower-cased; the path goes on from there to ``?``, ``#`` or the end.  A null URL, or one without
``://``, has an empty host and path and no rule.  Repeated rows, repeated or null ids are judged
row by row; ties between rules of one length go to the longer host, then to the smaller text; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from knnspark.llm.common import pieces

_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(ord("A"), ord("Z") + 1)})
_HOST = re.compile(r"[^/?#]*")
_PATH = re.compile(r"[^?#]*")


@dataclass(frozen=True)
class UrlRule:
    """``host`` and its subdomains, paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    @property
    def pattern(self) -> str:
        return rf"(?:.*\.)?{re.escape(self.host)}\x00{re.escape(self.path)}"

    def tokens(self) -> list[str]:
        """Host labels, and path segments that the rule closes with a slash."""
        return [f"h:{x}" for x in self.host.split(".") if x] + [f"p:{x}" for x in self.path.split("/")[1:-1] if x]


def parts(url: str | None) -> tuple[str, str]:
    """Host and path of a URL."""
    at = (url or "").find("://")
    if at < 0:
        return "", ""
    host = _HOST.match(url, at + 3)
    return host.group().translate(_LOWER), _PATH.match(url, host.end()).group()


def url_tokens(host: str, path: str) -> set[str]:
    return {f"h:{x}" for x in host.split(".")} | {f"p:{x}" for x in path.split("/")}


def _hosts_and_paths(batch: pa.RecordBatch, at: int) -> list[tuple[str, str]]:
    return [parts(u) for u in batch.column(at).to_pylist()]


def token_counts(urls: DataFrame, column: str, rules: list[UrlRule]) -> dict[str, int]:
    """In how many URLs each token of a rule occurs (a row for each rule token goes to the driver)."""
    wanted = {t for r in rules for t in r.tokens()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[str, int] = {}
            for host, path in _hosts_and_paths(batch, 0):
                for t in url_tokens(host, path) & wanted:
                    found[t] = found.get(t, 0) + 1
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())],
                                             names=["token", "n"])

    rows = urls.select(column).mapInArrow(run, "token string, n long").groupBy("token").agg(F.sum("n").alias("n")).collect()
    return {r["token"]: r["n"] for r in rows}


def index_rules(rules: list[UrlRule], counts: dict[str, int]) -> dict[str, list[UrlRule]]:
    """Rules by their rarest token; those without a token are filed under "" and always tried."""
    index: dict[str, list[UrlRule]] = {}
    for rule in rules:
        tokens = rule.tokens()
        key = min(tokens, key=lambda t: (counts.get(t, 0), t)) if tokens else ""
        index.setdefault(key, []).append(rule)
    return index


def judge(urls: DataFrame, rules: list[UrlRule], default: str = "allow", id_column: str = "page_id",
          url_column: str = "url") -> DataFrame:
    """(id, host, path, rule, verdict) of every row."""
    index = index_rules(rules, token_counts(urls, url_column, rules))
    patterns = {r: r.pattern for r in rules}
    id_type = urls.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = {r: re.compile(p, re.DOTALL) for r, p in patterns.items()}
        for batch in pieces(batches, 8192):
            found = _hosts_and_paths(batch, 1)
            names: list[str | None] = []
            verdicts = []
            for host, path in found:
                candidates = [r for t in url_tokens(host, path) | {""} for r in index.get(t, ())]
                key = f"{host}\x00{path}"
                fits = [r for r in candidates if compiled[r].match(key)]
                best = min(fits, key=lambda r: (-len(r.text), -len(r.host), r.text), default=None)
                names.append(best.text if best else None)
                verdicts.append(best.verdict if best else default)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([h for h, _ in found], pa.string()), pa.array([p for _, p in found], pa.string()),
                 pa.array(names, pa.string()), pa.array(verdicts, pa.string())],
                names=[id_column, "host", "path", "rule", "verdict"])

    return urls.select(id_column, url_column).mapInArrow(
        run, f"`{id_column}` {id_type}, host string, path string, rule string, verdict string")
