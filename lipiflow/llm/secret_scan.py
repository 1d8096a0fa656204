"""Secret scan with multipart credential linking.

Base patterns report on their own.  Weak candidates (random-looking tokens,
account names, endpoints) are reported only when complementary parts of one
credential stand within a scope: the parts of a text are sorted by position and
joined by interval: a part is reported if any complementary part, whatever lies
between or around them, overlaps its scope.

A text's parts all stand in that text, so the join runs where the text is read and
nothing moves; as positions come from regular expressions over whole texts, it is
Python code in an Arrow stage, with one sorted pass per text.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lipiflow.llm.common import documents

#: Parts at most this many characters apart are in one scope.
SCOPE = 200
# The base patterns and the kinds in their order.
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "weak_secret", "weak_id", "weak_endpoint")
WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

# Weak parts.
TOKEN = re.compile(r"[A-Za-z0-9+/_-]{20,}")
ACCOUNT = re.compile(r"""(?i:user(?:name)?|login|account|client_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}""", re.A)
ENDPOINT = re.compile(r"""[a-z][a-z0-9+.-]*://[^\s"'<>]{4,}|(?i:host|endpoint|server)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._:-]{4,}""", re.A)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    low = text.lower()
    out = []
    if any(w in low for w in WORDS):
        out += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return out


class Parts:
    """Spans by start, with the furthest end so far, so one look tells whether any of them meets an interval."""

    def __init__(self, spans: list[tuple[int, int, str]]):
        self.starts = sorted(s[0] for s in spans)
        self.furthest = list(accumulate((s[1] for s in sorted(spans)), max))

    def touch(self, start: int, end: int) -> bool:
        """Whether a span begins at ``end`` or before and ends at ``start`` or after."""
        i = bisect_right(self.starts, end)
        return i > 0 and self.furthest[i - 1] >= start

    def overlap(self, start: int, end: int) -> bool:
        i = bisect_left(self.starts, end)
        return i > 0 and self.furthest[i - 1] > start


def linked_spans(text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Weak parts that a complementary part stands near to."""
    ids = [p for p in base if p[2] == "access"]
    accounts = [(m.start(), m.end(), "weak_id") for m in ACCOUNT.finditer(text)] if re.search(r"(?i)user|login|account|client", text) else []
    points = [(m.start(), m.end(), "weak_endpoint") for m in ENDPOINT.finditer(text)] if "://" in text or re.search(r"(?i)(?:host|endpoint|server)[\"']?\x20*[:=]", text) else []
    if not (base or accounts or points):
        return []
    taken = Parts(base + accounts + points)
    tokens = [(m.start(), m.end(), "weak_secret") for m in TOKEN.finditer(text) if any(c.isdigit() for c in m[0]) and any(c.isalpha() for c in m[0])]
    tokens = [t for t in tokens if not taken.overlap(t[0], t[1])]
    secrets, names = Parts([p for p in base if p[2] != "access"] + tokens), Parts(ids + accounts + points)
    out = [t for t in tokens if names.touch(t[0] - SCOPE, t[1] + SCOPE)]
    return out + [p for p in accounts + points if secrets.touch(p[0] - SCOPE, p[1] + SCOPE)]


def _joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1])))


def _scan(batches):
    import pyarrow as pa

    for batch in batches:
        texts = [t or "" for t in batch.column("_text").to_pylist()]
        base = [base_spans(t) for t in texts]
        more = [linked_spans(t, b) for t, b in zip(texts, base)]
        count = lambda kind: pa.array([sum(s[2] == kind for s in b) for b in base], pa.int64())
        digest = [hashlib.sha256(_joined(b).encode()).hexdigest() for b in base]
        yield pa.RecordBatch.from_arrays(
            [batch.column("_id"), count("assign"), count("access"), count("hex"), pa.array(digest, pa.string()), pa.array([_joined(b + m) for b, m in zip(base, more)], pa.string())],
            ["_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
        )


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: counts and spans (kind:start:end, code points, end exclusive).

    Null texts count as empty and have no spans.  Spans of equal start come in
    the order of KINDS.  Repeated rows are scanned alike; columns of other names
    are ignored; an empty table gives an empty result.  Texts are scanned whole.
    """
    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    out = rows.mapInArrow(_scan, f"_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
    return out.withColumnRenamed("_id", id_col)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir))


def _either(word: str) -> str:
    """A pattern for the word in either case, of ASCII letters only."""
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


def _any(*names: str) -> str:
    return "(?:" + "|".join(map(_either, names)) + ")"


def _sql() -> str:
    assign = _any("password", "passwd", "secret", "token", "api_?key") + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    account = _any("user(?:name)?", "login", "account", "client_?id") + r"""["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}"""
    endpoint = r"""[a-z][a-z0-9+.-]*://[^\x20\x09-\x0D"'<>]{4,}|""" + _any("host", "endpoint", "server") + r"""["']?\x20*[:=]\x20*["']?[A-Za-z0-9._:-]{4,}"""
    patterns = {"assign": assign, "access": "AKIA[A-Z0-9]+", "hex": "[0-9a-f]{32,}", "weak_secret": "[A-Za-z0-9+/_-]{20,}", "weak_id": account, "weak_endpoint": endpoint}
    quoted = {k: v.replace("'", "''") for k, v in patterns.items()}
    found = "\n  UNION ALL ".join(
        f"SELECT doc_id, {nr} AS nr, '{kind}' AS kind, ms, string_split_regex(t, '{p}') AS gaps, {f"regexp_extract_all(t, '{p}', 1)" if kind == "assign" else 'NULL::VARCHAR[]'} AS vs\n"
        f"  FROM (SELECT doc_id, t, regexp_extract_all(t, '{p}') AS ms FROM d) WHERE len(ms) > 0"
        for nr, (kind, p) in enumerate(quoted.items())
    )
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), f AS (
  {found}
), u AS (
  SELECT doc_id, nr, kind, unnest(range(1, len(ms) + 1)) AS i, ms, gaps, vs FROM f
), p AS (
  SELECT doc_id, nr, kind, i, ms[i] AS m, vs[i] AS v, sum(len(gaps[i])) OVER w + sum(len(ms[i])) OVER w AS b
  FROM u WINDOW w AS (PARTITION BY doc_id, nr ORDER BY i)
), s AS (
  SELECT doc_id, nr, kind, b - len(m) AS a, b FROM p
  WHERE CASE kind WHEN 'assign' THEN len(v) >= 8 WHEN 'access' THEN len(m) >= 16 WHEN 'hex' THEN len(m) >= 32
                  WHEN 'weak_secret' THEN regexp_matches(m, '[0-9]') AND regexp_matches(m, '[A-Za-z]') ELSE true END
), free AS (
  SELECT * FROM s WHERE kind <> 'weak_secret'
     OR NOT EXISTS (SELECT 1 FROM s o WHERE o.doc_id = s.doc_id AND o.kind <> 'weak_secret' AND o.a < s.b AND o.b > s.a)
), linked AS (
  SELECT * FROM free x WHERE nr < 3
     OR EXISTS (SELECT 1 FROM free o WHERE o.doc_id = x.doc_id AND o.a <= x.b + {SCOPE} AND o.b >= x.a - {SCOPE}
                AND (o.kind IN ('assign', 'hex', 'weak_secret')) <> (x.kind = 'weak_secret'))
), g AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, nr, b) FILTER (nr < 3) AS base, string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, nr, b) AS spans
  FROM linked GROUP BY doc_id
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (doc_id)
"""


SQL = _sql()
