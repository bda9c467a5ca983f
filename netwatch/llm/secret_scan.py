"""Secret scan by multipart credential linking.

A text is scanned once for *parts*. Base patterns (assignments, access ids,
long hexadecimal strings) are reported as they are. Weak candidates are
reported only when a complementary part co-occurs: a secret with an access
identifier or an endpoint, an identifier or an endpoint with a secret. Base
spans count as parts too (an access id identifies, the others are secrets).

Co-occurrence is an interval join: two parts meet when they lie in the same
scope (a paragraph: text between blank lines) with at most ``REACH`` code
points between them. Parts are dealt to cells of ``CELL`` code points, a
weak part also to the cells within its reach, and joined on text and cell.
Parts of one kind do not overlap and have a least length, so a cell holds a
bounded number of them and a long text is spread over many cells. The join
asks whether a partner exists and emits no pairs.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batch, materialise, slices, small, table

REACH = 200
CELL = 256
MIN_BITS = 3.0        # Shannon entropy per character of a bare secret

# The base patterns and their least lengths.
ASSIGN = re.compile(
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")    # a maximal run, so its length may be asked for while matching
ASSIGN_CHARS, ACCESS_CHARS = 6, 20

# Weak candidates, by the role they play. Each captures its span as group 1.
IDENTIFIER = re.compile(
    r"""\b((?i:user_?name|user|login|account_?id|client_?id|app_?id|access_?key_?id|key_?id|tenant_?id)"""
    r"""["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,})|\b((?:AKIA|ASIA|AIDA|AROA)[A-Z0-9]{8,})\b""", re.ASCII)
SECRET = re.compile(
    r"""\b((?i:pwd|pass|passphrase|credentials?|private_?key|access_?key|signature|bearer)"""
    r"""["']?(?:\x20*[:=]\x20*|\x20)["']?[A-Za-z0-9+/_.=-]{6,})|(?<![A-Za-z0-9+/_=.-])([A-Za-z0-9+/_=-]{16,})""", re.ASCII)
ENDPOINT = re.compile(
    r"""\b((?:postgres(?:ql)?|mysql|mongodb(?:\+srv)?|redis|amqps?|jdbc:[a-z]+|ldaps?|sftp|ssh|s3)://[^\s"'<>]{3,}"""
    r"""|https?://[^\s"'<>/]*(?:@|:[0-9]{2,5}|(?:api|auth|login|sso|oauth|vault|db|sql)[.-])[^\s"'<>]*"""
    r"""|(?i:host|hostname|endpoint|server)["']?\x20*[:=]\x20*["']?[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+(?::[0-9]{2,5})?)""",
    re.ASCII)
_SIGN = re.compile(r"[:=]")
_BLANK = re.compile(r"\n[\x20\t\r]*\n")

KINDS = ("assign", "access", "hex", "identifier", "secret", "endpoint")
ROLE = {"assign": "secret", "access": "identifier", "hex": "secret",
        "identifier": "identifier", "secret": "secret", "endpoint": "endpoint"}


def entropy(text: str) -> float:
    """Shannon entropy of the characters, in bits."""
    return -sum(n / len(text) * math.log2(n / len(text)) for n in Counter(text).values())


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """kind, start, end (code points) of the base matches, by start, then
    kind. The leftmost non-overlapping matches of a kind are taken first,
    then those that are too short are dropped."""
    found = []
    if _SIGN.search(text):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[1]) >= ASSIGN_CHARS]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_CHARS]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def weak_spans(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Weak candidates that overlap no base match: identifiers, secrets
    (bare ones need letters of both cases, digits and entropy), endpoints."""
    starts = [start for _, start, _ in base]
    reached = list(accumulate((end for _, _, end in base), max))
    found = []
    for kind, pattern in (("identifier", IDENTIFIER), ("secret", SECRET), ("endpoint", ENDPOINT)):
        for m in pattern.finditer(text):
            span = m.span(m.lastindex)
            if kind == "secret" and m.lastindex == 2 and not _random(m[2]):
                continue
            before = bisect_left(starts, span[1])
            if not before or reached[before - 1] <= span[0]:
                found.append((kind, *span))
    return found


def _random(text: str) -> bool:
    return (any(c.islower() for c in text) and any(c.isupper() for c in text)
            and any(c.isdigit() for c in text) and entropy(text) >= MIN_BITS)


def scopes(text: str, spans: list[tuple[str, int, int]]) -> list[int]:
    """Number of the paragraph in which each span starts."""
    ends = [m.end() for m in _BLANK.finditer(text)]
    return [bisect_right(ends, start) for _, start, _ in spans]


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


_SPAN = pa.struct([("start", pa.int32()), ("rank", pa.int32()), ("end", pa.int32()), ("scope", pa.int32())])


def scanned(docs: DataFrame) -> DataFrame:
    """row (a number of its own), doc_id, n_assign, n_access, n_hex,
    base_sha256, base and weak (arrays of spans; weak only where some other
    part plays the complementary role anywhere in the text)."""
    kind = pa.schema([("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()),
                      ("n_hex", pa.int64()), ("base_sha256", pa.string()),
                      ("base", pa.list_(_SPAN)), ("weak", pa.list_(_SPAN))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches):
            out = []
            for text in rows.column(1).to_pylist():
                text = text or ""
                base = base_spans(text)
                weak = weak_spans(text, base)
                roles = {ROLE[k] for k, _, _ in base + weak}
                if "secret" not in roles or len(roles) < 2:
                    weak = []
                n = Counter(k for k, _, _ in base)
                packed = [[dict(start=s, rank=KINDS.index(k), end=e, scope=at)
                           for (k, s, e), at in zip(spans, scopes(text, spans))] for spans in (base, weak)]
                out.append((n["assign"], n["access"], n["hex"],
                            hashlib.sha256(joined(base).encode()).hexdigest(), *packed))
            yield batch(kind, rows.column(0), *(list(c) for c in zip(*out)) if out else [[]] * 6)

    span = "array<struct<start int, rank int, end int, scope int>>"
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, "
                             f"base {span}, weak {span}")
            .withColumn("row", F.monotonically_increasing_id()))


def linked(found: DataFrame, reach: int = REACH) -> DataFrame:
    """row and span of every weak candidate with a complementary part in
    its scope and reach: the interval join."""
    held = found.filter(F.size("weak") > 0)
    role = F.element_at(F.array(*[F.lit(ROLE[k]) for k in KINDS]), F.col("p.rank") + 1)
    parts = held.select("row", F.explode(F.concat("base", "weak")).alias("p")).select("row", "p", role.alias("role"))

    def cells(start, end):
        return F.explode(F.sequence(F.floor(start / CELL), F.floor((end - 1) / CELL)))

    left = (held.select("row", F.explode("weak").alias("p")).select("row", "p", role.alias("role"))
            .withColumn("cell", cells(F.greatest(F.col("p.start") - reach, F.lit(0)), F.col("p.end") + reach)))
    right = parts.select(F.col("row").alias("row2"), F.col("p").alias("q"), F.col("role").alias("role2"),
                         cells(F.col("p.start"), F.col("p.end")).alias("cell2"))
    near = ((F.col("row") == F.col("row2")) & (F.col("cell") == F.col("cell2"))
            & (F.col("p.scope") == F.col("q.scope"))
            & (F.col("q.start") - F.col("p.end") <= reach) & (F.col("p.start") - F.col("q.end") <= reach)
            # A secret is one of the two, and only one of them.
            & ((F.col("role") == "secret") != (F.col("role2") == "secret")))
    return left.join(right, near, "left_semi").select("row", "p").distinct()


def scan(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked of
    every row.

    ``spans`` lists base matches and linked weak candidates as
    kind:start:end by start, then kind (the base kinds, identifier, secret,
    endpoint), in code points, end exclusive; ``n_linked`` counts the
    latter. Null text counts as empty: no spans, the digest of the empty
    string. Rows repeated under one ``doc_id`` and rows with a null one come
    back as often as they occur, each scanned by itself. Long texts are
    scanned whole. Weak candidates that overlap a base match are part of
    it; equally near partners need no choice, one is enough. Extra columns
    are ignored; an empty table gives an empty result.
    """
    found = materialise(scanned(docs), "secret_parts")
    links = materialise(linked(found, reach).groupBy("row").agg(F.collect_list("p").alias("more")), "secret_links")
    more = F.coalesce("more", F.array().cast(found.schema["base"].dataType))
    # (start, rank, end) is the order of the struct's fields.
    spans = F.array_sort(F.concat("base", more))
    kind = F.array(*[F.lit(k) for k in KINDS])
    text = F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(kind, s["rank"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")
    return found.join(small(links), "row", "left").select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", text.alias("spans"),
        F.size(more).cast("long").alias("n_linked"))


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
