"""Secret scans: fixed patterns, and windows of high Shannon entropy over candidate strings.

``scan`` adds columns to any table with a text column.  The base kinds are the fixed patterns
below.  The method's own kind, ``entropy``, looks at *candidates*: maximal runs of the characters
secrets are written in.  Of every character class the maximal stretches of a candidate are taken (a
key keeps its class behind a name and a sign), and a window slides over each; its entropy is kept
by incremental counts (one character in, one out), and the windows at or above the class's bits are
merged into a span.  Candidates that the allow-list matches, stretches that read as words, and
spans within a base span are suppressed.

Defined results: a null text is an empty text (no spans); positions are code points, end
exclusive; equal spans of two kinds are both listed, in the order of ``KINDS``; repeated rows are
scanned alike; texts are scanned whole whatever their length.
"""

from __future__ import annotations

import hashlib
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import free_name, per_batch, with_struct

KINDS = ("assign", "access", "hex", "entropy")
# The base kinds' patterns (letters of the keywords in either case, ASCII only) and
# least lengths.
ASSIGN = re.compile(
    r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 6, 20, 24
# a maximal run of 24 or more is a match of HEX that passes; scanning for it skips short runs
LONG_HEX = re.compile(r"[0-9a-f]{%d,}" % LEAST_HEX)

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
WINDOW = 20
# character class: (stretches, least bits of entropy per window); hex needs a digit and a letter
CLASSES = (
    ("hex", re.compile(r"(?=[0-9]*[A-Fa-f])(?=[A-Fa-f]*[0-9])(?:[0-9A-F]{20,}|[0-9a-f]{20,})"), 3.0),
    ("letters", re.compile(r"[A-Za-z]{20,}"), 3.6),
    ("word", re.compile(r"[A-Za-z0-9]{20,}"), 3.7),
    ("base64", re.compile(r"[A-Za-z0-9+/_=-]{20,}"), 3.95),
)
# Strings that look random and are none: dashed UUIDs, long numbers, paths of words.
ALLOW = (
    re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}\Z"),
    re.compile(r"[0-9]+\Z"),
)
LETTERS = re.compile(r"[A-Za-z]+")
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
VOWEL = re.compile(r"[aeiouyAEIOUY]")
CLUSTER = re.compile(r"[^aeiouyAEIOUY]{7,}")
SHORTEST_PART = 3.5          # letters per part of a name in mixed case; random letters have fewer
DIGEST = ("n_assign long, n_access long, n_hex long, base_sha256 string, spans string, "
          "n_entropy long")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed patterns, leftmost and non-overlapping per kind."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text)
           if m.end(2) - m.start(2) >= LEAST_ASSIGN]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)
            if m.end() - m.start() >= LEAST_ACCESS]
    out += [(m.start(), 2, m.end()) for m in LONG_HEX.finditer(text)]
    return sorted(out)


_STEP = [c * math.log2(c) if c else 0.0 for c in range(WINDOW + 2)]


def random_windows(run: str, bits: float, window: int = WINDOW) -> list[tuple[int, int]]:
    """Merged windows of ``run`` whose entropy is at least ``bits``.

    With counts c, entropy is log2(w) - sum(c log2 c) / w; sliding by one changes two terms.
    """
    if len(run) < window:
        return []
    step = _STEP if window == WINDOW else [c * math.log2(c) if c else 0.0
                                           for c in range(window + 2)]
    most = (math.log2(window) - bits) * window + 1e-9
    counts: dict[str, int] = {}
    total = 0.0
    out: list[list[int]] = []
    for i, ch in enumerate(run):
        c = counts.get(ch, 0)
        total += step[c + 1] - step[c]
        counts[ch] = c + 1
        if i >= window:
            old = run[i - window]
            c = counts[old]
            total += step[c - 1] - step[c]
            counts[old] = c - 1
        if i >= window - 1 and total <= most:
            start = i - window + 1
            if out and start <= out[-1][1]:
                out[-1][1] = i + 1
            else:
                out.append([start, i + 1])
    return [(a, b) for a, b in out]


def reads_as_words(stretch: str) -> bool:
    """Whether the letters of a stretch could be words or a name made of words.

    Words change their case at their beginnings only, have vowels, and no long row of consonants;
    digits may follow a word here and there.
    """
    runs = LETTERS.findall(stretch)
    letters = sum(map(len, runs))
    if not runs or letters < 0.7 * len(stretch):
        return False
    parts = [p for r in runs for p in PART.findall(r)]
    return (letters >= SHORTEST_PART * len(parts)
            and 4 * sum(len(VOWEL.findall(r)) for r in runs) >= letters
            and not any(CLUSTER.search(r) for r in runs))


def entropy_spans(text: str, allow=ALLOW) -> list[tuple[int, int, int]]:
    out = []
    for m in CANDIDATE.finditer(text):
        run = m.group()
        if any(a.match(run) for a in allow):
            continue
        spans: list[tuple[int, int]] = []
        for _, stretches, bits in CLASSES:
            for s in stretches.finditer(run):
                if not reads_as_words(s.group()):
                    spans += [(a + s.start(), b + s.start())
                              for a, b in random_windows(s.group(), bits)]
        end = -1
        for a, b in sorted(spans):
            if a > end:
                out.append([a + m.start(), 3, b + m.start()])
            else:
                out[-1][2] = max(out[-1][2], b + m.start())
            end = out[-1][2] - m.start()
    return [tuple(s) for s in out]


def all_spans(text: str | None, allow=ALLOW):
    """(base spans, entropy spans outside them), each sorted by start."""
    text = text or ""
    base, found = base_spans(text), []
    ends, at = -1, 0                                 # farthest end of the base spans so far
    for s in entropy_spans(text, allow):
        while at < len(base) and base[at][0] <= s[0]:
            ends, at = max(ends, base[at][2]), at + 1
        if s[2] > ends:
            found.append(s)
    return base, found


def _joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def redacted(text: str | None, mark: str = "[SECRET]") -> str | None:
    """The text with every span replaced by ``mark`` (overlapping spans by one)."""
    if not text:
        return text
    base, found = all_spans(text)
    out, at = [], 0
    for a, _, b in sorted(base + found):
        if b <= at:
            continue
        if a >= at:
            out += [text[at:a], mark]
        at = b
    return "".join([*out, text[at:]]) if at else text


def scan(df: DataFrame, text: str = "text", out: str = "found", allow=ALLOW) -> DataFrame:
    """``df`` with the struct ``out`` of counts, digest of the base spans, and all spans."""
    slot = free_name(df, out)
    kinds = [f.split() for f in DIGEST.split(", ")]
    inner = pa.struct([(n, pa.int64() if t == "long" else pa.string()) for n, t in kinds])

    def make():
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = []
            for t in batch.column(text).to_pylist():
                base, found = all_spans(t, allow)
                n = [0, 0, 0]
                for _, k, _ in base:
                    n[k] += 1
                rows.append({
                    "n_assign": n[0], "n_access": n[1], "n_hex": n[2], "n_entropy": len(found),
                    "base_sha256": hashlib.sha256(_joined(base).encode()).hexdigest(),
                    "spans": _joined(base + found)})
            return pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(rows, inner)], names=[*batch.schema.names, slot])
        return run

    return df.mapInArrow(per_batch(make), with_struct(df, slot, DIGEST))


def redact(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the secrets in ``text`` replaced; all columns and rows stay."""

    @F.pandas_udf("string")
    def clean(s):
        return s.map(redacted, na_action="ignore")

    return df.select(*[clean(F.col(f"`{c}`")).alias(c) if c == text else F.col(f"`{c}`")
                       for c in df.columns])

