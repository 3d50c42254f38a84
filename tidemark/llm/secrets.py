"""Secret scan: fixed patterns, and sliding-window Shannon entropy over candidate strings.

`find_spans` is the whole scan of one text; `scan_secrets` runs it over every text of a
DataFrame, row by row, without a shuffle."""

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import pieces, whole_text

# The base patterns, the least lengths, and the order of the kinds
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # runs are maximal, so the length may stand in the pattern
MIN_ASSIGN, MIN_ACCESS = 6, 20
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_base64")

WINDOW = 20
# Bits a window of each class must reach. Hexadecimal has 4 bits a character at most, base 64 has 6
THRESHOLDS = {"entropy_hex": 3.0, "entropy_base64": 3.85}
CLASSES = {
    "entropy_hex": re.compile(r"[0-9A-Fa-f]{%d,}" % WINDOW),
    "entropy_base64": re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % WINDOW),
}
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % WINDOW)
# Long strings that are no secrets: words, numbers, UUIDs, paths and names in parts, sequences
ALLOWED = (
    re.compile(r"[A-Za-z]+"),
    re.compile(r"[0-9=_+/-]+"),
    re.compile(r"[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}"),
    re.compile(r"(?:[A-Za-z]+|[0-9]{1,8})(?:[/_=+-]+(?:[A-Za-z]+|[0-9]{1,8}))*[/_=+-]*"),
)
SEQUENCES = ("0123456789abcdef", "abcdefghijklmnopqrstuvwxyz", "0123456789")

# c log2 c for every count a window can hold
_C_LOG_C = [0.0] + [c * math.log2(c) for c in range(1, WINDOW + 1)]

BLOCK_BYTES = 1_000_000

SCHEMA = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"

Span = tuple[int, int, int]  # start, kind, end


def window_spans(text: str, threshold: float) -> Iterator[tuple[int, int]]:
    """Maximal runs of `text` covered by windows whose entropy reaches the threshold.

    Entropy of a window is log2 W - (sum of c log2 c) / W; one step changes two counts."""
    counts: dict[str, int] = {}
    total, start, end = 0.0, -1, -1
    most = (math.log2(WINDOW) - threshold) * WINDOW + 1e-9
    for i, c in enumerate(text):
        n = counts.get(c, 0)
        total += _C_LOG_C[n + 1] - _C_LOG_C[n]
        counts[c] = n + 1
        if i < WINDOW - 1:
            continue
        first = i - WINDOW + 1
        if total <= most:
            if start >= 0 and first > end:
                yield start, end
                start = -1
            if start < 0:
                start = first
            end = i + 1
        gone = text[first]
        n = counts[gone]
        total += _C_LOG_C[n - 1] - _C_LOG_C[n]
        counts[gone] = n - 1
    if start >= 0:
        yield start, end


def allowed(candidate: str) -> bool:
    """Allow-list: strings whose form, or whose runs of a known sequence, explain their entropy."""
    if any(p.fullmatch(candidate) for p in ALLOWED):
        return True
    return any(s in candidate.lower() for s in SEQUENCES)


def base_spans(text: str) -> list[Span]:
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGN]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def added_spans(text: str, base: list[Span]) -> list[Span]:
    """Entropy spans, without those that touch a base span (the same secret) or the allow-list."""
    found: list[Span] = []
    for m in CANDIDATE.finditer(text):
        if allowed(m[0]):
            continue
        for kind, pattern in CLASSES.items():
            for run in pattern.finditer(m[0]):
                for s, e in window_spans(run[0], THRESHOLDS[kind]):
                    s, e = m.start() + run.start() + s, m.start() + run.start() + e
                    if not any(s < be and bs < e for bs, _, be in base) and not any(
                        s < fe and fs < e for fs, _, fe in found
                    ):
                        found.append((s, KINDS.index(kind), e))
    return found


def find_spans(text: str) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans, each ordered by start and then by kind."""
    base = base_spans(text)
    return base, sorted(base + added_spans(text, base))


def listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def scan_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans: one row for each row of `docs`.

    A null text is empty, and an empty text has no spans. Repeated rows, null doc_ids and further
    columns do no harm: every row is scanned by itself and only doc_id is carried along."""

    def scan(batches):
        for batch in batches:
            out = {name: [] for name in ("n_assign", "n_access", "n_hex", "base_sha256", "spans")}
            for text in batch.column("text"):
                base, spans = find_spans(text.as_py())
                for at, name in enumerate(("n_assign", "n_access", "n_hex")):
                    out[name].append(sum(kind == at for _, kind, _ in base))
                out["base_sha256"].append(hashlib.sha256(listed(base).encode()).hexdigest())
                out["spans"].append(listed(spans))
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), **out})

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
    return rows.mapInArrow(scan, SCHEMA)


def mask_secrets(docs: DataFrame, mask: str = "[SECRET]") -> DataFrame:
    """`docs` with every span of its text replaced by `mask`; overlapping spans become one."""

    def masked(text: str) -> str:
        out, at = [], 0
        for start, _, end in find_spans(text)[1]:
            if start >= at:
                out += [text[at:start], mask]
            at = max(at, end)
        return "".join(out) + text[at:]

    def scan(batches):
        for batch in batches:
            for part in pieces(batch, "text", BLOCK_BYTES):
                texts = [t.as_py() if t.is_valid else None for t in part.column("text")]
                new = pa.array([None if t is None else masked(t) for t in texts], pa.string())
                at = part.schema.get_field_index("text")
                yield part.set_column(at, pa.field("text", pa.string()), new)

    return docs.mapInArrow(scan, docs.schema)
