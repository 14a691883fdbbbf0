"""Secrets in texts: fixed patterns, and guess costs of values in credential contexts.

Three patterns find assignments, access keys and long hexadecimal runs. Beyond them, the
value after any credential word (``pwd: ...``, ``passphrase is ...``) is given its guess
cost: the logarithm (base 10) of the guesses that an attacker needs who tries words,
dates, repeats, keyboard walks and brute force, by dynamic programming over all
segmentations. Values that cost ``MIN_COST`` or more look random and become spans of kind
``guess``; ordinary words after ``password:`` do not.

Null text: as empty, no spans. Rows, ids and null ids pass through one by one; repeated
rows repeat. Texts are scanned whole. Values of any length cost time in proportion to
their length: segments are bounded, but for runs, which are found once.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from thermoflow.llm.batches import slices
from thermoflow.llm.common import map_arrow, read, text_of

#: Values that take 10 ** MIN_COST guesses or more are reported.
MIN_COST = 10.0
KINDS = ("assign", "access", "hex", "guess")

_ASSIGN = re.compile(
    r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"
    r"|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
_CONTEXT = re.compile(
    r"(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|api_?key|access_?key|auth(?:orization)?|credentials?)"
    r"[\"']?[ \t]*(?:is[ \t]|[:=]>?)[ \t]*[\"']?(?P<value>[!-~]{6,})",
    re.IGNORECASE | re.ASCII,
)
#: Texts without any of these have neither assignments nor credential contexts.
_TRIGGERS = ("pass", "pwd", "secret", "token", "api", "access", "auth", "credential")

#: Words by how soon an attacker tries them.
COMMON = (
    "password 123456 qwerty admin welcome letmein login monkey dragon master hello freedom whatever secret test "
    "guest root user default changeme example sample token access shadow sunshine princess football baseball "
    "summer winter spring autumn love money home house computer internet server database system manager office "
    "company account private public key pass word please enter your here none null true false required optional "
    "string value demo temp dummy placeholder redacted hidden empty unknown field name email the and for with "
    "this that from have"
).split()
_RANK = {word: math.log10(rank + 2) for rank, word in enumerate(COMMON)}
_LONGEST_WORD = max(map(len, COMMON))
_LEET = str.maketrans("0134578@$!", "oieastbasi")
_ROWS = ("qwertyuiop", "asdfghjkl", "zxcvbnm", "1234567890", "abcdefghijklmnopqrstuvwxyz")
_NEXT = {(a, b) for row in _ROWS for a, b in [*zip(row, row[1:]), *zip(row[1:], row)]}
_DATE = re.compile(
    r"(?:19|20)\d\d[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:0[1-9]|[12]\d|3[01])"
    r"|(?:0[1-9]|[12]\d|3[01])[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:(?:19|20)\d\d|\d\d)|(?:19|20)\d\d"
)
_DATE_COST, _YEAR_COST = math.log10(200 * 366 * 4), math.log10(200)
_WALK_START = math.log10(len(_ROWS) * 12)


def _alphabet(value: str) -> float:
    """The logarithm of the number of characters a brute-force attack tries at each place."""
    size = 10 * any(c.isdigit() for c in value) + 26 * any("a" <= c <= "z" for c in value)
    size += 26 * any("A" <= c <= "Z" for c in value) + 33 * any(not c.isalnum() for c in value)
    return math.log10(max(size, 2))


def guess_cost(value: str) -> float:
    """The least cost over all segmentations into words, dates, repeats, walks and brute force."""
    lower, n, brute = value.lower(), len(value), _alphabet(value)
    plain = lower.translate(_LEET)
    cost = [0.0] + [math.inf] * n
    same = walk = 0
    for end in range(1, n + 1):
        # A run that ends here: of one character, or along a keyboard row or the alphabet.
        i = end - 1
        same = same + 1 if i and lower[i] == lower[i - 1] else 1
        walk = walk + 1 if i and (lower[i - 1], lower[i]) in _NEXT else 1
        best = cost[i] + brute
        if same >= 3:
            best = min(best, cost[end - same] + brute + math.log10(same))
        if walk >= 3:
            best = min(best, cost[end - walk] + _WALK_START + math.log10(2 * walk))
        for size in range(3, min(_LONGEST_WORD, end) + 1):
            rank = _RANK.get(lower[end - size: end])
            if rank is None and (rank := _RANK.get(plain[end - size: end])) is not None:
                rank += math.log10(4)
            if rank is not None:
                case = 0.0 if value[end - size: end] == lower[end - size: end] else math.log10(4)
                best = min(best, cost[end - size] + rank + case)
        for size in (4, 6, 8, 10):
            if size <= end and _DATE.fullmatch(value, end - size, end):
                best = min(best, cost[end - size] + (_YEAR_COST if size == 4 else _DATE_COST))
        # A unit of 2 to 8 characters repeated: the repeat costs only its counter.
        for size in range(2, min(8, end // 2) + 1):
            if lower[end - size: end] == lower[end - 2 * size: end - size]:
                best = min(best, cost[end - size] + math.log10(2 * size))
        cost[end] = best
    return cost[n]


def find(text: str, min_cost: float = MIN_COST) -> list[tuple[int, int, str, int]]:
    """All spans: ``(start, place of the kind, kind, end)``, sorted."""
    spans = []
    lower = text.lower()
    if any(t in lower for t in _TRIGGERS):
        spans += [(m.start(), 0, "assign", m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
        for m in _CONTEXT.finditer(text):
            value = m["value"].rstrip("\"'`,;.)>]}")
            if len(value) >= 6 and guess_cost(value) >= min_cost:
                spans.append((m.start("value"), 3, "guess", m.start("value") + len(value)))
    if "AKIA" in text:
        spans += [(m.start(), 1, "access", m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    spans += [(m.start(), 2, "hex", m.end()) for m in _HEX.finditer(text)]
    return sorted(spans)


def _joined(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in spans)


def scan(df: DataFrame, doc_id: str = "doc_id", text: str = "text", min_cost: float = MIN_COST) -> DataFrame:
    """A row per document: id, counts by kind, a digest of the pattern spans, and all spans."""
    body = df.select(df[doc_id].alias("doc_id"), text_of(text).alias("text"))
    schema = (
        f"doc_id {body.schema['doc_id'].dataType.simpleString()}, n_assign bigint, n_access bigint, n_hex bigint, "
        "n_guess bigint, base_sha256 string, spans string"
    )

    def scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            counts, digests, joined = [[] for _ in KINDS], [], []
            for text in batch.column("text").to_pylist():
                spans = find(text, min_cost)
                for k, out in enumerate(counts):
                    out.append(sum(s[1] == k for s in spans))
                base = _joined(s for s in spans if s[1] < 3)
                digests.append(hashlib.sha256(base.encode()).hexdigest())
                joined.append(_joined(spans))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()),
                 pa.array(joined, pa.string())],
                names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"],
            )

    return map_arrow(body, scan_batches, schema)


def op3_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    return scan(read(spark, folder, "documents").select("doc_id", "text"))
