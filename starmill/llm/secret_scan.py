"""Secrets in texts: keywords by one automaton, anchored patterns near hits, embedded checksums."""

import bisect
import hashlib
import re
import string
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import product

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.llm.common import batch, map_arrow, table

KINDS = ["assign", "access", "hex", "github", "npm"]
BASE_KINDS = KINDS[:3]

# Kind, keywords in lower case, the pattern anchored at a keyword, the check of a match.
ASSIGN_WORDS = ["password", "passwd", "secret", "token", "apikey", "api_key"]
ASSIGN = re.compile(
    rb"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]+")
GITHUB_WORDS = ["ghp_", "gho_", "ghu_", "ghs_", "ghr_"]
GITHUB = re.compile(rb"gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])")
NPM = re.compile(rb"npm_[A-Za-z0-9]{36}(?![A-Za-z0-9])")

MOST_HELD = 10_000  # keywords put in order at a time
BASE62 = string.digits + string.ascii_uppercase + string.ascii_lowercase


def base62(number: int, width: int) -> bytes:
    digits = ""
    while number:
        number, digit = divmod(number, 62)
        digits = BASE62[digit] + digits
    return digits.rjust(width, "0").encode()


def carries_checksum(token: bytes) -> bool:
    """Whether a token's last six characters are the CRC-32 of the thirty before them."""
    return base62(zlib.crc32(token[-36:-6]), 6) == token[-6:]


RULES = [
    ("assign", ASSIGN_WORDS, ASSIGN, lambda m: len(m[2]) >= 12),
    ("access", ["akia"], ACCESS, lambda m: len(m[0]) >= 18),
    ("hex", ["".join(x) for x in product("0123456789abcdef", repeat=4)], HEX, lambda m: len(m[0]) >= 16),
    ("github", GITHUB_WORDS, GITHUB, lambda m: carries_checksum(m[0])),
    ("npm", ["npm_"], NPM, lambda m: carries_checksum(m[0])),
]
LONGEST = max(len(word) for _, words, _, _ in RULES for word in words)  # of all keywords


@lru_cache(maxsize=1)
def automaton():
    """All keywords, each with its length and the numbers of its rules."""
    import ahocorasick

    rules: dict[str, list[int]] = {}
    for number, (_, words, _, _) in enumerate(RULES):
        for word in words:
            rules.setdefault(word, []).append(number)
    found = ahocorasick.Automaton()
    for word, numbers in rules.items():
        found.add_word(word, (len(word), tuple(numbers)))
    found.make_automaton()
    return found


def scan(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's place in ``KINDS``, end) of every secret, in order; code points.

    The automaton reads the text's UTF-8 bytes once, ASCII letters folded. A
    pattern is tried only where a keyword of its kind begins, and not inside
    that kind's last match, so matches are those of a search from the left. A
    run of hexadecimal digits is hit where it begins, for every four digits are
    a keyword.
    """
    data = text.encode("utf-8", "surrogatepass")
    after = [0] * len(RULES)
    spans: list[tuple[int, int, int]] = []
    for start, numbers in _hits(data.lower().decode("latin-1")):
        for number in numbers:
            if start >= after[number] and (m := RULES[number][2].match(data, start)):
                after[number] = m.end()
                if RULES[number][3](m):
                    spans.append((start, number, m.end()))
    spans.sort()
    if len(data) == len(text):
        return spans
    return _in_code_points(data, spans)


def _hits(folded: str) -> Iterator[tuple[int, tuple[int, ...]]]:
    """(start, rules) of every keyword, in order of start; a bounded number is held, for a text may be all hits."""
    held: list[tuple[int, tuple[int, ...]]] = []
    for end, (length, numbers) in automaton().iter(folded):
        held.append((end + 1 - length, numbers))
        if len(held) >= MOST_HELD:
            # A longer keyword is reported where it ends: what is still to come may begin as early as this.
            early = end + 1 - LONGEST
            held.sort()
            ready = bisect.bisect_left(held, (early,))
            yield from held[:ready]
            del held[:ready]
    held.sort()
    yield from held


def _in_code_points(data: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    marks = sorted({p for start, _, end in spans for p in (start, end)})
    points, before, count = {}, 0, 0
    for mark in marks:
        count += len(data[before:mark].decode("utf-8", "surrogatepass"))
        points[mark], before = count, mark
    return [(points[start], kind, points[end]) for start, kind, end in spans]


def shown(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def redact(text: str, spans: list[tuple[int, int, int]], mark: str = "[secret]") -> str:
    """The text with every span, or run of spans that overlap, replaced by the mark."""
    out, before = [], 0
    for start, _, end in spans:
        if start >= before:
            out += [text[before:start], mark]
        before = max(before, end)
    return "".join([*out, text[before:]])


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: counts and spans of the secrets in its whole text.

    A null text is empty and has none. Nothing is shuffled; a task holds a batch
    of texts.
    """
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()),
        ("base_sha256", pa.string()), ("spans", pa.string()),
    ])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            found = [scan(t) for t in x.column("text").to_pylist()]
            base = [[s for s in spans if s[1] < len(BASE_KINDS)] for spans in found]
            counts = {
                f"n_{kind}": [sum(s[1] == k for s in spans) for spans in base]
                for k, kind in enumerate(BASE_KINDS)
            }
            yield batch(
                schema, doc_id=x.column("id"), **counts,
                base_sha256=[hashlib.sha256(shown(s).encode()).hexdigest() for s in base],
                spans=[shown(s) for s in found],
            )

    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    return map_arrow(
        rows, task, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    )


def redact_secrets(docs: DataFrame, text_col: str = "text", mark: str = "[secret]") -> DataFrame:
    """The documents with every secret replaced by ``mark``; all rows and columns stay.

    Null texts stay null. Texts without a secret are handed on as they are.
    """
    schema = docs.schema
    place = docs.columns.index(text_col)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            texts = [
                t if t is None or not (spans := scan(t)) else redact(t, spans, mark)
                for t in x.column(place).to_pylist()
            ]
            columns = list(x.columns)
            columns[place] = pa.array(texts, x.schema.field(place).type)
            yield pa.RecordBatch.from_arrays(columns, schema=x.schema)

    return map_arrow(docs, task, schema)


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    return find_secrets(table(spark, sf_dir, "documents"))


QUERIES = {"op10_secret_scan": (op10_secret_scan, None)}
