"""Passages repeated across documents, by hashes of every run of consecutive sentences."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.llm.common import batch, map_arrow, row_key, table, unused
from starmill.llm.shingles import MIX, chained, word_hashes
from starmill.workspace import materialize

RUN = 6  # consecutive sentences of a run
LEAST_WORDS = 24  # words of a run; what many clean documents share by chance is shorter

LEAST = 4  # words of a sentence, so that a run has ``LEAST_WORDS``; only a text's last one may have fewer
MOST = 2 * LEAST - 1  # words of a sentence; more are parted

# What a character is, by its code; those beyond the table are parts of words.
SPACE, LINE, STOPPING, COMMA, CLOSING = 1, 2, 4, 8, 16
KINDS = np.array([chr(c).isspace() * SPACE for c in range(0x3002)], np.uint8)
for _kind, _characters in ((LINE, "\n"), (STOPPING, ".!?…"), (COMMA, ",;:"), (CLOSING, "\"'’”»)]")):
    KINDS[[ord(c) for c in _characters]] |= _kind
# How willingly a text is cut after a word, the best first. Within a kind, hashes decide.
STOP, TEXT_END, CLAUSE, INSIDE = (np.uint64(k << 62) for k in range(4))


def _words(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each word: its start, its hash, and the rank of a cut after it, which is lowest where best."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = KINDS.take(codes, mode="clip")
    bounds = np.empty(len(codes) + 2, bool)
    bounds[0] = bounds[-1] = True
    np.bitwise_and(kinds, SPACE, out=bounds[1:-1].view(np.uint8))
    edges = np.flatnonzero(bounds[1:] != bounds[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return starts, np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    hashes = word_hashes(text.split())
    last = kinds[ends - 1]
    for back in (2, 3):  # a stop may stand before closing quotes
        if not (quoted := np.flatnonzero((last == CLOSING) & (ends - starts >= back))).size:
            break
        last[quoted] = kinds[ends[quoted] - back]
    rank = chained(np.append(hashes, np.uint64(0)), 2) >> np.uint64(2)
    kind = np.full(len(starts), INSIDE)
    kind[(last & COMMA) > 0] = CLAUSE
    lines = np.flatnonzero(kinds & LINE)
    kind[np.searchsorted(starts, lines) - 1] = CLAUSE  # before the first word: its last, which ends the text
    kind[(last & STOPPING) > 0] = STOP
    rank |= kind
    rank[-1] = TEXT_END
    return starts, hashes, rank


def _cuts(rank: np.ndarray) -> np.ndarray:
    """Number of the first word of each sentence.

    A cut is where the rank is the lowest of ``LEAST`` words either way; that
    follows from the words around it alone. What is longer than ``MOST`` words
    between such cuts is parted from its beginning on, at the lowest rank that
    leaves ``LEAST`` words at least.
    """
    n = len(rank)
    lowest = np.ones(n, bool)
    for k in range(1, LEAST):
        lowest[k:] &= rank[k:] < rank[:-k]
        lowest[:-k] &= rank[:-k] <= rank[k:]
    lowest[:LEAST - 1] = lowest[-1:] = False
    found, at, ranks = [0], 0, rank.tolist()
    for end in [*(np.flatnonzero(lowest) + 1).tolist(), n]:
        while end - at > MOST:
            near = ranks[at + LEAST - 1:min(at + MOST, end - LEAST)]
            at += LEAST + near.index(min(near))
            found.append(at)
        if end < n:
            found.append(end)
        at = end
    return np.array(found)


def _parted(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and hash of each word, and the number of each sentence's first word."""
    starts, hashes, rank = _words(text)
    return starts, hashes, _cuts(rank) if len(rank) else np.zeros(0, int)


def _marks(text: str, starts: np.ndarray, first: np.ndarray) -> list[tuple[int, int]]:
    edges = [0, *starts[first[1:]].tolist(), len(text)]
    return list(zip(edges, edges[1:])) if text else []


def sentences(text: str) -> list[tuple[int, int]]:
    """(start, end) of each sentence with the space after it; together they are the whole text.

    Sentences have ``LEAST`` to ``MOST`` words: short clauses are joined and long
    ones cut, at stops and commas where these are far enough apart and at words
    picked by hashes where not. So 50 words of prose, of lists or without stops
    hold several whole runs, the same ones wherever they stand.
    """
    starts, _, first = _parted(text)
    return _marks(text, starts, first)


def _run_hashes(hashes: np.ndarray, first: np.ndarray, run: int, least_words: int) -> tuple[np.ndarray, np.ndarray]:
    if len(first) < run:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    counts = np.append(first, len(hashes))
    lengths = np.diff(counts)
    place = (np.arange(len(hashes)) - np.repeat(first, lengths)).astype(np.uint64)
    mixed = (hashes ^ (place * MIX[2])) * MIX[0]
    mixed ^= mixed >> np.uint64(31)
    own = np.add.reduceat(mixed * MIX[1], first) + lengths.astype(np.uint64)
    enough = np.flatnonzero(counts[run:] - counts[:-run] >= least_words)
    return chained(own, run).view(np.int64)[enough], enough


def runs(text: str, run: int = RUN, least_words: int = LEAST_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first sentence of every run of ``run`` sentences with enough words.

    White space does not matter, but for line breaks, which end clauses. Runs
    follow from their own sentences alone, so equal passages have equal runs
    wherever they stand.
    """
    _, hashes, first = _parted(text)
    return _run_hashes(hashes, first, run, least_words)


def firsts(hashes: np.ndarray) -> np.ndarray:
    """Whether a hash has not come before, for each."""
    found = np.zeros(len(hashes), bool)
    found[np.unique(hashes, return_index=True)[1]] = True
    return found


def covered(marks: list[tuple[int, int]], starts: np.ndarray, run: int = RUN) -> list[tuple[int, int]]:
    """Spans of sentences that the runs beginning at these ones cover, joined where they touch."""
    mask = np.zeros(len(marks) + 1, bool)
    for start in starts:
        mask[start:start + run] = True
    edges = np.flatnonzero(np.diff(np.r_[False, mask[:len(marks)], False].astype(int)))
    return [(marks[a][0], marks[b - 1][1]) for a, b in zip(edges[::2], edges[1::2])]


def without(text: str, spans: list[tuple[int, int]]) -> str:
    out, before = [], 0
    for start, end in spans:
        out.append(text[before:start])
        before = end
    return "".join([*out, text[before:]])


def later_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", run: int = RUN,
    least_words: int = LEAST_WORDS,
) -> DataFrame:
    """The documents with one more, last column: first sentences of runs an earlier document holds.

    A run's first occurrence is the first one in the document with the smallest
    id. Rows with one id count as one document, none of whose rows is later than
    the others; null ids come last. Null texts have no runs. Runs of a document
    are hashed once where it is read and written; what repeats is found by
    counts that are combined before the shuffle, and comes back as a document's
    sentences, never as pairs.
    """
    last = F.lit((1 << 63) - 1)
    mark, starts = unused("_key", docs.columns), unused("_later", docs.columns)
    keyed = docs.withColumn(mark, row_key(id_col, text_col))
    rows = keyed.select(
        F.coalesce(F.col(id_col).cast("long"), last).alias("id"), F.col(mark).alias("_key"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    schema = pa.schema([
        ("key", pa.int64()), ("id", pa.int64()), ("hash", pa.int64()), ("at", pa.int32()),
    ])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            parts = []
            keys, ids = x.column("_key").to_numpy(), x.column("id").to_numpy()
            for key, i, text in zip(keys, ids, x.column("text").to_pylist()):
                hashes, at = runs(text, run, least_words)
                one = firsts(hashes)
                parts.append((np.full(one.sum(), key), np.full(one.sum(), i), hashes[one], at[one]))
            if parts:
                key, i, hashes, at = (np.concatenate(p) for p in zip(*parts))
                yield batch(schema, key=key, id=i, hash=hashes, at=at)

    found = materialize(
        map_arrow(rows.select("_key", "id", "text"), task, "key long, id long, hash long, at int"), "runs"
    )
    shared = found.groupBy("hash").agg(F.min("id").alias("first"), F.max("id").alias("last")).where(
        "first < last"
    ).select("hash", "first")
    later = (
        found.join(shared, "hash").where("id > first").groupBy("key")
        .agg(F.collect_set("at").alias(starts))
    )
    merged = keyed.join(later.withColumnRenamed("key", mark), mark, "left")
    return merged.select(*[F.col(f"`{c}`") for c in docs.columns], starts)


def _spans_of(
    text: str | None, later: list[int] | None, run: int, least_words: int
) -> tuple[list[tuple[int, int]], int]:
    """Spans to remove, of runs that other documents hold first and of those the text itself
    repeats, and how many sentences the text has."""
    text = text or ""
    starts, words, first = _parted(text)
    hashes, at = _run_hashes(words, first, run, least_words)
    gone = np.concatenate([at[~firsts(hashes)], np.array(later or [], np.int64)]).astype(np.int64)
    spans = covered(_marks(text, starts, first), gone, run) if len(gone) else []
    return spans, max(len(first), int(text != ""))


def drop_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", run: int = RUN,
    least_words: int = LEAST_WORDS,
) -> DataFrame:
    """The documents without their repeated spans; all rows and columns stay, a text may end empty."""
    place, later_at = docs.columns.index(text_col), len(docs.columns)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            texts = []
            for text, later in zip(x.column(place).to_pylist(), x.column(later_at).to_pylist()):
                spans, _ = _spans_of(text, later, run, least_words)
                texts.append(without(text, spans) if spans else text)
            columns = list(x.columns[:-1])
            columns[place] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=x.schema.names[:-1])

    return map_arrow(later_runs(docs, id_col, text_col, run, least_words), task, docs.schema)


def op8_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its repeated passages, and where they stood."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_sentences", pa.int64()), ("n_spans", pa.int64()),
        ("removed_chars", pa.int64()), ("spans", pa.string()), ("text", pa.string()),
    ])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            texts = x.column("text").to_pylist()
            found = [
                _spans_of(t, later, RUN, LEAST_WORDS) for t, later in zip(texts, x.column("_later").to_pylist())
            ]
            spans = [v for v, _ in found]
            yield batch(
                schema, doc_id=x.column("doc_id"), n_sentences=[n for _, n in found],
                n_spans=[len(v) for v in spans], removed_chars=[sum(e - s for s, e in v) for v in spans],
                spans=[",".join(f"{s}:{e}" for s, e in v) for v in spans],
                text=[t if not v else without(t, v) for t, v in zip(texts, spans)],
            )

    return map_arrow(
        later_runs(docs), task,
        "doc_id long, n_sentences long, n_spans long, removed_chars long, spans string, text string",
    )


QUERIES = {"op8_sentence_spans": (op8_sentence_spans, None)}
