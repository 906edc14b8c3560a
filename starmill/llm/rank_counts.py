"""Token counts by rank-synchronous merging of pre-tokens held as ragged arrays."""

import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.llm.bpe import CHUNKS, LONGEST_KEPT, MOST_KEPT, ByteBpe, byte_alphabet, vocabulary
from starmill.llm.common import batch, groups, map_arrow, sole, table

LIMIT = 512
# Fixed: the pattern by which byte-level vocabularies split a text into pre-tokens.
PRE_TOKENS = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
NONE = np.iinfo(np.int64).max
LONG_WORD = 256  # bytes from which a pre-token is merged a rank at a time


@lru_cache(maxsize=4)
def _loaded(path: str) -> "RankCounter":
    return RankCounter(vocabulary(path))


def counter(path: str) -> "RankCounter":
    """The counter for the vocabulary at a path, made once a worker."""
    ranks = _loaded(path)
    sole(ranks.kept)
    return ranks


class RankCounter:
    """Counts the tokens of texts; a chunk met before is looked up."""

    def __init__(self, bpe: ByteBpe):
        self.bpe = bpe
        ids = bpe.spec["model"]["vocab"]
        self.width = len(bpe.bytes_of)
        alphabet = {b: c for c, b in byte_alphabet().items()}
        self.byte_ids = np.array([ids[alphabet[b]] for b in range(256)], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in bpe.spec["model"]["merges"]]
        keys = np.array([ids[a] * self.width + ids[b] for a, b in pairs], np.int64)
        # Keys of the pairs in order, for binary search; rank and product of each.
        self.order = np.argsort(keys)
        self.keys = keys[self.order]
        self.products = np.array([ids[a + b] for a, b in pairs], np.int64)
        self.kept: dict[str, int] = {}

    def ranks(self, pairs: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.keys, pairs), len(self.keys) - 1)
        return np.where(self.keys[at] == pairs, self.order[at], NONE)

    def merged_sizes(self, words: list[bytes]) -> np.ndarray:
        """Symbols that survive in each word, none of which is empty."""
        long = np.fromiter((len(w) >= LONG_WORD for w in words), bool, len(words))
        result = np.zeros(len(words), np.int64)
        for merge, chosen in ((self._short_sizes, ~long), (self._long_sizes, long)):
            if chosen.any():
                result[chosen] = merge([w for w, c in zip(words, chosen) if c])
        return result

    def _short_sizes(self, words: list[bytes]) -> np.ndarray:
        """A pass takes each word's lowest pair, so there are as many as a word has merges."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        symbols = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        owner = np.repeat(np.arange(len(words)), sizes)
        result = sizes.copy()
        while len(symbols) > 1:
            rank = self.ranks(symbols[:-1] * self.width + symbols[1:])
            rank[owner[:-1] != owner[1:]] = NONE
            firsts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            lowest = np.minimum.reduceat(np.r_[rank, NONE], firsts)
            of = np.repeat(lowest, np.diff(np.r_[firsts, len(owner)]))
            hits = np.flatnonzero((rank == of[:-1]) & (rank != NONE))
            if not len(hits):
                break
            # Of hits that touch (a pair of equal symbols), every other one counts.
            run = np.flatnonzero(np.r_[True, np.diff(hits) != 1])
            within = np.arange(len(hits)) - np.repeat(run, np.diff(np.r_[run, len(hits)]))
            hits = hits[within % 2 == 0]
            symbols[hits] = self.products[rank[hits]]
            result -= np.bincount(owner[hits], minlength=len(words))
            stay = of != NONE  # words without a pair left have their result
            stay[hits + 1] = False
            symbols, owner = symbols[stay], owner[stay]
        return result

    def _long_sizes(self, words: list[bytes]) -> np.ndarray:
        """A pass takes the lowest rank there is, in all words, and costs its hits and not the whole array.

        Symbols are linked to those beside them. Ranks are kept between passes, and only pairs beside a merge are
        ranked anew; positions wait under their rank, and those that changed since are passed over.
        """
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        n, ends = int(sizes.sum()), np.cumsum(sizes)
        owner = np.repeat(np.arange(len(words)), sizes)
        # Entry n stands for no symbol.
        symbols = np.r_[self.byte_ids[np.frombuffer(b"".join(words), np.uint8)], 0]
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        after[ends - 1], after[n], before[ends - sizes] = n, n, n
        rank = np.full(n + 1, NONE)
        waiting: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def rank_anew(at: np.ndarray) -> None:
            rank[at] = np.where(after[at] < n, self.ranks(symbols[at] * self.width + symbols[after[at]]), NONE)
            at = at[rank[at] != NONE]
            at = at[np.argsort(rank[at], kind="stable")]
            firsts = np.flatnonzero(np.diff(rank[at])) + 1
            for group in np.split(at, firsts) if len(at) else ():
                key = int(rank[group[0]])
                if key not in waiting:
                    waiting[key] = []
                    heapq.heappush(heap, key)
                waiting[key].append(group)

        rank_anew(np.arange(n))
        result = sizes.copy()
        while heap:
            lowest = heapq.heappop(heap)
            hits = np.unique(np.concatenate(waiting.pop(lowest)))
            hits = hits[rank[hits] == lowest]
            if not len(hits):
                continue
            # Of hits that touch (a pair of equal symbols), every other one counts.
            run = np.flatnonzero(np.r_[True, after[hits[:-1]] != hits[1:]])
            within = np.arange(len(hits)) - np.repeat(run, np.diff(np.r_[run, len(hits)]))
            hits = hits[within % 2 == 0]
            gone = after[hits]
            symbols[hits] = self.products[lowest]
            rank[gone] = NONE
            after[hits] = after[gone]
            before[after[hits]] = hits
            result -= np.bincount(owner[hits], minlength=len(words))
            changed = np.unique(np.r_[hits, before[hits]])
            rank_anew(changed[changed < n])
        return result

    def _count_chunks(self, chunks: list[str]) -> dict[str, int]:
        """Tokens of each chunk, by its pre-tokens, all merged side by side."""
        words = [PRE_TOKENS.findall(c) for c in chunks]
        unique = {w: i for i, w in enumerate(dict.fromkeys(w for ws in words for w in ws))}
        sizes = self.merged_sizes([w.encode() for w in unique])
        return {c: int(sum(sizes[unique[w]] for w in ws)) for c, ws in zip(chunks, words)}

    def count_all(self, texts: list[str]) -> list[int]:
        """Tokens of each text; special strings inside a text are one token each."""
        parts = [self.bpe.plain_parts(t) for t in texts]
        chunks = [[c for part in ps[::2] for c in CHUNKS.findall(part)] for ps in parts]
        if len(self.kept) > MOST_KEPT:
            self.kept.clear()
        kept = self.kept
        new = list({c for cs in chunks for c in cs if c not in kept})
        found = self._count_chunks(new) if new else {}
        long = {c: n for c, n in found.items() if len(c) > LONGEST_KEPT}
        kept.update((c, n) for c, n in found.items() if len(c) <= LONGEST_KEPT)
        return [
            len(ps) // 2 + sum(long[c] if c in long else kept[c] for c in cs)
            if long else len(ps) // 2 + sum(map(kept.__getitem__, cs))
            for ps, cs in zip(parts, chunks)
        ]


def count_tokens(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every text; a null text is empty.

    Documents are read once and never shuffled. Texts are held in groups of a
    few megabytes, so a batch of very long ones needs no more memory.
    """
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()),
        ("over_limit", pa.bool_()),
    ])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = counter(path)
        for x in batches:
            texts = x.column("text").to_pylist()
            n = [c for group in groups(texts, 1 << 22) for c in ranks.count_all(group)]
            yield batch(
                schema, doc_id=x.column("id"), n_bytes=[len(t.encode()) for t in texts],
                n_tokens=n, over_limit=[c > limit for c in n],
            )

    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    return map_arrow(rows, task, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def op6_rank_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    return count_tokens(table(spark, sf_dir, "documents"), path)


QUERIES = {"op6_rank_counts": (op6_rank_counts, None)}
