"""Byte-level BPE vocabularies inside a task: ids of whole texts, and text of ids."""

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np

from starmill.llm.common import sole

# White space as the pre-tokenizer's pattern knows it.
BLANK = "".join(map(chr, [
    *range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F,
    0x3000,
]))
SPACE = re.escape(BLANK)
# Latin letters, which every version of Unicode calls letters.
LETTER = "A-Za-z" + "".join(map(chr, [*range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x250)]))
# Runs of whole pre-tokens: the pattern of byte-level BPE always begins a new
# pre-token at these places, whatever letters and signs stand between them. A
# word is also parted from the stop that follows it, so that fewer runs differ.
CHUNKS = re.compile(
    f" ?[{LETTER}]+(?=[.,;:!?])| ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)

LONGEST_KEPT = 64  # characters of a chunk that is worth remembering
MOST_KEPT = 400_000  # chunks a worker remembers before it starts afresh


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


@lru_cache(maxsize=4)
def _loaded(path: str) -> "ByteBpe":
    return ByteBpe(path)


def vocabulary(path: str) -> "ByteBpe":
    """The vocabulary at a path, loaded once a worker."""
    bpe = _loaded(path)
    sole(bpe.kept)
    return bpe


class ByteBpe:
    """A byte-level BPE vocabulary file of the tokenizers library.

    Ids come from that library; a chunk met before is looked up. Special
    strings inside a text become their ids, as the library does by default.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark gives a task one core
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            self.spec = json.load(file)
        split = self.spec["pre_tokenizer"] or {}
        if (
            self.spec["normalizer"] is not None or split.get("type") != "ByteLevel"
            or split.get("add_prefix_space") or not split.get("use_regex", True)
        ):
            raise ValueError(f"not a plain byte-level BPE vocabulary: {path}")
        added = self.spec["added_tokens"]
        if any(x["lstrip"] or x["rstrip"] or x["single_word"] for x in added):
            raise ValueError(f"special tokens that take their surroundings in: {path}")
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.specials = {x["content"]: x["id"] for x in added}
        longest_first = sorted(self.specials, key=len, reverse=True)
        self._special = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")")
        alphabet = byte_alphabet()
        self.bytes_of = [b""] * (1 + max([*self.spec["model"]["vocab"].values(), *self.specials.values()]))
        for token, i in self.spec["model"]["vocab"].items():
            if token not in self.specials:
                self.bytes_of[i] = bytes(alphabet[c] for c in token)
        for token, i in self.specials.items():
            self.bytes_of[i] = token.encode()
        self.sizes = np.array([len(b) for b in self.bytes_of], np.int64)
        self.decimals = [b"%d," % i for i in range(len(self.bytes_of))]
        self.kept: dict[str, bytes] = {}

    def plain_parts(self, text: str) -> list[str]:
        """The text cut at special strings, which are the odd entries."""
        return self._special.split(text) if self.specials else [text]

    def encode_plain(self, text: str) -> np.ndarray:
        """Ids of a text without special strings."""
        return np.frombuffer(self._encode_lists([CHUNKS.findall(text)])[0], "<u4")

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts, as bytes; what is unknown in all of them is encoded together."""
        plain = [not self._special.search(t) if self.specials else True for t in texts]
        found = iter(self._encode_lists([CHUNKS.findall(t) for t, p in zip(texts, plain) if p]))
        return [next(found) if p else self.encode(t).tobytes() for t, p in zip(texts, plain)]

    def _encode_lists(self, lists: list[list[str]]) -> list[bytes]:
        kept = self.kept
        if len(kept) > MOST_KEPT:
            kept.clear()
        long: dict[str, bytes] = {}
        if new := [c for c in set().union(*lists) if c not in kept]:
            for chunk, ids in self._encode_chunks(new):
                (kept if len(chunk) <= LONGEST_KEPT else long)[chunk] = ids
        if long:
            return [b"".join([long[c] if c in long else kept[c] for c in chunks]) for chunks in lists]
        return [b"".join(map(kept.__getitem__, chunks)) for chunks in lists]

    def _encode_chunks(self, chunks: list[str]) -> Iterator[tuple[str, bytes]]:
        """Ids of each chunk. Those that begin with a blank go to the library in one
        string, where each begins a pre-token all the same."""
        spaced = [c for c in chunks if c[0] == " " and len(c) > 1 and c[1] not in BLANK]
        others = [c for c in chunks if not (c[0] == " " and len(c) > 1 and c[1] not in BLANK)]
        strings = ["".join(spaced), *others]
        found = [x.ids for x in self.library.encode_batch_fast(strings, add_special_tokens=False)]
        ids = np.array(found[0], "<u4")
        at = np.searchsorted(
            np.cumsum(self.sizes[ids]), np.cumsum([len(c.encode()) for c in spaced]), "left"
        ) if spaced else []
        data, start = ids.tobytes(), 0
        for chunk, last in zip(spaced, at):
            yield chunk, data[start:4 * (last + 1)]
            start = 4 * (last + 1)
        for chunk, ids in zip(others, found[1:]):
            yield chunk, np.array(ids, "<u4").tobytes()

    def encode(self, text: str, plain=None) -> np.ndarray:
        """Ids of a whole text; ``plain`` encodes what lies between special strings."""
        plain = plain or self.encode_plain
        parts = self.plain_parts(text)
        if len(parts) == 1:
            return plain(text)
        return np.concatenate([
            np.array([self.specials[part]], "<u4") if i % 2 else plain(part)
            for i, part in enumerate(parts) if part
        ] or [np.zeros(0, "<u4")])

    def bytes_for(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids, special strings included; bytes that are no UTF-8 become U+FFFD."""
        return self.bytes_for(ids).decode("utf-8", "replace")

    def decimal(self, ids: np.ndarray) -> bytes:
        """Decimal ids joined by commas."""
        return b"".join(map(self.decimals.__getitem__, ids.tolist()))[:-1]
