"""A byte-level BPE vocabulary file, and the proofs that let faster paths stand in for its library.

The file's library (``tokenizers``) defines what is right. Two shortcuts are proved on the
driver before any text is read:

* the vocabulary's ids follow the order of its merges, so that merging by rank gives the
  same ids as merging by the merge list;
* every code point falls into the same class (letter, digit, white space, other) for the
  library's splitter and for the one used here. Texts that hold a code point for which the
  proof fails go to the library itself, as do texts with a run of over ``LONG_RUN`` bytes
  without a change between white space and other bytes.
"""

from __future__ import annotations

import json
import re
import unicodedata
from functools import cached_property, lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from tokenizers import Tokenizer

from airloom.llm.common import texts_of

# Fixed value: how byte-level vocabularies of this kind split text.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LONG_RUN = 1024


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the file: itself if printable, else the next free."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


TO_LETTERS = {number: letter for letter, number in byte_letters().items()}


class Vocabulary:
    """Built from the text of a vocabulary file, so that executors need no file."""

    def __init__(self, source: str, odd: str | None = None) -> None:
        self.source = source
        self.parts = json.loads(source)
        self.specials = {t["content"]: t["id"] for t in self.parts["added_tokens"]}
        self.odd = self.unproved_points() if odd is None else odd

    def __reduce__(self):
        return Vocabulary, (self.source, self.odd)

    @cached_property
    def library(self) -> Tokenizer:
        return Tokenizer.from_str(self.source)

    @cached_property
    def ranks(self) -> dict[bytes, int]:
        letters = byte_letters()
        return {
            bytes(letters[c] for c in word): number
            for word, number in self.parts["model"]["vocab"].items()
            if word not in self.specials
        }

    @cached_property
    def by_rank(self) -> tiktoken.Encoding | None:
        """Merging by rank, where the file's merges prove to be in the order of the ids."""
        vocab, previous = self.parts["model"]["vocab"], -1
        for merge in self.parts["model"]["merges"]:
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            if vocab[left + right] <= previous:
                return None
            previous = vocab[left + right]
        return tiktoken.Encoding(
            "given", pat_str=SPLIT, mergeable_ranks=self.ranks, special_tokens=self.specials
        )

    def unproved_points(self) -> str:
        """A pattern of all code points but those that three splitters prove to see alike.

        Candidates are the points of the first plane whose class is as it was in Unicode 3.2;
        each is shown to the splitters next to a letter, a digit, a mark and a line end.
        """
        old, ours = unicodedata.ucd_3_2_0, regex.compile(SPLIT)
        classes = [regex.compile(p) for p in (r"\p{L}", r"\p{N}", r"\s")]
        pairs = {bytes([x, b]) for x in b"a1.\n " for b in range(0x80, 0x100)}
        ranks = {bytes([b]): b for b in range(256)} | {p: 256 + i for i, p in enumerate(sorted(pairs))}
        fast = tiktoken.Encoding("probe", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

        def ids(piece: str) -> list[int]:
            data, out, i = piece.encode(), [], 0
            while i < len(data):
                n = 2 if data[i : i + 2] in ranks and i + 1 < len(data) else 1
                out.append(ranks[data[i : i + n]])
                i += n
            return out

        def alike(points: list[int]) -> list[int]:
            text = "".join(f"a{chr(c)}1{chr(c)}.{chr(c)}\n{chr(c)} {chr(c)} " for c in points)
            pieces = ours.findall(text)
            ends = [end for _, (_, end) in self.library.pre_tokenizer.pre_tokenize_str(text)]
            if ends == list(accumulate(map(len, pieces))) and (
                fast.encode_ordinary(text) == [i for p in pieces for i in ids(p)]
            ):
                return points
            half = len(points) // 2
            return alike(points[:half]) + alike(points[half:]) if half else []

        def steady(c: int) -> bool:
            kind = old.category(chr(c))
            now = [bool(p.match(chr(c))) for p in classes]
            return kind not in ("Cn", "Cs") and now[:2] == [kind[0] == "L", kind[0] == "N"]

        points = [c for c in range(0x10000) if steady(c)]
        proved = [c for i in range(0, len(points), 4096) for c in alike(points[i : i + 4096])]
        breaks = [i for i in range(1, len(proved)) if proved[i] != proved[i - 1] + 1]
        runs = zip([0, *breaks], [*breaks, len(proved)], strict=True)
        return "[^" + "".join(f"\\u{proved[i]:04x}-\\u{proved[j - 1]:04x}" for i, j in runs) + "]"

    @cached_property
    def odd_points(self):
        return re.compile(self.odd)

    def needs_library(self, text: str) -> bool:
        return self.by_rank is None or (
            not text.isascii() and self.odd_points.search(text) is not None
        )

    def ids(self, text: str, long_run: bool = False) -> np.ndarray:
        """The ids of a whole text, special strings in it taken as such."""
        if long_run or self.needs_library(text):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)
        if any(s in text for s in self.specials):
            return np.array(self.by_rank.encode(text, allowed_special="all"), np.uint32)
        return self.by_rank.encode_to_numpy(text, disallowed_special=())

    @cached_property
    def whole_tokens(self) -> dict[str, int]:
        """The strings proved to be one pre-token and one id on their own: each counts 1."""
        whole = {}
        for data in self.ranks:
            try:
                piece = data.decode()
            except UnicodeDecodeError:
                continue
            if len(self.pieces(piece)) == 1 and len(self.merged(piece)) == 1:
                whole[piece] = 1
        return whole

    @cached_property
    def pieces(self):
        return regex.compile(SPLIT).findall

    def merged(self, piece: str) -> list:
        """The library's own merging of one pre-token."""
        return self.library.model.tokenize(piece.encode().decode("latin-1").translate(TO_LETTERS))


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """Read and proved once a driver."""
    with open(path, encoding="utf-8") as file:
        return Vocabulary(file.read())


def long_runs(batch: pa.RecordBatch, name: str = "text") -> np.ndarray:
    """Which texts hold a run of over LONG_RUN bytes that are all white space or all not."""
    data, offsets = texts_of(batch, name)
    found = np.zeros(len(offsets) - 1, bool)
    if not len(data):
        return found
    blank = data <= 32
    ends = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    cuts = np.unique(np.concatenate([[0], ends, offsets]))
    cuts = cuts[cuts <= len(data)]
    long = cuts[:-1][np.diff(cuts) > LONG_RUN]
    found[np.searchsorted(offsets, long, side="right") - 1] = True
    return found
