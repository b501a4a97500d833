"""Token ids of distinct strings, encoded once per worker process.

A text is cut where no token of the tokenizer can cross, and equal pieces are encoded once.  How a text
may be cut follows from the tokenizer's file:

* ``words``: white space is dropped and words are encoded apart, so any white space separates.
* ``spaces``: a space starts the word after it, so a text is cut before each single space.  Runs of
  spaces and a closing space join with what is around them; such texts are encoded whole.
* ``whole``: anything else is not cut.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

import numpy as np  # noqa: E402
import pyarrow as pa  # noqa: E402
import pyarrow.compute as pc  # noqa: E402

#: Distinct pieces that a worker keeps; beyond that it starts anew.  Bounds memory, not results.
KEPT_PIECES = 700_000
#: Bytes of text worked on at a time.
PART_BYTES = 24 << 20


def resolve(tokenizer: str) -> str:
    """A path as it is; a bare file name from the folder of public tokenizers."""
    if os.sep in tokenizer:
        return tokenizer
    import public_tokenizers

    return public_tokenizers.path(tokenizer)


def version(tokenizer: str) -> str:
    """Digest of the tokenizer's file and of the library that reads it."""
    library = "sentencepiece" if tokenizer.endswith(".model") else "tokenizers"
    digest = hashlib.sha256(f"{library} {__import__(library).__version__}\n".encode())
    with open(resolve(tokenizer), "rb") as file:
        digest.update(file.read())
    return digest.hexdigest()


def cut_of(path: str) -> str:
    """``words``, ``spaces`` or ``whole``."""
    if not path.endswith(".json"):
        return "whole"
    with open(path, encoding="utf-8") as file:
        settings = json.load(file)
    before, normal = settings["pre_tokenizer"] or {}, settings["normalizer"] or {}
    plain = all(not t["lstrip"] and not t["rstrip"] and not t["single_word"] for t in settings["added_tokens"])
    if not plain or settings["post_processor"]:
        return "whole"
    if before.get("type") == "ByteLevel" and before["use_regex"] and not before["add_prefix_space"] and not normal:
        return "spaces"
    steps = normal.get("normalizers", [])
    parts = before.get("pretokenizers", [])
    if (
        [s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"]
        and steps[1]["pattern"] == {"Regex": r"\s+"}
        and parts
        and parts[0]["type"] == "Split"
        and parts[0]["behavior"] == "Removed"
        and parts[0]["invert"]
        and r"[^\s" in parts[0]["pattern"]["Regex"]
    ):
        return "words"
    return "whole"


class Encoder:
    """Ids of strings, with those of recent strings kept."""

    def __init__(self, path: str, kept: int = KEPT_PIECES):
        self.kept = kept
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self._encode = lambda texts: model.encode(texts, num_threads=1)
        else:
            from tokenizers import Tokenizer

            model = Tokenizer.from_file(path)
            self._encode = lambda texts: [e.ids for e in model.encode_batch_fast(texts, add_special_tokens=False)]
        self.cut = cut_of(path)
        self._clear()

    def _clear(self) -> None:
        self._place: dict[str, int] = {}
        self.start = np.zeros(1 << 16, np.int64)
        self.length = np.zeros(1 << 16, np.int64)
        self.ids = np.zeros(1 << 18, np.uint32)
        self._used = 0

    def places(self, strings: list[str]) -> np.ndarray:
        """Index of each string into ``start`` and ``length``, valid until the next call."""
        if len(self._place) > self.kept:
            self._clear()
        known = self._place
        new = list(dict.fromkeys(s for s in strings if s not in known))
        for at in range(0, len(new), 20_000):
            self._add(len(known), new[at : at + 20_000])
        return np.fromiter(map(known.__getitem__, strings), np.int64, len(strings))

    def _add(self, first: int, strings: list[str]) -> None:
        encoded = self._encode(strings)
        lengths = np.fromiter(map(len, encoded), np.int64, len(encoded))
        end = first + len(strings)
        while end > len(self.start):
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
            self.length = np.concatenate([self.length, np.zeros_like(self.length)])
        self.length[first:end] = lengths
        self.start[first:end] = self._used + np.cumsum(lengths) - lengths
        total = int(lengths.sum())
        while self._used + total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self._used : self._used + total] = np.fromiter((i for e in encoded for i in e), np.uint32, total)
        self._used += total
        self._place.update(zip(strings, range(first, end)))

    def whole(self, texts: list[str]) -> list[list[int]]:
        return self._encode(texts)


_ENCODERS: dict[str, Encoder] = {}


def encoder(tokenizer: str, kept: int = KEPT_PIECES) -> Encoder:
    """One per worker process and tokenizer."""
    path = resolve(tokenizer)
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path, kept)
    return _ENCODERS[path]


def forget() -> None:
    """Give back the memory of all encoders of this worker."""
    _ENCODERS.clear()
    pa.default_memory_pool().release_unused()


def parts(column: pa.Array, most: int = PART_BYTES) -> Iterator[pa.Array]:
    """Slices of a string column of about ``most`` bytes; nulls become empty."""
    column = column.fill_null("")
    sizes = pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    group = np.cumsum(sizes) // most
    at = 0
    for n in np.unique(group, return_counts=True)[1]:
        yield column.slice(at, int(n))
        at += int(n)


def _lists(column: pa.Array, cut: str) -> tuple[pa.Array, np.ndarray]:
    lists = pc.ascii_split_whitespace(column) if cut == "words" else pc.split_pattern(column, " ")
    offsets = lists.offsets.to_numpy().astype(np.int64)
    return lists.flatten(), offsets - offsets[0]


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    running = np.concatenate([[0], np.cumsum(values)])
    return running[offsets[1:]] - running[offsets[:-1]]


def count(column: pa.Array, tokenizer: str) -> np.ndarray:
    """Tokens of each text."""
    tool = encoder(tokenizer)
    out = [np.zeros(0, np.int64)]
    for part in parts(column):
        n = np.zeros(len(part), np.int64)
        joined = np.ones(len(part), bool)
        if tool.cut == "spaces":
            joined = pc.or_(pc.match_substring(part, "  "), pc.ends_with(part, " ")).to_numpy(zero_copy_only=False)
        elif tool.cut == "words":
            joined = np.zeros(len(part), bool)
        if joined.any():
            n[joined] = [len(ids) for ids in tool.whole(part.filter(pa.array(joined)).to_pylist())]
        if not joined.all():
            flat, offsets = _lists(part.filter(pa.array(~joined)), tool.cut)
            coded = flat.dictionary_encode()
            strings = coded.dictionary.to_pylist()
            led = [" " + s for s in strings] if tool.cut == "spaces" else strings
            place = tool.places(led)
            lengths = tool.length[place][coded.indices.to_numpy()]
            if tool.cut == "spaces":
                # The first piece of a text has no space before it.
                firsts = flat.take(pa.array(offsets[:-1])).to_pylist()
                place = tool.places(firsts)
                lengths[offsets[:-1]] = tool.length[place]
            n[~joined] = _sums(lengths, offsets)
        out.append(n)
    return np.concatenate(out)


def ids(column: pa.Array, tokenizer: str, kept: int = KEPT_PIECES, part_bytes: int = PART_BYTES) -> Iterator[np.ndarray]:
    """Token ids of each text, as unsigned 32-bit numbers."""
    tool = encoder(tokenizer, kept)
    for part in parts(column, part_bytes):
        if tool.cut != "words":
            yield from (np.array(x, np.uint32) for x in tool.whole(part.to_pylist()))
            continue
        flat, offsets = _lists(part, tool.cut)
        coded = flat.dictionary_encode()
        place = tool.places(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
        lengths = tool.length[place]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        source = np.repeat(tool.start[place] - (ends - lengths), lengths) + np.arange(total)
        every = tool.ids[source]
        bounds = np.concatenate([[0], ends])[offsets]
        for a, b in zip(bounds[:-1], bounds[1:]):
            yield every[a:b]
