"""Exact library tokenization, sped up by a bounded cache of words.

Both vocabularies' pre-tokenizers that this module is used with cut at white
space, drop it, and never look across it, so the ids of a text are the ids of
its ASCII-white-space-separated words, one after the other. Words repeat; each
is looked at once per batch. A word of letters, digits and plain punctuation is
taken apart at the punctuation, where the pre-tokenizer cuts it too, and its
parts are looked up regardless of case in what this worker has encoded before;
so a rare word costs one encoding, not one for each of its shapes.
Texts for other tokenizers go through the library whole.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words above this many bytes are not worth remembering.
LONG_WORD = 128
#: Entries of one worker's cache; about 60 MB.
CACHE_ENTRIES = 300_000

# Fixed values of the tokenizer format: what a pre-tokenizer has to look like for words to be taken apart.
_LETTER_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Punctuation but for the apostrophe and the signs of special tokens; letters (ASCII, Latin-1, Latin Extended-A) and digits.
_SIGNS = r"!-&(-/:;=?@\[-`{}~"
_ALNUM = "A-Za-z0-9\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f"  # but the dotted I, whose lower case ends in a mark
_LETTERS = re.compile("[a-z\u00df-\u00f6\u00f8-\u017f]+\\Z")

_loaded: dict[str, "WordCache | PieceModel"] = {}


def _spec(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def _byte_letters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: itself if printable, else the next from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = (b for b in range(256) if b not in printable)
    shown = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}
    return [shown[b] for b in range(256)]


def _cuts_at_space(path: str) -> bool:
    """True if the file's pre-tokenizer matches only runs without white space, and drops the rest."""
    spec = _spec(path)
    steps = spec.get("pre_tokenizer") or {}
    first = (steps.get("pretokenizers") or [steps])[0]
    added = spec.get("added_tokens") or []
    return (
        first.get("type") == "Split"
        and first.get("behavior") == "Removed"
        and bool(first.get("invert"))
        and "\\s" in str(first.get("pattern"))
        and not any(a["lstrip"] or a["rstrip"] or a["single_word"] or " " in a["content"] for a in added)
        and spec.get("post_processor") is None
        and spec.get("truncation") is None
    )


def _joined(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All ids, and where each part's begin and end among them."""
    ends = np.concatenate([[0], np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) // 4)])
    return np.frombuffer(b"".join(parts), "<u4"), ends


def _gather(ids: np.ndarray, starts: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the parts that ``which`` names, one after the other, and their bounds."""
    sizes = np.diff(starts)[which]
    ends = np.zeros(len(which) + 1, np.int64)
    np.cumsum(sizes, out=ends[1:])
    at = np.repeat(starts[:-1][which] - ends[:-1], sizes)
    at += np.arange(ends[-1])
    return ids[at], ends


class WordCache:
    """``encode`` of an array of texts: all token ids, and the bounds of each text's, for ``tokenizers`` files."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.by_word = _cuts_at_space(path)
        spec = _spec(path)
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or []
        self.by_part = (
            self.by_word
            and [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
            and [s["type"] for s in steps] == ["Split", "ByteLevel"]
            and steps[0]["pattern"] == {"Regex": _LETTER_SPLIT}
            and not steps[1]["add_prefix_space"]
            and not steps[1].get("use_regex", True)
        )
        self.model, self.letters = self.tokenizer.model, _byte_letters()
        self.known: dict[bytes, bytes] = {b"": b""}

    def _library(self, texts: list[str]) -> list[bytes]:
        encode = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        return [array("I", e.ids).tobytes() for e in encode(texts, add_special_tokens=False)]

    def _lookup(self, parts: list[bytes]) -> list[bytes]:
        """Ids of each of distinct parts; a part of letters alone is one pre-token and goes straight to the merges."""
        found = list(map(self.known.get, parts))
        fresh: dict[bytes, bytes] = {}
        whole: list[bytes] = []
        for part in (p for p, ids in zip(parts, found) if ids is None):
            low = part.decode("utf-8", "replace").lower() if self.by_part else ""
            if _LETTERS.match(low):
                shown = low if low.isascii() else "".join(map(self.letters.__getitem__, low.encode()))
                fresh[part] = array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()
            else:
                whole.append(part)
        if whole:
            fresh.update(zip(whole, self._library([p.decode("utf-8", "replace") for p in whole])))
        if fresh:
            found = [fresh[p] if ids is None else ids for p, ids in zip(parts, found)]
            self.known.update((p, ids) for p, ids in fresh.items() if len(p) <= LONG_WORD)
            if len(self.known) > CACHE_ENTRIES:  # early entries are the frequent words
                self.known = dict(islice(self.known.items(), CACHE_ENTRIES // 2))
        return found

    def _distinct(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words, and their bounds."""
        if not self.by_part:
            return _joined(self._lookup(words.cast(pa.large_binary()).to_pylist()))
        plain = pc.match_substring_regex(words, f"^[{_ALNUM}{_SIGNS}]*$")
        cut = pc.replace_substring_regex(pc.ascii_lower(words), f"([{_SIGNS}]+)", r" \1 ")
        lists = pc.ascii_split_whitespace(pc.if_else(plain, cut, words))
        parts = lists.flatten().dictionary_encode()
        ids, starts = _joined(self._lookup(parts.dictionary.cast(pa.large_binary()).to_pylist()))
        flat, ends = _gather(ids, starts, parts.indices.to_numpy())
        return flat, ends[lists.offsets.to_numpy()]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if not self.by_word:
            return _joined(self._library(texts.to_pylist()))
        lists = pc.ascii_split_whitespace(texts.cast(pa.large_string()))
        words = lists.flatten().dictionary_encode()
        ids, starts = self._distinct(words.dictionary)
        flat, ends = _gather(ids, starts, words.indices.to_numpy())
        return flat, ends[lists.offsets.to_numpy()]


class PieceModel:
    """The same for ``sentencepiece`` models."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        return _joined([array("I", ids).tobytes() for ids in self.model.encode(texts.to_pylist(), num_threads=1)])


def tokenizer(path: str):
    """This worker's tokenizer for a file: ``.model`` is sentencepiece, all else ``tokenizers``."""
    if path not in _loaded:
        _loaded[path] = (PieceModel if path.endswith(".model") else WordCache)(path)
    return _loaded[path]


def in_slices(texts: pa.Array, rows: int = 5000, size: int = 8_000_000):
    """(start, stop) of runs of at most so many texts and, beyond one text, so many bytes."""
    sizes = pc.binary_length(texts).to_pylist()
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and (i - start >= rows or total + n > size):
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)
