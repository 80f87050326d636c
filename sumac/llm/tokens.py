"""Token ids by the tokenizers library, each distinct piece of text tokenized once per task."""

from __future__ import annotations

import json
import os
from collections.abc import Callable
from itertools import chain

import numpy as np

from sumac.llm.pieces import REMEMBERED, PieceCache
from sumac.llm.ragged import spread
from sumac.llm.texts import units


def by_spaces(text: str) -> list[str]:
    """Pieces, some of them empty, for tokenizers that drop white space between words."""
    return text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")


def by_units(text: str) -> list[str]:
    """Pieces for tokenizers whose words carry one leading space."""
    first, *rest = units(text)
    return [first, *[" " + r for r in rest]]


def _byte_counts(definition: str) -> np.ndarray | None:
    """The bytes of every id, if the definition is a plain byte-level one, whose ids stand for the bytes of the text as it is; else None."""
    parts = json.loads(definition)
    before, model = parts.get("pre_tokenizer") or {}, parts["model"]
    plain = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space", True)
    if not plain or parts.get("normalizer") or not isinstance(model.get("vocab"), dict) or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix"):
        return None
    counts = np.zeros(max(model["vocab"].values(), default=0) + 1, np.int64)
    for token, number in model["vocab"].items():
        counts[number] = len(token)
    return counts


def read_tokenizer(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


class TextEncoder:
    """``ids(texts)``: the ids of whole texts, without special tokens; their strings in a text are ordinary text.

    New pieces are tokenized in lists of bounded length, without offsets. Units that begin with a space are joined for a
    byte-level tokenizer, as a call costs more than a word; the bytes of the ids tell where each unit ends.
    """

    #: Pieces handed over at once, and units joined to one text.
    TOGETHER, JOINED = 4096, 256

    def __init__(self, definition: str, cut: Callable[[str], list[str]], remembered: int):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_str(definition)
        self.model.encode_special_tokens = True
        self.counts = _byte_counts(definition) if cut is by_units else None
        self.cut, self.cache = cut, PieceCache(self._encode if self.counts is None else self._encode_joined, remembered)

    def _encode_joined(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        joins = np.array([p[:1] == " " and p[1:2].strip() != "" for p in pieces], bool)
        order = np.argsort(~joins, kind="stable")
        ordered, whole = [pieces[k] for k in order.tolist()], int(joins.sum())
        sizes, flat = [], []
        for at in range(0, whole, self.TOGETHER):
            own = ordered[at : min(at + self.TOGETHER, whole)]
            texts = ["".join(own[k : k + self.JOINED]) for k in range(0, len(own), self.JOINED)]
            made = [e.ids for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]
            ids = np.fromiter(chain.from_iterable(made), np.int32, sum(map(len, made)))
            ends = np.cumsum(self.counts[ids])
            wanted = np.cumsum(np.fromiter((len(p.encode()) for p in own), np.int64, len(own)))
            last = np.searchsorted(ends, wanted)
            if not len(ends) or ends[-1] != wanted[-1] or (ends[last] != wanted).any():
                ids, size = self._encode(own)  # an id lies across two units
            else:
                size = np.diff(last, prepend=-1)
            flat.append(ids)
            sizes.append(size)
        ids, size = self._encode(ordered[whole:])
        ids, size = np.concatenate([*flat, ids]), np.concatenate([*sizes, size])
        starts, counts = np.empty(len(pieces), np.int64), np.empty(len(pieces), np.int64)
        starts[order], counts[order] = np.cumsum(size) - size, size
        return ids[spread(starts, counts)], counts

    def _encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        sizes, flat = np.zeros(len(pieces), np.int64), [np.empty(0, np.int32)]
        for at in range(0, len(pieces), self.TOGETHER):
            made = [e.ids for e in self.model.encode_batch_fast(pieces[at : at + self.TOGETHER], add_special_tokens=False)]
            own = sizes[at : at + self.TOGETHER]
            own[:] = [len(ids) for ids in made]
            flat.append(np.fromiter(chain.from_iterable(made), np.int32, int(own.sum())))
        return np.concatenate(flat), sizes

    def ids(self, texts: list[bytes]) -> list[np.ndarray]:
        return self.cache.ids([self.cut(t.decode("utf-8", "replace")) for t in texts])


_KEPT: dict[tuple, TextEncoder] = {}


def encoder(definition: str, cut: Callable[[str], list[str]], remembered: int = REMEMBERED) -> TextEncoder:
    """The encoder of this worker process; its remembered pieces serve later tasks too."""
    key = (hash(definition), cut.__name__, remembered)
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = TextEncoder(definition, cut, remembered)
    return _KEPT[key]
