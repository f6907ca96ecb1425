"""Token ids of whole text columns, with every distinct word encoded once per Python worker.

Words at ASCII white space are independent for the tokenizer used here (its
normaliser and its splitter never join across white space), and an ASCII letter
followed by ASCII punctuation other than an apostrophe is a split too. So the
ids of a text are the ids of its pieces in order; the pieces are looked up by
64-bit hash and only new ones go through the tokenizers library. A text that holds
the string of an added token (such as <|endoftext|>) is encoded as a whole, because
the library takes these strings out first."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

from poifuse.llm import wordbytes as wb

WORD_BPE = "word_bpe_49k.json"
_MARK = "\x01"
_LETTER = np.zeros(256, dtype=bool)
_LETTER[97:123] = True
_PUNCT = np.zeros(256, dtype=bool)
_PUNCT[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'"]] = True
_KEEP = 400_000  # distinct pieces kept per worker; beyond, the store starts anew


class Encoder:
    """Ids of text columns by one tokenizer file; keeps the ids of the pieces seen."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.mark = self.tokenizer.encode(_MARK, add_special_tokens=False).ids
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(0, dtype=np.uint64)
        self.at = np.zeros(0, dtype=np.int64)
        self.size = np.zeros(0, dtype=np.int32)
        self.ids = np.zeros(0, dtype=np.uint32)

    def _encode(self, pieces: list[str]) -> list[np.ndarray]:
        """Ids of each piece; many share a call, told apart by a mark that is one id."""
        out: list[np.ndarray] = [np.zeros(0, dtype=np.uint32)] * len(pieces)
        plain = [i for i, p in enumerate(pieces) if _MARK not in p] if len(self.mark) == 1 else []
        for k in range(0, len(plain), 2000):
            some = plain[k : k + 2000]
            ids = np.array(self.tokenizer.encode(f" {_MARK} ".join(pieces[i] for i in some), add_special_tokens=False).ids, dtype=np.uint32)
            cuts = np.flatnonzero(ids == self.mark[0])
            if len(cuts) != len(some) - 1:  # a piece held the mark's id itself
                for i in some:
                    out[i] = np.array(self.tokenizer.encode(pieces[i], add_special_tokens=False).ids, dtype=np.uint32)
                continue
            for i, part in zip(some, np.split(ids, cuts)):
                out[i] = part
            for i in some[1:]:
                out[i] = out[i][1:]
        known = set(plain)
        for i, p in enumerate(pieces):
            if i not in known:
                out[i] = np.array(self.tokenizer.encode(p, add_special_tokens=False).ids, dtype=np.uint32)
        return out

    def _learn(self, keys: np.ndarray, pieces: list[str]) -> None:
        if len(self.keys) + len(keys) > _KEEP:
            self._clear()
        ids = self._encode(pieces)
        size = np.array([len(x) for x in ids], dtype=np.int32)
        at = len(self.ids) + np.cumsum(size, dtype=np.int64) - size
        order = np.argsort(np.concatenate([self.keys, keys]), kind="stable")
        self.keys = np.concatenate([self.keys, keys])[order]
        self.at = np.concatenate([self.at, at])[order]
        self.size = np.concatenate([self.size, size])[order]
        self.ids = np.concatenate([self.ids, *ids])

    def _whole(self, column: pa.Array) -> dict[int, np.ndarray]:
        """Ids of the rows that hold the string of an added token."""
        rows: set[int] = set()
        for token in self.added:
            rows.update(np.flatnonzero(pa.compute.match_substring(column, token).fill_null(False).to_numpy(zero_copy_only=False)).tolist())
        return {i: np.array(self.tokenizer.encode(column[i].as_py(), add_special_tokens=False).ids, dtype=np.uint32) for i in rows}

    def column(self, column: pa.Array) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
        """For chunks of rows: the rows, all their ids, and each row's first id."""
        data, bounds = wb.text_column(column)
        row, rows = 0, len(bounds) - 1
        whole = self._whole(column)
        while row < rows:
            stop = max(row + 1, int(np.searchsorted(bounds, bounds[row] + (1 << 20), side="right")) - 1)
            raw = wb.LOWER[data[bounds[row] : bounds[stop]]]
            start, end, first = wb.split(raw, bounds[row : stop + 1] - bounds[row])
            if len(raw) > 1:  # cut a letter from the punctuation after it
                cut = np.flatnonzero(_LETTER[raw[:-1]] & _PUNCT[raw[1:]]) + 1
                cut = cut[np.searchsorted(start, cut, side="left") == np.searchsorted(start, cut, side="right")]  # not at a row's start
                if len(cut):
                    start = np.sort(np.concatenate([start, cut]))
                    end = np.sort(np.concatenate([end, cut]))
                    first = np.searchsorted(start, bounds[row : stop + 1] - bounds[row])
            keys = wb.span_hash(wb.prefix_hash(wb._VALUES[raw]), start, end)
            distinct, example, inverse = np.unique(keys, return_index=True, return_inverse=True)
            if len(self.keys) + len(distinct) > _KEEP:
                self._clear()
            spot = np.searchsorted(self.keys, distinct)
            new = np.ones(len(distinct), dtype=bool) if not len(self.keys) else self.keys[np.minimum(spot, len(self.keys) - 1)] != distinct
            if new.any():
                view = raw.tobytes()
                self._learn(distinct[new], [view[a:b].decode("utf-8", "replace") for a, b in zip(start[example[new]].tolist(), end[example[new]].tolist())])
                spot = np.searchsorted(self.keys, distinct)
            spot = spot[inverse]
            size = self.size[spot].astype(np.int64)
            ends = np.cumsum(size)
            total = int(ends[-1]) if len(ends) else 0
            ids = self.ids[np.repeat(self.at[spot] - (ends - size), size) + np.arange(total)]
            bound = np.concatenate([[0], ends]).astype(np.int64)[first]
            if any(row <= i < stop for i in whole):
                texts = [whole.get(i, ids[a:b]) for i, a, b in zip(range(row, stop), bound[:-1].tolist(), bound[1:].tolist())]
                ids, bound = np.concatenate(texts), np.cumsum([0, *map(len, texts)], dtype=np.int64)
            yield slice(row, stop), ids, bound
            row = stop
        pa.default_memory_pool().release_unused()


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per tokenizer file and Python worker, kept between tasks."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
