"""Token ids of texts, by the tokenizers library, each distinct piece of a batch encoded once.

A text is cut in front of every space and line feed (byte-level tokenizers) or every ASCII white space
(word tokenizers that drop it), and in front of punctuation behind a letter. The pre-tokenizers of both kinds never join characters across such a cut,
so the ids of a text are the joined ids of its pieces. Arrow finds the distinct pieces of a batch without
a Python object per occurrence; a piece is encoded when the cache first meets it, and the ids of all
occurrences are gathered with numpy. Texts with other runs of white space, or with the string of a special
token, and all texts of any other kind of tokenizer go through the library whole.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CACHE_PIECES = 1_000_000   # about 200 bytes each in a worker
KEPT_PIECES = 150_000      # a packing task drops its cache beyond them
CHUNK_BYTES = 4 << 20
#: Fixed values of the word tokenizer's file: where its pieces are cut, and the normalizers that act within them.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_NORMALIZERS = {"NFC", "Replace", "Lowercase"}
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_LATIN = np.zeros(256, bool)   # second bytes of the Latin-1 letters
_LATIN[[b for b in range(0x80, 0xC0) if b not in (0x97, 0xB7)]] = True
_MARK = np.zeros(256, bool)
_MARK[[b for b in range(0x21, 0x7F) if not chr(b).isalnum()]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LOADED: dict[str, "Encoder"] = {}


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def word_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def row_chunks(column: pa.Array, size: int = CHUNK_BYTES) -> Iterator[pa.Array]:
    """Slices of a string column of about ``size`` bytes (a longer text is a slice of its own)."""
    if not len(column):
        return
    at = np.frombuffer(column.buffers()[1], np.int64 if pa.types.is_large_string(column.type) else np.int32)
    at = at[column.offset:column.offset + len(column) + 1].astype(np.int64)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(at, at[first] + size, "right")) - 1)
        yield column.slice(first, last - first)
        first = last


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indexes ``starts[i], ..., starts[i] + lengths[i] - 1`` of all i, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total, dtype=np.int64)


class Encoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2") if self.size <= 1 << 16 else np.dtype("<u4")
        added = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, added)).encode()) if added else None
        spec = json.loads(self.tokenizer.to_str())
        self.kind = _kind(spec, added)
        cuts = {"byte": b" \n", "word": b" \t\n\x0b\x0c\r"}.get(self.kind, b"")
        self.cuts = np.zeros(256, bool)
        self.cuts[list(cuts)] = True
        self.closes = np.zeros(self.size, bool)
        self.closes[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith("</w>")]] = True
        self.opens = np.zeros(self.size, bool)
        self.opens[[i for t, i in self.tokenizer.get_vocab().items() if t[:1] == "Ġ"]] = True
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.pool = np.zeros(1 << 20, self.dtype)
        self.used = 0
        self.start = np.zeros(1 << 16, np.int64)
        self.length = np.zeros(1 << 16, np.int64)  # -1: a piece whose text goes through the library whole

    def settle(self) -> None:
        """Drops a large cache, which the worker would hold next to the executor's JVM, also through stages of another kind."""
        if len(self.known) > KEPT_PIECES:
            self._forget()

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        out = []
        for at in range(0, len(texts), 5000):
            found = self.tokenizer.encode_batch_fast(texts[at:at + 5000], add_special_tokens=False)
            out += [np.array(e.ids, self.dtype) for e in found]
        return out

    def _joined(self, pieces: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """(ids, lengths) of words behind a space, many in one text: a token that opens with a space begins a piece
        (byte-level), a token that closes a word ends it. Where the count of such tokens differs, one by one."""
        ids, lengths = [], []
        for at in range(0, len(pieces), 100):
            part = pieces[at:at + 100]
            flat = np.array(self.tokenizer.encode_batch_fast(["".join(part)], add_special_tokens=False)[0].ids, self.dtype)
            if self.kind == "byte":
                cut = np.append(np.flatnonzero(self.opens[flat]), len(flat))
            else:
                cut = np.append(0, np.flatnonzero(self.closes[flat]) + 1)
            if len(cut) == len(part) + 1 and cut[0] == 0 and cut[-1] == len(flat):
                ids.append(flat)
                lengths.append(np.diff(cut))
            else:
                own = self._whole(part)
                ids += own
                lengths.append(np.array([len(x) for x in own], np.int64))
        return ids, lengths

    def _regular(self, piece: str) -> bool:
        if self.kind == "word":
            return True
        body = piece[1:] if piece[0] in " \n" else piece
        return body.split() == [body]

    def _learn(self, pieces: list[str]) -> None:
        plain, rest, odd = [], [], []
        for p in pieces:
            # one letter run behind a space, of letters that no normalizer makes more than one
            if p[0] == " " and p[1:].isalpha() and max(p) < "\u0130":
                plain.append(p)
            elif self._regular(p):
                rest.append(p)
            else:
                odd.append(p)
        ids, lengths = self._joined(plain)
        whole = self._whole(rest)
        flat = np.concatenate([np.zeros(0, self.dtype), *ids, *whole])
        size = np.concatenate([np.zeros(0, np.int64), *lengths, np.array([len(x) for x in whole], np.int64)])
        n = len(self.known)
        if n + len(pieces) > len(self.start):
            self.start, self.length = (np.resize(x, 2 * (n + len(pieces))) for x in (self.start, self.length))
        if self.used + len(flat) > len(self.pool):
            self.pool = np.resize(self.pool, 2 * (self.used + len(flat)))
        self.pool[self.used:self.used + len(flat)] = flat
        self.start[n:n + len(size)] = self.used + np.cumsum(size) - size
        self.length[n:n + len(size)] = size
        self.start[n + len(size):n + len(pieces)] = 0
        self.length[n + len(size):n + len(pieces)] = -1
        self.used += len(flat)
        self.known.update(zip(plain + rest + odd, range(n, n + len(pieces))))

    def _numbers(self, pieces: list[str]) -> np.ndarray:
        if len(self.known) > CACHE_PIECES:
            self._forget()
        found = list(map(self.known.get, pieces))
        new = [i for i, x in enumerate(found) if x is None]
        if new:
            self._learn([pieces[i] for i in new])
            for i in new:
                found[i] = self.known[pieces[i]]
        return np.array(found, np.int64)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ends): the ids of all texts of a string column joined, and where each text's ids end. Null: no ids."""
        n = len(column)
        if not n:
            return np.zeros(0, self.dtype), np.zeros(0, np.int64)
        if pa.types.is_large_string(column.type):
            at = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + n + 1]
        else:
            at = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + n + 1].astype(np.int64)
        if not self.kind or at[-1] == at[0] or column.null_count or at[-1] - at[0] >= 1 << 31:
            texts = column.to_pylist()
            if self.kind and at[-1] > at[0] and at[-1] - at[0] < 1 << 31:   # nulls only: their bytes count for nothing
                return self.encode(pa.array([t or "" for t in texts], column.type))
            found = self._whole([t or "" for t in texts])
            return (np.concatenate(found) if found else np.zeros(0, self.dtype),
                    np.cumsum([len(x) for x in found], dtype=np.int64))
        data = np.frombuffer(column.buffers()[2], np.uint8)[at[0]:at[-1]]
        at = at - at[0]
        odd = [m.start() for m in self.special.finditer(data)] if self.special else []
        odd = set((np.searchsorted(at, np.array(odd, np.int64), "right") - 1).tolist())
        if self.kind == "word":
            data = _LOWER[data]
        cut = self.cuts[data]
        # a punctuation mark behind a letter: letters and marks are separate pieces of both patterns
        letter = _LETTER[data[:-1]]
        letter[1:] |= (data[:-2] == 0xC3) & _LATIN[data[1:-1]]
        cut[1:] |= _MARK[data[1:]] & letter
        cut[at[:-1][np.diff(at) > 0]] = True
        starts = np.append(np.flatnonzero(cut), len(data)).astype(np.int32)
        pieces = pa.StringArray.from_buffers(len(starts) - 1, pa.py_buffer(starts), pa.py_buffer(data)).dictionary_encode()
        number = self._numbers(pieces.dictionary.to_numpy(zero_copy_only=False).tolist())[pieces.indices.to_numpy()]
        lengths = self.length[number]
        bounds = np.searchsorted(starts[:-1], at)             # the pieces of text i: bounds[i] to bounds[i + 1]
        odd = sorted(odd.union((np.searchsorted(bounds, np.flatnonzero(lengths < 0), "right") - 1).tolist()))
        np.maximum(lengths, 0, out=lengths)
        for i in odd:                                         # its pieces give no ids; the library's are put in their place
            lengths[bounds[i]:bounds[i + 1]] = 0
        ids = self.pool[spread(self.start[number], lengths)]
        ends = np.append(0, np.cumsum(lengths))[bounds[1:]]
        if odd:
            own = self._whole([column[i].as_py() for i in odd])
            parts, last = [], 0
            for i, x in zip(odd, own):
                parts += [ids[last:ends[i]], x]
                last = ends[i]
            ids = np.concatenate([*parts, ids[last:]])
            more = np.zeros(n, np.int64)
            more[odd] = [len(x) for x in own]
            ends = ends + np.cumsum(more)
        return ids, ends


def _kind(spec: dict, added: list[str]) -> str:
    """'byte' or 'word', where the cuts above hold, else ''."""
    pre, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
    if pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and not norm:
        return "byte"
    steps = pre.get("pretokenizers", [])
    norms = [norm, *norm.get("normalizers", [])] if norm else []
    if (steps and steps[0].get("type") == "Split" and steps[0].get("behavior") == "Removed" and steps[0].get("invert")
            and steps[0].get("pattern") == {"Regex": WORD_PATTERN}
            and all(s.get("type") == "ByteLevel" and not s.get("use_regex") and not s.get("add_prefix_space") for s in steps[1:])
            and all(x["type"] in WORD_NORMALIZERS for x in norms if x["type"] != "Sequence")
            and all(x["pattern"] == {"Regex": "\\s+"} and x["content"] == " " for x in norms if x["type"] == "Replace")
            and not any(c in t for t in added for c in " \t\n\x0b\x0c\r")):
        return "word"
    return ""


def encoder(path: str) -> Encoder:
    if path not in _LOADED:
        _LOADED[path] = Encoder(path)
    return _LOADED[path]
