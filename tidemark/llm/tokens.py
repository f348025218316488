"""Token ids of whole texts, as the tokenizers library gives them, in tasks.

Byte-level BPE without a normalizer splits text by a pattern before it merges.
Between a character that is no white space and white space, between an ASCII
letter and a comma or full stop, and behind a lone line feed the pattern always
splits, so the ids of a text are those of its pieces in turn. Pieces repeat, and
each worker encodes a piece once for as long as it remembers it. Pieces are looked up
by hash and compared byte by byte. Other tokenizers get whole texts.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np
import pyarrow as pa

from tidemark.llm.words import quick_hashes, text_bytes

#: Pieces a worker remembers; beyond, it forgets those it has met in one batch only.
REMEMBERED = 3 << 18
#: Text bytes of one encoding batch.
BATCH_BYTES = 1 << 20

# Kinds of bytes, as bits.
_BLANK, _SOLID, _LETTER, _POINT, _PAIR, _FEED = 1, 2, 4, 8, 16, 32


def _kinds() -> np.ndarray:
    kind = np.zeros(256, np.uint8)
    kind[[0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20]] |= _BLANK
    kind[0x21:0x7F] |= _SOLID
    kind[ord("A") : ord("Z") + 1] |= _LETTER
    kind[ord("a") : ord("z") + 1] |= _LETTER
    kind[[ord(","), ord(".")]] |= _POINT
    # First bytes of two-byte characters of which none is white space.
    kind[0xC3:0xE0] |= _PAIR
    kind[0x0A] |= _FEED
    return kind


_KIND = _kinds()
#: Pieces that may be joined to one text: a blank, then characters that are none.
_PLAIN = re.compile(rb" (?:[\x21-\x7e]|[\xc3-\xdf][\x80-\xbf])+")


def safe_boundaries(offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Sorted starts of pieces: text starts and safe places inside texts."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    kind = _KIND[data]
    solid = (kind & _SOLID) != 0
    starts_solid = (kind & (_SOLID | _PAIR)) != 0
    solid[1:] |= (kind[:-1] & _PAIR) != 0  # the second byte ends such a character
    first = np.zeros(n, bool)
    first[offsets[:-1][offsets[:-1] < n]] = True
    cut = first.copy()
    cut[1:] |= solid[:-1] & ((kind[1:] & _BLANK) != 0)
    # The bit of a letter is half that of a point.
    cut[1:] |= ((kind[:-1] << 1) & kind[1:] & _POINT) != 0
    lone = (kind & _FEED) != 0
    lone[1:] &= solid[:-1] | first[1:]
    cut[1:] |= lone[:-1] & starts_solid[1:]
    return np.flatnonzero(cut)


def _distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct values, a place of each, and every value's rank."""
    order = np.argsort(hashes)
    ordered = hashes[order]
    new = np.ones(len(ordered), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    rank = np.empty(len(ordered), np.int64)
    rank[order] = np.cumsum(new) - 1
    return ordered[new], order[new], rank


def _places(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """All places of runs, each given by its first place and their number."""
    before = np.cumsum(count, dtype=np.int64) - count
    return np.arange(int(count.sum())) + np.repeat(first - before, count)


class Encoder:
    """Ids of texts; keeps ids of pieces between calls."""

    def __init__(self, path: str, keep_ids: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.keep_ids = keep_ids
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        special = "".join(t["content"] for t in spec.get("added_tokens", []))
        free = not any(
            t[k] for t in spec.get("added_tokens", []) for k in ("single_word", "lstrip", "rstrip")
        )
        self.in_pieces = (
            pre.get("type") == "ByteLevel"
            and pre.get("use_regex", True)
            and not pre.get("add_prefix_space")
            and spec.get("normalizer") is None
            and not any(c in special for c in "\t\n\v\f\r ,.")
            and free
        )
        self.size = self.tokenizer.get_vocab_size()
        tokens = (self.tokenizer.id_to_token(k) or "" for k in range(self.size))
        # Byte-level vocabularies write a blank as U+0120.
        self.opens = np.array([t[:1] == "\u0120" for t in tokens])
        self._forget()

    def _forget(self) -> None:
        # Known pieces by hash, sorted; slot says where the rest stands.
        self.hashes = np.zeros(0, np.uint64)
        self.slot = np.zeros(0, np.int32)
        self.count = np.zeros(0, np.int32)
        self.length = np.zeros(0, np.int32)
        self.first = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)
        self.start = np.zeros(0, np.int64)
        self.bytes = np.zeros(0, np.uint8)
        self.again = np.zeros(0, bool)

    def _make_room(self, more: int) -> None:
        """Forget pieces that were not met again since the last time."""
        if len(self.hashes) + more <= REMEMBERED:
            return
        kept = np.flatnonzero(self.again[self.slot])
        if len(kept) + more > REMEMBERED // 2:
            self._forget()
            return
        slot = self.slot[kept]
        self.hashes, self.slot = self.hashes[kept], np.arange(len(kept), dtype=np.int32)
        self.bytes = self.bytes[_places(self.start[slot], self.length[slot])]
        self.count, self.length = self.count[slot], self.length[slot]
        self.start = np.cumsum(self.length, dtype=np.int64) - self.length
        if self.keep_ids:
            self.ids = self.ids[_places(self.first[slot], self.count)]
            self.first = np.cumsum(self.count, dtype=np.int64) - self.count
        self.again = np.zeros(len(kept), bool)

    def _encode(self, texts: list[str]) -> list:
        return self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)

    def _encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """An order of the pieces, and in it the number of ids of each and all ids.

        Plain pieces go to the library as one text: between them is a safe
        place, and an id with a blank in front shows where each begins.
        """
        plain = np.array([bool(_PLAIN.fullmatch(p)) for p in pieces])
        first = np.flatnonzero(plain)
        joined = b"".join([pieces[k] for k in first]).decode("utf-8")
        ids = np.array(self._encode([joined])[0].ids, np.uint32)
        starts = np.flatnonzero(self.opens[ids])
        if len(starts) != len(first):
            first, ids, starts = first[:0], ids[:0], starts[:0]
            plain[:] = False
        rest = np.flatnonzero(~plain)
        found = self._encode([pieces[k].decode("utf-8") for k in rest])
        counts = np.array([len(e) for e in found], np.int64)
        more = [np.array(e.ids, np.uint32) for e in found]
        return (
            np.concatenate([first, rest]),
            np.concatenate([np.diff(starts, append=len(ids)), counts]),
            np.concatenate([ids, *more]),
        )

    def _learn(self, hashes: np.ndarray, pieces: list[bytes]) -> None:
        have = len(self.count)
        order, count, ids = self._encode_pieces(pieces)
        length = np.array([len(p) for p in pieces], np.int32)[order]
        start = len(self.bytes) + np.cumsum(length, dtype=np.int64) - length
        new = np.frombuffer(b"".join([pieces[k] for k in order]), np.uint8)
        self.bytes = np.concatenate([self.bytes, new])
        self.start = np.concatenate([self.start, start])
        self.again = np.concatenate([self.again, np.zeros(len(pieces), bool)])
        self.count = np.concatenate([self.count, count.astype(np.int32)])
        self.length = np.concatenate([self.length, length])
        if self.keep_ids:
            first = len(self.ids) + np.cumsum(count, dtype=np.int64) - count
            self.first = np.concatenate([self.first, first])
            self.ids = np.concatenate([self.ids, ids])
        at = np.searchsorted(self.hashes, hashes)
        slot = np.empty(len(pieces), np.int32)
        slot[order] = np.arange(have, have + len(pieces))
        self.hashes = np.insert(self.hashes, at, hashes)
        self.slot = np.insert(self.slot, at, slot)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray | None]:
        """Number of ids per text, and all ids in order (if kept); null is empty."""
        offsets, data = text_bytes(column)
        if self.in_pieces and len(data) > 2 * BATCH_BYTES and len(offsets) == 2:
            return self._long(data)
        return self._whole(offsets, data)

    def _whole(self, offsets: np.ndarray, data: np.ndarray):
        out = self._by_pieces(offsets, data) if self.in_pieces else None
        if out is not None:
            return out
        texts = [
            data[a:b].tobytes().decode("utf-8")
            for a, b in zip(offsets[:-1], offsets[1:], strict=True)
        ]
        found = self._encode(texts)
        counts = np.array([len(e) for e in found], np.int64)
        if not self.keep_ids:
            return counts, None
        ids = [np.array(e.ids, np.uint32) for e in found]
        return counts, np.concatenate([np.zeros(0, np.uint32), *ids])

    def _long(self, data: np.ndarray):
        """One long text, cut near every BATCH_BYTES where the pattern splits."""
        total, parts, at = 0, [], 0
        while at < len(data):
            end, reach = min(at + BATCH_BYTES, len(data)), 1 << 10
            while end < len(data):
                lo = max(at, end - reach)
                cuts = safe_boundaries(np.array([0, end - lo]), data[lo:end])
                cuts = cuts[cuts > 2]  # what stands before the window counts too
                if len(cuts):
                    end = lo + int(cuts[-1])
                    break
                if lo == at:
                    end, reach = min(end + BATCH_BYTES, len(data)), 2 * reach
                reach *= 2
            text = pa.array([data[at:end].tobytes().decode("utf-8")], pa.large_string())
            counts, ids = self._whole(*text_bytes(text))
            total += int(counts[0])
            parts.append(ids)
            at = end
        counts = np.array([total], np.int64)
        return counts, np.concatenate(parts) if self.keep_ids else None

    def _by_pieces(self, offsets, data):
        start = safe_boundaries(offsets, data)
        bound = np.searchsorted(start, offsets)
        if not len(start):
            return np.zeros(len(offsets) - 1, np.int64), np.zeros(0, np.uint32)
        end = np.append(start[1:], len(data))
        hashes, at, rank = _distinct(quick_hashes(data, start, end))
        self._make_room(len(hashes))
        place = np.searchsorted(self.hashes, hashes)
        known = np.zeros(len(hashes), bool)
        inside = place < len(self.hashes)
        known[inside] = self.hashes[place[inside]] == hashes[inside]
        self.again[self.slot[place[known]]] = True
        if not known.all():
            raw = data.tobytes()
            new = at[~known]
            spans = zip(start[new].tolist(), end[new].tolist(), strict=True)
            self._learn(hashes[~known], [raw[a:b] for a, b in spans])
            place = np.searchsorted(self.hashes, hashes)
        slot = self.slot[place][rank]
        if not np.array_equal(self.length[slot], end - start):
            return None  # two pieces with one hash
        # Pieces follow each other without gaps, so this is the whole text again.
        if not np.array_equal(self.bytes[_places(self.start[slot], self.length[slot])], data):
            return None
        count = self.count[slot]
        total = np.zeros(len(count) + 1, np.int64)
        np.cumsum(count, out=total[1:])
        per_text = total[bound[1:]] - total[bound[:-1]]
        if not self.keep_ids:
            return per_text, None
        place = np.arange(total[-1]) + np.repeat(self.first[slot] - total[:-1], count)
        return per_text, self.ids[place]


def _byte_of_letter() -> dict[str, int]:
    """How byte-level vocabularies write bytes: printable ones as themselves, the others
    by the characters from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Decoder:
    """Texts of ids. Ids of a byte-level vocabulary are bytes, joined by lookup; others
    go through the library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.size = self.tokenizer.get_vocab_size()
        self.by_bytes = (spec.get("decoder") or {}).get("type") == "ByteLevel"
        if self.by_bytes:
            letters = _byte_of_letter()
            added = {t["id"]: t["content"] for t in spec.get("added_tokens", [])}
            pieces = []
            for k in range(self.size):
                token = self.tokenizer.id_to_token(k) or ""
                known = k not in added and all(c in letters for c in token)
                pieces.append(
                    bytes(letters[c] for c in token) if known else added.get(k, token).encode()
                )
            self.length = np.array([len(p) for p in pieces])
            self.start = np.cumsum(self.length) - self.length
            self.bytes = np.frombuffer(b"".join(pieces), np.uint8)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """The texts of runs of ids that follow each other, ``counts`` of them each."""
        ids = np.asarray(ids, np.int64)
        ends = np.cumsum(counts)
        if not self.by_bytes:
            parts = zip((ends - counts).tolist(), ends.tolist(), strict=True)
            return [self.tokenizer.decode(ids[a:b], skip_special_tokens=False) for a, b in parts]
        length = self.length[ids]
        raw = self.bytes[_places(self.start[ids], length)].tobytes()
        edge = np.concatenate([[0], np.cumsum(length)])
        parts = zip(edge[ends - counts].tolist(), edge[ends].tolist(), strict=True)
        return [raw[a:b].decode("utf-8", "replace") for a, b in parts]


_decoders: dict[str, Decoder] = {}


def decoder(path: str) -> Decoder:
    """This process's decoder of a tokenizer file."""
    if path not in _decoders:
        _decoders[path] = Decoder(path)
    return _decoders[path]


_encoders: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, keep_ids: bool = True) -> Encoder:
    """This process's encoder of a tokenizer file."""
    key = (path, keep_ids)
    if key not in _encoders:
        _encoders[key] = Encoder(path, keep_ids)
    return _encoders[key]
