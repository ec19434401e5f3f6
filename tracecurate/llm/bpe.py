"""Byte-level BPE by dynamic programming over prefixes.

For every prefix of a piece exactly one token can end its encoding: the one that is
compatible with the last token of the prefix before it. The table of these last tokens
is the encoding of all prefixes at once. Appending only extends it, and after an edit
it is filled again from the edit on, until it falls in with the old one. Many short pieces
fill their tables side by side, one end after the other.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from .common import narrow

_CACHED = 100_000  # pieces, and token pairs, that a worker remembers
_LONG = 64  # bytes; longer pieces are not remembered
_CELLS = 1 << 20  # prefixes whose last tokens are held at once
_SLICE = 1 << 20  # bytes of text whose pieces are held at once


class Lookup:
    """Values of keys from 0 on, -1 for all others; asked for many keys at once."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = (4 * len(keys) + 1).bit_length()
        self._mask, self._shift = (1 << bits) - 1, np.uint64(64 - bits)
        self._keys, self._values = np.full(1 << bits, -1, dtype=np.int64), np.full(1 << bits, -1, dtype=np.int32)
        place = self._home(keys)
        while len(keys):
            free = self._keys[place] < 0
            self._keys[place[free]] = keys[free]  # of several for one place the last stays
            there = self._keys[place] == keys
            self._values[place[there]] = values[there]
            keys, values, place = keys[~there], values[~there], (place[~there] + 1) & self._mask

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self._shift).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        place = self._home(keys)
        held = self._keys[place]
        out = np.where(held == keys, self._values[place], np.int32(-1))
        more = np.flatnonzero((held != keys) & (held >= 0))
        while len(more):
            place[more] = (place[more] + 1) & self._mask
            held, wanted = self._keys[place[more]], keys[more]
            out[more[held == wanted]] = self._values[place[more[held == wanted]]]
            more = more[(held != wanted) & (held >= 0)]
        return out


class Vocabulary:
    """Ranks of byte strings; a rank is also the token's id."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.longest = max(map(len, self.ranks))
        self._pairs: dict[tuple[int, int], bool] = {}
        # The lengths of the tokens that end in given last two bytes, longest first.
        ends: dict[bytes, set[int]] = {}
        for token in self.ranks:
            ends.setdefault(token[-2:], set()).add(len(token))
            ends.setdefault(token[-1:], set()).add(1)
        self._lengths = {end: sorted(lengths | ({1} if len(end) == 2 else set()), reverse=True) for end, lengths in ends.items()}

    def merged(self, piece: bytes) -> list[int]:
        """Plain merging, lowest rank first and leftmost among equals; the meaning of BPE."""
        ranks, parts = self.ranks, [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            best, at = None, 0
            for i in range(len(parts) - 1):
                rank = ranks.get(parts[i] + parts[i + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [ranks[part] for part in parts]

    def compatible(self, left: int, right: int) -> bool:
        """Whether the two tokens side by side are their own encoding."""
        known = self._pairs.get((left, right))
        if known is None:
            if len(self._pairs) >= _CACHED:
                self._pairs.clear()
            known = self.merged(self.tokens[left] + self.tokens[right]) == [left, right]
            self._pairs[left, right] = known
        return known

    def last_token(self, piece: bytes, end: int, last: list[int], starts: list[int]) -> tuple[int, int]:
        """The only valid last token of ``piece[:end]``, and where it starts."""
        for length in self._lengths.get(piece[end - 2 : end] if end > 1 else piece[:1], (1,)):
            if length > end:
                continue
            token = self.ranks.get(piece[end - length : end])
            if token is not None and (length == end or self.compatible(last[end - length], token)):
                return token, end - length
        raise ValueError("the vocabulary lacks a byte of the text")


class Tables:
    """Fills the last tokens of many pieces together, as ``Prefixes`` does for one."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, ranks = vocabulary, vocabulary.ranks
        width = self._width = max(vocabulary.tokens) + 1
        # The tokens read backwards: from a node and the byte before to the next node.
        nodes = {byte: byte + 1 for byte in range(256)}
        ends, pairs, joined = {}, [], []
        for token, rank in ranks.items():
            node = 0
            for byte in reversed(token):
                node = nodes.setdefault(node << 8 | byte, len(nodes) + 1)
            ends[node] = rank
            for cut in range(1, len(token)):
                left = ranks.get(token[:cut])
                right = None if left is None else ranks.get(token[cut:])
                if right is not None:
                    pairs.append(left * width + right)
                    joined.append(rank)
        self._before = Lookup(np.fromiter(nodes.keys(), np.int64, len(nodes)), np.fromiter(nodes.values(), np.int32, len(nodes)))
        self._near = self._before(np.arange(257 << 8))  # the first two steps by position
        self._token = np.full(len(nodes) + 1, -1, dtype=np.int32)
        self._token[np.fromiter(ends.keys(), np.int64, len(ends))] = np.fromiter(ends.values(), np.int32, len(ends))
        keys, values = np.array(pairs, dtype=np.int64), np.array(joined, dtype=np.int64)
        self._joined = Lookup(keys, values)
        self._halve(keys // width, keys % width, values)

    def _halve(self, left: np.ndarray, right: np.ndarray, joined: np.ndarray) -> None:
        """Find the two tokens that merging puts together last, for every token.

        A token is in order if both halves are and have lower ranks; then merging makes its
        parts by rising rank. Shorter tokens come first, as longer ones are judged by them.
        """
        self._halves = np.full((2, self._width), -1, dtype=np.int64)
        self._in_order = np.zeros(self._width, dtype=bool)
        sizes = np.zeros(self._width, dtype=np.int64)
        for rank, token in self.vocabulary.tokens.items():
            sizes[rank] = len(token)
        self._in_order[sizes == 1] = True
        for size in np.unique(sizes[joined]):
            at = np.flatnonzero((sizes[joined] == size) & (left < joined) & (right < joined))
            at = at[self._in_order[left[at]] & self._in_order[right[at]]]
            at = at[self._apart(left[at], right[at], joined[at])]
            self._halves[:, joined[at]] = left[at], right[at]
            self._in_order[joined[at]] = True

    def _apart(self, left: np.ndarray, right: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """Whether merging joins nothing across the border of two tokens in order, below the rank ``limit``.

        Merges are taken back at the border, the latest first. Two tokens that met there
        would have been joined had their rank come before that of the merge taken back.
        """
        apart, at = np.ones(len(left), dtype=bool), np.arange(len(left))
        while len(at):
            rank = self._joined(left * self._width + right)
            clash = (rank >= 0) & (rank < limit)
            apart[at[clash]] = False
            last, first = self._halves[1, left], self._halves[0, right]
            from_left = (last >= 0) & ((left > right) | (first < 0))
            limit = np.where(from_left, left, right + 1)  # of equal ranks the left one merges first
            left, right = np.where(from_left, last, left), np.where(from_left, right, first)
            on = ~clash & (left >= 0) & (right >= 0)
            left, right, limit, at = left[on], right[on], limit[on], at[on]
        return apart

    def compatible(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Which pairs of tokens side by side are their own encoding."""
        left, right = left.astype(np.int64), right.astype(np.int64)
        out, known = np.zeros(len(left), dtype=bool), self._in_order[left] & self._in_order[right]
        out[known] = self._apart(left[known], right[known], np.full(known.sum(), self._width))
        for k in np.flatnonzero(~known):
            out[k] = self.vocabulary.compatible(int(left[k]), int(right[k]))
        return out

    def encode(self, pieces: list[bytes]) -> list[bytes]:
        """The packed ids of each piece; none is empty."""
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        order = np.argsort(-sizes, kind="stable")
        flat, offsets = np.frombuffer(b"".join(pieces), dtype=np.uint8), np.cumsum(sizes) - sizes
        out: list[bytes] = [b""] * len(pieces)
        begin = 0
        while begin < len(order):
            rows = order[begin : begin + max(1, _CELLS // int(sizes[order[begin]] + 1))]
            begin += len(rows)
            for row, ids in zip(rows.tolist(), self._encode(flat, offsets[rows], sizes[rows])):
                out[row] = ids
        return out

    def _encode(self, flat: np.ndarray, offsets: np.ndarray, sizes: np.ndarray) -> list[bytes]:
        """The pieces at ``offsets``, the longest first."""
        last = np.full((sizes[0] + 1, len(sizes)), -1, dtype=np.int32)
        starts = np.zeros(last.shape, dtype=np.int32)
        for end in range(1, len(last)):
            rows = np.arange(np.searchsorted(-sizes, -end, side="right"))
            found, all_rows, node = [], rows, np.zeros(len(rows), dtype=np.int64)
            for begin in range(end - 1, -1, -1):
                node = node << 8 | flat[offsets[rows] + begin]
                node = (self._near[node] if end - begin < 3 else self._before(node)).astype(np.int64)
                rows, node = rows[node >= 0], node[node >= 0]
                if not len(rows):
                    break
                token = self._token[node]
                found.append((begin, rows[token >= 0], token[token >= 0]))
            for begin, rows, token in reversed(found):  # longest first
                still = last[end, rows] < 0
                if begin:
                    still[still] = self.compatible(last[begin, rows[still]], token[still])
                last[end, rows[still]], starts[end, rows[still]] = token[still], begin
            if (last[end, all_rows] < 0).any():
                raise ValueError("the vocabulary lacks a byte of the text")
        steps, rows, end, counts = [], np.arange(len(sizes)), sizes, np.zeros(len(sizes), dtype=np.int64)
        while len(rows):
            steps.append((rows, last[end, rows]))
            counts[rows] += 1
            end = starts[end, rows]
            rows, end = rows[end > 0], end[end > 0]
        ends = np.cumsum(counts)
        ids = np.zeros(ends[-1], dtype="<u4")
        for step, (rows, token) in enumerate(steps, 1):
            ids[ends[rows] - step] = token
        packed = ids.tobytes()
        return [packed[a:b] for a, b in zip((4 * (ends - counts)).tolist(), (4 * ends).tolist())]


class Prefixes:
    """The last token of every prefix of one piece of text."""

    def __init__(self, vocabulary: Vocabulary, piece: bytes = b""):
        self.vocabulary, self.piece = vocabulary, b""
        self.last, self.starts = [-1], [0]
        self.append(piece)

    def append(self, more: bytes) -> None:
        """Extend the table; nothing that it holds changes."""
        begin, self.piece = len(self.piece), self.piece + more
        for end in range(begin + 1, len(self.piece) + 1):
            token, start = self.vocabulary.last_token(self.piece, end, self.last, self.starts)
            self.last.append(token)
            self.starts.append(start)

    def replace(self, begin: int, end: int, by: bytes) -> int:
        """Put ``by`` in the place of ``piece[begin:end]``; returns how many entries were filled anew.

        An entry depends on the bytes of the longest token before it and on the entries there,
        so once that many entries in a row equal the old ones, all later ones do.
        """
        old_last, old_starts, shift = self.last, self.starts, len(by) - (end - begin)
        self.piece = self.piece[:begin] + by + self.piece[end:]
        self.last, self.starts = old_last[: begin + 1], old_starts[: begin + 1]
        same = filled = 0
        for at in range(begin + 1, len(self.piece) + 1):
            token, start = self.vocabulary.last_token(self.piece, at, self.last, self.starts)
            self.last.append(token)
            self.starts.append(start)
            filled += 1
            before = at - shift
            same = same + 1 if before > end and old_last[before] == token and start >= begin + len(by) else 0
            if same >= self.vocabulary.longest:
                self.last += old_last[before + 1 :]
                self.starts += [s + shift for s in old_starts[before + 1 :]]
                break
        return filled

    def ids(self) -> list[int]:
        out, end = [], len(self.piece)
        while end:
            out.append(self.last[end])
            end = self.starts[end]
        return out[::-1]


class Codec:
    """Texts to ids and back; pieces are the matches of ``pattern``."""

    def __init__(self, path: str, pattern: str):
        self.vocabulary, self.pattern = Vocabulary(path), regex.compile(pattern)
        self._tables = Tables(self.vocabulary)
        self._seen: dict[str, bytes] = {}
        width = max(self.vocabulary.tokens) + 1
        lengths = np.zeros(width, dtype=np.int64)
        for rank, token in self.vocabulary.tokens.items():
            lengths[rank] = len(token)
        self._lengths, self._offsets = lengths, np.concatenate([[0], np.cumsum(lengths)])
        self._flat = np.frombuffer(b"".join(self.vocabulary.tokens.get(r, b"") for r in range(width)), dtype=np.uint8)

    def _learn(self, pieces: set[str]) -> list[str]:
        """Put the packed ids of ``pieces`` where they are seen; returns the long ones, not to be kept there."""
        data = {p: p.encode() for p in pieces}
        long = [p for p, d in data.items() if len(d) > _LONG]
        for p in long:
            d = data.pop(p)
            rank = self.vocabulary.ranks.get(d)
            ids = [rank] if rank is not None else Prefixes(self.vocabulary, d).ids()
            self._seen[p] = np.array(ids, dtype="<u4").tobytes()
        self._seen.update(zip(data, self._tables.encode(list(data.values()))))
        return long

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        split, seen = [self.pattern.findall(text) for text in texts], self._seen
        long = self._learn(set().union(*split).difference(seen))
        out = [b"".join([seen[p] for p in pieces]) for pieces in split]
        for piece in long:
            del seen[piece]
        if len(seen) >= _CACHED:
            seen.clear()
        return out

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def decode(self, packed: bytes) -> bytes:
        out = []
        for start in range(0, len(packed), 1 << 20):
            ids = np.frombuffer(packed[start : start + (1 << 20)], dtype="<u4")
            lengths = self._lengths[ids]
            ends = np.cumsum(lengths)
            if len(ids):
                index = np.arange(ends[-1]) + np.repeat(self._offsets[ids] - (ends - lengths), lengths)
                out.append(self._flat[index].tobytes())
        return b"".join(out)


_CODECS: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = Codec(path, pattern)
    return _CODECS[path, pattern]


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """All rows in their order, about ``_SLICE`` bytes of text at a time."""
    sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    number = np.cumsum(sizes) // _SLICE
    cuts = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), len(sizes)]
    for begin, end in zip(cuts, cuts[1:]):
        if begin < end:
            yield batch.slice(begin, end - begin)


def encode_documents(
    docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True
) -> DataFrame:
    """Encode and decode every whole text: (doc_id, n_tokens, ids_sha256, decoded_sha256, ids).

    ``path`` names a vocabulary file that every executor can open. Null and empty texts have
    no ids. Rows are treated one by one, so null ids and repeated rows stay as they are.
    Without ``with_ids`` the ids themselves stay behind.
    """
    fields = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            for part in _slices(batch):
                rows = []
                for packed in own.encode_all([text or "" for text in part.column(1).to_pylist()]):
                    rows.append((packed, hashlib.sha256(packed).hexdigest(), hashlib.sha256(own.decode(packed)).hexdigest()))
                columns = [
                    part.column(0).cast(pa.int64()),
                    pa.array([len(r[0]) // 4 for r in rows], pa.int64()),
                    pa.array([r[1] for r in rows], pa.string()),
                    pa.array([r[2] for r in rows], pa.string()),
                ]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    columns.append(pa.array([np.frombuffer(r[0], dtype="<i4") for r in rows], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    return narrow(docs, doc_id=id_col, text=text_col).mapInArrow(run, fields + (", ids array<int>" if with_ids else ""))
