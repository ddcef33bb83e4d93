"""Exact removal of repeated passages with a logarithmic family of suffix arrays.

A byte goes if a ``LENGTH``-byte string that covers it also starts in a
document with a smaller doc_id. Equal strings hold equal k-grams, so both
pick the same smallest k-gram hash: it is the string's key. Runs of
neighbouring strings with one key are shipped as pieces of text to the bucket
of the key, and only strings of one key can be equal. Pieces are short, so
they are handled as rows of words in arrays, not one by one.

1. Each task sends the distinct keys of its texts, 4 bytes each, to buckets
   whose number follows the size of the corpus; keys of one text only are
   dropped. What is left is a filter of bounded size (false positives only
   cost work).
2. The pieces of the other keys go to their buckets. Equal pieces are decided
   at once; where a key has different pieces, batches of them, in order of
   doc_id, get a suffix array of their strings, which is matched against the
   levels of the index and then merged into it, equal-sized levels
   geometrically.
3. The removed stretches return to their documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import give_back, lean, mix64, text_of, utf8_buffer

LENGTH = 50
GRAM = 26  # bytes of a key's k-gram
PIECE_STRINGS = LENGTH - GRAM + 1  # strings of a piece, at most
PIECE_WORDS = 10  # its 8-byte words: LENGTH + PIECE_STRINGS - 1 = 74 bytes and zeros
SLICE_BYTES = 1 << 16  # text handled at a time, so that its arrays stay in the processor's cache
BUCKET_BYTES = 4 << 20  # of text for each bucket
DOC_BUCKET_BYTES = 8 << 20
FILTER_BYTES = 64 << 20  # all buckets' filters together, at most
SEGMENT_BYTES = 32 << 10  # one bucket's filter, at most
HELD_KEYS = 2_000_000  # keys that a task holds before it sends them
HELD_PIECES = 300_000  # pieces that a task holds before it sends them
BATCH_STRINGS = 1 << 15  # strings in a batch of the index
NO_ID = (1 << 63) - 1  # a null doc_id: after all others

_ODD = [np.uint64(c | 1) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                                   0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3,
                                   0x1D8E4E27C47D124F, 0xEB44ACCAB455D165)]
#: By number of strings: which bits of a piece's words are its own.
_OWN = np.where(np.arange(PIECE_WORDS * 8) < np.arange(PIECE_STRINGS + 1)[:, None] + LENGTH - 1, 255, 0).astype(np.uint8).view(np.uint64)


class Room:
    """Arrays for one slice of text, used again for the next, because fresh
    large arrays cost page faults."""

    def __init__(self, size: int = 0):
        self.grow(size or SLICE_BYTES + LENGTH)

    def grow(self, size: int) -> None:
        self.size = size
        self.text = np.zeros(size + PIECE_WORDS * 8, np.uint8)
        self.every = np.ndarray((size + PIECE_WORDS * 8 - 7,), np.uint64, buffer=self.text, strides=(1,))
        self.words, self.a, self.b = np.empty((3, len(self.every)), np.uint64)


def keys_of(buf: np.ndarray, room: Room | None = None) -> np.ndarray:
    """The key of the LENGTH-byte string at each position of ``buf``. It lies in
    ``room`` and holds until the next call; ``room.words`` then has the 8
    bytes from each position on, zeros after the end."""
    if len(buf) < LENGTH:
        return np.zeros(0, np.uint64)
    room = room or Room(len(buf))
    if len(buf) > room.size:
        room.grow(len(buf))
    end = len(buf) + PIECE_WORDS * 8
    room.text[:len(buf)] = buf
    room.text[len(buf):end] = 0
    w = room.words
    w[:end - 7] = room.every[:end - 7]
    n = len(buf) - GRAM + 1
    a, b = room.a[:n], room.b[:n]
    with np.errstate(over="ignore"):
        np.multiply(w[:n], _ODD[0], out=a)
        for c, at in zip(_ODD[1:], (6, 12, GRAM - 8)):
            np.multiply(w[at:at + n], c, out=b)
            np.add(a, b, out=a)
        np.right_shift(a, np.uint64(32), out=b)
        np.bitwise_xor(a, b, out=a)
        np.multiply(a, _ODD[4], out=a)
        np.right_shift(a, np.uint64(29), out=b)
        np.bitwise_xor(a, b, out=a)
    for step in (1, 2, 4, 8):
        n -= step
        np.minimum(a[:n], a[step:n + step], out=b[:n])
        a, b = b, a
    m = len(buf) - LENGTH + 1
    return np.minimum(a[:m], a[9:9 + m], out=b[:m])  # 16 + 9 = 25 = LENGTH - GRAM + 1


def segments(batch: pa.RecordBatch, text: int, limit: int = 0) -> Iterator[tuple]:
    """(buffer, starts, rows, bases): stretches of about ``limit`` bytes of
    neighbouring texts; a longer text is cut into overlapping ones. ``starts``
    are where texts begin in the buffer, with its end last."""
    limit = limit or SLICE_BYTES
    buf, off = utf8_buffer(batch.column(text))
    i = 0
    while i < batch.num_rows:
        n = off[i + 1] - off[i]
        if n > limit:
            for a in range(0, n - LENGTH + 1, limit):
                part = buf[off[i] + a:off[i] + min(n, a + limit + LENGTH - 1)]
                yield part, np.array([0, len(part)]), np.array([i]), np.array([a])
            i += 1
            continue
        j = min(batch.num_rows, max(i + 1, int(np.searchsorted(off, off[i] + limit, side="right")) - 1))
        yield buf[off[i]:off[j]], off[i:j + 1] - off[i], np.arange(i, j), np.zeros(j - i, np.int64)
        i = j


def runs_of(buf: np.ndarray, starts: np.ndarray, room: Room) -> tuple:
    """Runs of neighbouring strings of one text that have one key, cut where
    they are longer than a piece: (key, first position, number of strings,
    index of the text)."""
    keys = keys_of(buf, room)
    if not len(keys):
        return keys, *[np.zeros(0, np.int64)] * 3
    new = np.empty(len(keys), bool)
    new[0] = True
    np.not_equal(keys[1:], keys[:-1], out=new[1:])
    inner = starts[1:-1]
    inner = inner[inner > 0]
    new[inner[inner < len(keys)]] = True
    new[np.maximum(inner - LENGTH + 1, 0)[inner - LENGTH + 1 < len(keys)]] = True
    at = np.flatnonzero(new)
    n = np.diff(at, append=len(keys))
    t = np.searchsorted(starts, at, side="right") - 1
    live = at <= starts[t + 1] - LENGTH  # strings across a boundary are none
    at, n, t = at[live], n[live], t[live]
    if n.max(initial=0) > PIECE_STRINGS:
        parts = -(-n // PIECE_STRINGS)
        skip = PIECE_STRINGS * (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts))
        at, n, t = np.repeat(at, parts) + skip, np.minimum(PIECE_STRINGS, np.repeat(n, parts) - skip), np.repeat(t, parts)
    return keys[at], at, n, t


def _send_keys(bits: int):
    """Per stretch of a partition and bucket: its distinct keys (32 bits beside
    the bucket's), those of one document and those of several apart. A key of
    one long text may come from two stretches; that only makes it look shared."""
    def pack(held: list) -> pa.RecordBatch:
        k = mix64(np.concatenate([h[0] for h in held]))
        r = np.concatenate([h[1] for h in held])
        held.clear()
        k >>= np.uint64(32 - bits)  # the bucket, then 32 bits
        order = np.argsort(k)
        k, r = k[order], r[order]
        first = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
        several = np.minimum.reduceat(r, first) != np.maximum.reduceat(r, first)
        k = k[first]
        bucket, low = (k >> np.uint64(32)).astype(np.int64), (k & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        edges = np.searchsorted(bucket, np.arange((1 << bits) + 1))
        ids, one, many = [], [], []
        for i in np.flatnonzero(np.diff(edges)):
            s = slice(edges[i], edges[i + 1])
            ids.append(i)
            one.append(low[s][~several[s]].tobytes())
            many.append(low[s][several[s]].tobytes())
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(one, pa.binary()), pa.array(many, pa.binary())],
                                          names=["bucket", "one", "many"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, row0, room = [], 0, 0, Room()
        for b in batches:
            for buf, starts, rows, _ in segments(b, 0):
                k, _, _, t = runs_of(buf, starts, room)
                if len(k):
                    held.append((k, rows[t] + row0))
                    size += len(k)
                if size > HELD_KEYS:
                    yield pack(held)
                    size = 0
            row0 += b.num_rows
        if held:
            yield pack(held)
    return lean(run)


def _probe(low: np.ndarray, segment: int) -> tuple[np.ndarray, np.ndarray]:
    """Two bit positions of a key in a filter of ``segment`` bytes."""
    m = np.uint64(segment * 8 - 1)
    h = mix64(low.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    return h & m, (h >> np.uint64(32)) & m


def _shared_filter(segment: int):
    """The filter of a bucket over the keys of more than one text."""
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        one = np.concatenate([np.frombuffer(x, np.uint32) for x in pdf["one"]])
        many = np.concatenate([np.frombuffer(x, np.uint32) for x in pdf["many"]])
        u, c = np.unique(one, return_counts=True)
        shared = np.union1d(u[c > 1], many)
        bits = np.zeros(segment * 8, bool)
        for p in _probe(shared, segment):
            bits[p] = True
        return pd.DataFrame({"bucket": [key[0]], "bits": [np.packbits(bits, bitorder="little").tobytes()]})
    return run


def _alike(words: np.ndarray, n: np.ndarray, key: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Pieces in order of ``key`` (of ``bits`` bits) with equal ones together:
    the order, and where in it a new piece begins. The bytes decide; should
    two pieces' hashes agree, some equal ones may stay apart, as different
    pieces of their key."""
    with np.errstate(over="ignore"):
        h = n.astype(np.uint64)
        for j in range(PIECE_WORDS):
            h += words[:, j] * _ODD[j]
        h = mix64(h)
    order = np.argsort((key << np.uint64(64 - bits)) | (h >> np.uint64(bits)))
    w, n, key = words[order], n[order], key[order]
    new = np.ones(len(order), bool)
    new[1:] = (w[1:] != w[:-1]).any(axis=1) | (n[1:] != n[:-1]) | (key[1:] != key[:-1])
    return order, np.flatnonzero(new)


def _spread(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first, first + 1, ... of each range, one range after another."""
    return np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())


#: A blob of pieces: for each one its smallest doc_id, key, strings and places, then the places, then the texts.
_PIECE, _PLACE = ((np.int64, np.uint32, np.uint8, np.uint32), (np.int64, np.uint32))


def _pack(piece: list, place: list, data: np.ndarray, z) -> bytes:
    cols = [np.array([len(piece[0]), len(place[0])], np.int64), *[x.astype(t) for x, t in zip(piece, _PIECE)],
            *[x.astype(t) for x, t in zip(place, _PLACE)], data]
    return z.compress(b"".join(c.tobytes() for c in cols))


def _unpack(blob: bytes, z) -> tuple:
    """(doc_id, key, strings, places), (row key, position), words of the pieces."""
    raw = z.decompress(blob)
    sizes, at, cols = np.frombuffer(raw, np.int64, 2).tolist(), 16, []
    for types, size in zip((_PIECE, _PLACE), sizes):
        for t in types:
            cols.append(np.frombuffer(raw, t, size, at))
            at += cols[-1].nbytes
    text = np.zeros((sizes[0], PIECE_WORDS * 8), np.uint8)
    text[_OWN.view(np.uint8)[cols[2]] > 0] = np.frombuffer(raw, np.uint8, offset=at)
    return *cols, text.view(np.uint64)


def _pack_gone(rows: np.ndarray) -> bytes:
    """(doc_id, row key, start, length) stretches, neighbours of one text
    joined, by columns and compressed."""
    import zstandard

    rows = rows[np.lexsort((rows[:, 2], rows[:, 0], rows[:, 1]))]
    end = rows[:, 2] + rows[:, 3]
    new = np.append(True, (rows[1:, :2] != rows[:-1, :2]).any(axis=1) | (rows[1:, 2] > end[:-1]))
    at = np.flatnonzero(new)
    start = rows[at, 2]
    cols = np.concatenate([rows[at, 0], rows[at, 1], start, np.maximum.reduceat(end, at) - start])
    return zstandard.ZstdCompressor(level=1).compress(cols.tobytes())


def _unpack_gone(blob: bytes) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.int64).reshape(4, -1).T


def _send_pieces(bits: int, segment: int, filters):
    """The pieces whose key the filter holds. Of equal pieces in a partition
    only the smallest doc_id's leaves it; the others are removed already."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        z = zstandard.ZstdCompressor(level=1)
        bitmap = np.frombuffer(filters.value, np.uint8)
        held: list[tuple] = []

        def flush() -> pa.RecordBatch:
            cols = [np.concatenate(x) for x in zip(*held)]
            held.clear()
            order, at = _alike(cols[0], cols[1], cols[2], 32 + bits)
            words, (n, top, doc, row, pos) = cols[0][order[at]], (x[order] for x in cols[1:])
            del cols
            size = np.diff(at, append=len(order))
            d0 = np.minimum.reduceat(doc, at)
            mine = doc == np.repeat(d0, size)
            gone = np.stack([doc[~mine], row[~mine], pos[~mine], n[~mine] + (LENGTH - 1)], axis=1)
            places = np.add.reduceat(mine, at, dtype=np.int64)
            piece = [d0, top[at] & np.uint64(0xFFFFFFFF), n[at], places]
            data = words.view(np.uint8)[_OWN.view(np.uint8)[n[at]] > 0]
            place = [row[mine], pos[mine]]
            bucket = (top[at] >> np.uint64(32)).astype(np.int64)
            first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
            to_place, to_byte = (np.append(0, np.cumsum(x)) for x in (places, n[at] + (LENGTH - 1)))
            ids, blobs = bucket[first].tolist(), []
            for a, e in zip(first.tolist(), [*first[1:].tolist(), len(at)]):
                p = slice(to_place[a], to_place[e])
                blobs.append(_pack([x[a:e] for x in piece], [x[p] for x in place], data[to_byte[a]:to_byte[e]], z))
            kinds = [1] * len(ids)
            if len(gone):
                ids.append(hash(tuple(gone[0].tolist())) % (1 << bits))
                kinds.append(0)
                blobs.append(_pack_gone(gone))
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(kinds, pa.int32()), pa.array(blobs, pa.binary())],
                                              names=["bucket", "kind", "blob"])

        rows_held, room = 0, Room()
        for b in batches:
            ids = b.column(1).to_numpy(zero_copy_only=False)
            row_key = b.column(2).to_numpy(zero_copy_only=False)
            for buf, starts, rows, bases in segments(b, 0):
                k, at, n, t = runs_of(buf, starts, room)
                if not len(k):
                    continue
                top = mix64(k) >> np.uint64(32 - bits)
                bucket, low = (top >> np.uint64(32)).astype(np.int64), (top & np.uint64(0xFFFFFFFF)).astype(np.uint32)
                ok = np.ones(len(k), bool)
                for p in _probe(low, segment):
                    p = p.astype(np.int64)
                    ok &= (bitmap[bucket * segment + (p >> 3)] >> (p & 7).astype(np.uint8)) & 1 > 0
                sel = np.flatnonzero(ok)
                if not len(sel):
                    continue
                at, n, t = at[sel], n[sel], t[sel]
                words = room.words[at[:, None] + np.arange(0, PIECE_WORDS * 8, 8)] & _OWN[n]
                held.append((words, n, top[sel], ids[rows[t]], row_key[rows[t]], at - starts[t] + bases[t]))
                rows_held += len(sel)
                if rows_held > HELD_PIECES:
                    yield flush()
                    rows_held = 0
        if held:
            yield flush()
    return lean(run)


class LevelIndex:
    """A logarithmic family of suffix arrays: sorted distinct strings, each with
    the smallest doc_id that holds it. A new batch enters as a level of its
    own; while the two last levels are of about one size they are merged."""

    def __init__(self):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []

    @staticmethod
    def suffix_array(strings: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted distinct strings, the smallest doc_id of each, and for every
        input string its place among them. ``docs`` ascend."""
        order = np.argsort(strings, kind="stable")
        s = strings[order]
        new = np.append(True, s[1:] != s[:-1])
        place = np.empty(len(s), np.int64)
        place[order] = np.cumsum(new) - 1
        return s[new], docs[order][new], place

    def add(self, strings: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """Put a batch in (``docs`` ascend, none below an earlier batch's) and
        return for each string whether a smaller doc_id holds it."""
        if not len(strings):
            return np.zeros(0, bool)
        s, first, place = self.suffix_array(strings, docs)
        for ls, ld in self.levels:  # merge-scan: both sides are sorted
            at = np.minimum(np.searchsorted(ls, s), len(ls) - 1)
            first = np.where(ls[at] == s, np.minimum(first, ld[at]), first)
        seen = first[place] < docs
        self.levels.append((s, first))
        while len(self.levels) > 1 and len(self.levels[-1][0]) * 2 > len(self.levels[-2][0]):
            (a, da), (b, db) = self.levels[-2:]
            m, d = np.concatenate([a, b]), np.concatenate([da, db])
            order = np.argsort(m, kind="stable")
            m, d = m[order], d[order]
            new = np.append(True, m[1:] != m[:-1])
            self.levels[-2:] = [(m[new], np.minimum.reduceat(d, np.flatnonzero(new)))]
        return seen


def _match(doc_buckets: int):
    """One bucket: decide which strings of its pieces a smaller doc_id holds."""
    def emit(parts: list[np.ndarray]) -> pd.DataFrame:
        rows = np.concatenate(parts) if parts else np.zeros((0, 4), np.int64)
        b = np.mod(rows[:, 1], doc_buckets)
        order = np.argsort(b, kind="stable")
        rows, b = rows[order], b[order]
        edges = np.flatnonzero(np.append(True, b[1:] != b[:-1])) if len(b) else np.zeros(0, np.int64)
        ends = np.append(edges[1:], len(b))
        return pd.DataFrame({"doc_bucket": b[edges].astype(np.int32) if len(b) else np.zeros(0, np.int32),
                             "blob": [_pack_gone(rows[a:e]) for a, e in zip(edges, ends)]})

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        import zstandard

        z, gone, parts = zstandard.ZstdDecompressor(), [], []
        for kind, blob in zip(pdf["kind"], pdf["blob"]):
            if kind == 0:
                gone.append(_unpack_gone(blob))
            else:
                parts.append(_unpack(blob, z))
        if parts:
            gone.extend(decide(*[np.concatenate(x) for x in zip(*parts)]))
        out = emit(gone)
        give_back()
        return out

    def decide(doc, k, n, places, row, pos, words) -> Iterator[np.ndarray]:
        n, pos = n.astype(np.int64), pos.astype(np.int64)
        # Equal pieces: all but the smallest doc_id's are removed whole.
        order, at = _alike(words, n, k.astype(np.uint64), 32)
        group = np.empty(len(order), np.int64)
        group[order] = np.repeat(np.arange(len(at)), np.diff(at, append=len(order)))
        d0 = np.minimum.reduceat(doc[order], at)
        piece = np.repeat(np.arange(len(doc)), places)  # of each place
        mine = (doc == d0[group])[piece]
        lost = piece[~mine]
        yield np.stack([doc[lost], row[~mine], pos[~mine], n[lost] + (LENGTH - 1)], axis=1)
        # The places of the others, by group.
        by = np.argsort(group[piece[mine]], kind="stable")
        row, pos = row[mine][by], pos[mine][by]
        count = np.bincount(group[piece[mine]], minlength=len(at))
        first = np.cumsum(count) - count
        # A key with one piece only has no other place where its strings are.
        n, k, words = n[order[at]], k[order[at]], words[order[at]]
        twice = np.append(k[1:] == k[:-1], False)
        twice[1:] |= twice[:-1].copy()
        kept = np.flatnonzero(twice)
        kept = kept[np.argsort(d0[kept], kind="stable")]
        strings = np.cumsum(n[kept])
        index, i = LevelIndex(), 0
        while i < len(kept):
            j = int(np.searchsorted(strings, (strings[i - 1] if i else 0) + BATCH_STRINGS)) + 1
            part, cnt = kept[i:j], n[kept[i:j]]
            which, local = np.repeat(part, cnt), _spread(np.zeros(len(part), np.int64), cnt)
            text = sliding_window_view(words[part].view(np.uint8).ravel(), LENGTH)
            wins = text[_spread(np.arange(len(part)) * (PIECE_WORDS * 8), cnt)].view(f"S{LENGTH}").ravel()
            seen = index.add(wins, d0[which])
            new = np.append(True, seen[1:] != seen[:-1])
            new[np.cumsum(cnt) - cnt] = True
            begin = np.flatnonzero(new)
            stop = np.append(begin[1:], len(seen))
            begin, stop = begin[seen[begin]], stop[seen[begin]]
            w = which[begin]
            to = _spread(first[w], count[w])
            own = np.repeat(np.arange(len(w)), count[w])
            yield np.stack([d0[w[own]], row[to], pos[to] + local[begin][own], (stop - begin)[own] + (LENGTH - 1)], axis=1)
            i = j
    return run


def _apply(key: tuple, docs: pa.Table, gone: pa.Table) -> pa.Table:
    """Cut the removed stretches out of the texts of one document bucket."""
    docs = docs.combine_chunks()
    n = docs.num_rows
    if not n:
        return _RESULT.empty_table()
    text = docs.column("text").combine_chunks().cast(pa.large_binary())
    buf, off = utf8_buffer(text)
    gone = np.concatenate([np.zeros((0, 4), np.int64), *[_unpack_gone(x) for x in gone.column("blob").to_pylist()]])
    rk, ids = docs.column("row_key").to_numpy(), pc.fill_null(docs.column("doc_id"), NO_ID).to_numpy()
    order = np.argsort(rk, kind="stable")
    lo, hi = np.searchsorted(rk[order], gone[:, 1], "left"), np.searchsorted(rk[order], gone[:, 1], "right")
    parts = [np.zeros((0, 3), np.int64)]
    for k in range(int((hi - lo).max(initial=0))):  # repeated rows share a key; mostly a single one
        live = np.flatnonzero(lo + k < hi)
        row = order[lo[live] + k]
        same = ids[row] == gone[live, 0]  # a key is a hash: the doc_id must agree too
        live, row = live[same], row[same]
        parts.append(np.stack([row, off[row] + gone[live, 2], off[row] + gone[live, 2] + gone[live, 3]], axis=1))
    cut = np.concatenate(parts)
    cut = cut[np.lexsort((cut[:, 1], cut[:, 0]))]  # by text, then start: rows lie one after another in buf
    if len(cut):
        reach = np.maximum.accumulate(cut[:, 2])
        new = np.append(True, (cut[1:, 0] != cut[:-1, 0]) | (cut[1:, 1] > reach[:-1]))
        at = np.flatnonzero(new)
        cut = np.stack([cut[at, 0], cut[at, 1], reach[np.append(at[1:], len(cut)) - 1]], axis=1)
    removed = np.zeros(n, np.int64)
    np.add.at(removed, cut[:, 0], cut[:, 2] - cut[:, 1])
    size = off[1:] - off[:-1]
    koff = np.concatenate([[0], np.cumsum(size - removed)]).astype(np.int64)
    data, edge, left = buf.data, 0, []  # what lies between the stretches
    for a, e in zip(cut[:, 1].tolist(), cut[:, 2].tolist()):
        left.append(data[edge:a])
        edge = e
    left.append(data[edge:])
    kept = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(koff.tobytes()), pa.py_buffer(b"".join(left))])
    out = pa.table([docs.column("doc_id"), pa.array(size), pa.array(removed), pa.array(np.bincount(cut[:, 0], minlength=n)),
                    kept.cast(pa.binary())], schema=_RESULT)
    give_back()
    return out


_RESULT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())])


def suffix_dedup(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes (UTF-8), n_removed, n_spans (maximal
    removed runs) and kept (binary: the remaining bytes; a cut may fall
    inside a character).

    Matches never cross texts, overlap freely and are judged on the input. A
    null or empty text has nothing to remove. Rows that share a doc_id are
    one document, so they do not remove each other; a null doc_id counts as
    larger than all others. Other columns are not read. Empty input gives no
    rows.
    """
    spark = docs.sparkSession
    d = docs.select(text_of().alias("text"), F.col("doc_id").cast("long").alias("doc_id"))
    total = d.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0  # one number
    bits = min(20, max(4, math.ceil(math.log2(max(1, total / BUCKET_BYTES)))))
    segment = min(SEGMENT_BYTES, FILTER_BYTES >> bits)
    doc_buckets = max(8, math.ceil(total / DOC_BUCKET_BYTES))
    n_parts = 1 << bits
    sent = d.select("text").mapInArrow(_send_keys(bits), "bucket int, one binary, many binary")
    filters = sent.groupBy("bucket").applyInPandas(_shared_filter(segment), "bucket int, bits binary")
    bitmap = bytearray(n_parts * segment)
    for bucket, part in filters.collect():  # at most FILTER_BYTES in all
        bitmap[bucket * segment:(bucket + 1) * segment] = part
    shared = spark.sparkContext.broadcast(bytes(bitmap))
    keyed = d.withColumn("row_key", F.xxhash64("doc_id", "text"))
    pieces = keyed.select("text", F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), "row_key").mapInArrow(
        _send_pieces(bits, segment, shared), "bucket int, kind int, blob binary")
    gone = pieces.groupBy("bucket").applyInPandas(_match(doc_buckets), "doc_bucket int, blob binary")
    texts = keyed.withColumn("doc_bucket", F.pmod("row_key", F.lit(doc_buckets)).cast("int"))
    return texts.groupBy("doc_bucket").cogroup(gone.groupBy("doc_bucket")).applyInArrow(
        _apply, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
