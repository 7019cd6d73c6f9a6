"""Operator 1: byte-level BPE encoding and decoding.

Pre-tokenisation runs on code-point classes, without regular expressions. Each
code point gets a symbol that says how it can continue or start a token; every
symbol is a function from token state to token state. The states before all
code points are one inclusive scan over those functions under composition,
which is associative, so the scan works by doubling and stops as soon as every
partial composition is constant (a few steps, whatever the text's length).

The slices between boundaries are looked up in a bounded cache by their bytes;
slices not met before go through pair merging, all slices of one length
together as a matrix. Token ids keep their byte offsets (a prefix sum over the
tokens' lengths), so decoding is one gather.

Defined cases: null text is empty text (no tokens); every text round-trips;
texts of any length are encoded whole; repeated rows give repeated rows;
further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from truetally.llm.common import arrow_column, doc_chunks, giving_back, on_workers, small_batches, string_buffers
from truetally.llm.kernels import ranges

# --- symbols and states -------------------------------------------------------

# The code points of the Unicode property White_Space.
WHITE_SPACE = [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029,
               0x202F, 0x205F, 0x3000]
# The endings split off after an apostrophe.
SHORT_ENDINGS, LONG_ENDINGS = ("s", "t", "m", "d"), ("re", "ve", "ll")

# symbols: letter, number, other, apostrophe before a one- or two-letter ending,
# space / other white space that precedes a non-space, white space that doesn't
LETTER, NUMBER, OTHER, APOS1, APOS2, SPACE_LAST, WHITE_LAST, WHITE = range(8)
# states: what the code point before belongs to; E1, E2: letters of an ending still to come, DONE: ending complete
S_LETTER, S_NUMBER, S_OTHER, S_SPACE, S_WHITE, S_E1, S_E2, S_DONE, S_START = range(9)
N_STATES = 9


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """(next state, whether a token starts at this code point)."""
    if symbol == LETTER:
        if state == S_E2:
            return S_E1, False
        if state == S_E1:
            return S_DONE, False
        return S_LETTER, state not in (S_LETTER, S_SPACE)
    if symbol == NUMBER:
        return S_NUMBER, state not in (S_NUMBER, S_SPACE)
    if symbol in (APOS1, APOS2) and state not in (S_OTHER, S_SPACE):
        return (S_E1 if symbol == APOS1 else S_E2), True
    if symbol in (OTHER, APOS1, APOS2):
        return S_OTHER, state not in (S_OTHER, S_SPACE)
    if symbol == SPACE_LAST:
        return S_SPACE, True
    if symbol == WHITE_LAST:
        return S_WHITE, True
    return S_WHITE, state != S_WHITE


def _monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(function number -> images of the states, composition table, whether constant); the first 8 are the symbols'."""
    functions = [tuple(_step(s, c)[0] for s in range(N_STATES)) for c in range(8)]
    number = {}
    unique: list[tuple] = []
    for f in functions:
        number.setdefault(f, len(unique)) == len(unique) and unique.append(f)
    i = 0
    while i < len(unique):
        for g in unique[:len({*functions})]:
            h = tuple(g[s] for s in unique[i])
            if h not in number:
                number[h] = len(unique)
                unique.append(h)
        i += 1
    table = np.array([[number[tuple(g[s] for s in f)] for g in unique] for f in unique], np.uint8)
    symbols = np.array([number[f] for f in functions], np.uint8)
    return np.array(unique, np.uint8), table, symbols


IMAGES, COMPOSE, SYMBOL_FUNCTION = _monoid()
CONSTANT = np.array([len(set(map(int, f))) == 1 for f in IMAGES])
STARTS = np.array([[_step(s, c)[1] for c in range(8)] for s in range(N_STATES)])

_classes: np.ndarray | None = None


def class_ranges() -> list[tuple[int, int, int]]:
    """(first, last, class) of all letters (0) and numbers (1), by the Unicode tables of the engine that the contract
    names; taken once on the driver, so all workers use the same version."""
    import tiktoken
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    out = []
    for number, kind in ((0, r"\p{L}"), (1, r"\p{N}")):
        engine = tiktoken.Encoding(f"class {number}", pat_str=kind, mergeable_ranks={bytes([b]): b for b in range(256)},
                                   special_tokens={})
        found = np.array(list(map(ord, bytes(engine.encode_ordinary(every)).decode())), np.int64)  # what doesn't match is left out
        cuts = np.flatnonzero(np.diff(found) != 1)
        out += zip(found[np.r_[0, cuts + 1]].tolist(), found[np.r_[cuts, len(found) - 1]].tolist(), [number] * (len(cuts) + 1),
                   strict=True)
    return out


def use_classes(ranges_: list[tuple[int, int, int]]) -> None:
    """Set this process's table of code point classes."""
    global _classes
    t = np.full(0x110000, 2, np.uint8)
    for a, b, number in ranges_:
        t[a:b + 1] = number
    t[WHITE_SPACE] = 3
    _classes = t


def _code_point_classes() -> np.ndarray:
    """Class of each code point: 0 letter, 1 number, 2 other, 3 white space."""
    if _classes is None:
        use_classes(class_ranges())
    return _classes


def code_points(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code points, byte position of each) of valid UTF-8."""
    lead = np.flatnonzero((buf & 0xC0) != 0x80)
    if len(lead) == len(buf):
        return buf.astype(np.int32), lead
    first = buf[lead].astype(np.int32)
    padded = np.concatenate([buf, np.zeros(3, np.uint8)])
    cp = first.copy()
    many = np.flatnonzero(first >= 0x80)
    at, f = lead[many], first[many]
    t1, t2, t3 = (padded[at + i].astype(np.int32) & 0x3F for i in (1, 2, 3))
    cp[many] = np.where(f < 0xE0, (f & 0x1F) << 6 | t1,
                        np.where(f < 0xF0, (f & 0x0F) << 12 | t1 << 6 | t2,
                                 (f & 0x07) << 18 | t1 << 12 | t2 << 6 | t3))
    return cp, lead


def token_slices(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Byte positions at which the pre-tokens of some documents start (each document starts one)."""
    if not len(buf):
        return np.zeros(0, np.int64)
    cp, lead = code_points(buf)
    n = len(cp)
    cls = _code_point_classes()[cp]
    first = np.zeros(n + 1, bool)
    first[np.searchsorted(lead, off)] = True  # document starts, and one past the end
    white = cls == 3
    next_white = np.ones(n, bool)  # the end of a document counts as white space here
    next_white[:-1] = white[1:]
    next_white[first[1:]] = True
    sym = cls.copy()
    sym[white] = np.where(next_white[white], WHITE, np.where(cp[white] == 0x20, SPACE_LAST, WHITE_LAST))
    apos = np.flatnonzero(cp == 0x27)
    if len(apos):
        wide = np.concatenate([cp, [-1, -1]])
        one, two = wide[apos + 1], wide[apos + 2]
        in1 = ~first[np.minimum(apos + 1, n)]
        in2 = in1 & ~first[np.minimum(apos + 2, n)]
        long_ = np.zeros(len(apos), bool)
        for a, b in LONG_ENDINGS:
            long_ |= (one == ord(a)) & (two == ord(b))
        sym[apos[in2 & long_]] = APOS2
        sym[apos[in1 & np.isin(one, [ord(x) for x in SHORT_ENDINGS])]] = APOS1
    # inclusive scan: after step d, scan[i] composes the functions of the last 2**d code points up to i
    scan = SYMBOL_FUNCTION[sym]
    # a document's first code point starts from S_START whatever came before: a constant function
    heads = np.flatnonzero(first[:n])
    constant_of = np.full(N_STATES, 255, np.uint8)
    for f in np.flatnonzero(CONSTANT):
        constant_of[IMAGES[f][0]] = f
    head_state = IMAGES[scan[heads], S_START]
    reset = np.zeros(n, bool)
    reset[heads] = True
    # states without a constant function in the monoid (an ending's start) are handled by value below
    known = constant_of[head_state] != 255
    scan[heads[known]] = constant_of[head_state[known]]
    odd = heads[~known]
    span = 1
    while span < n:
        todo = np.flatnonzero(~CONSTANT[scan[span:]]) + span
        todo = todo[~reset[todo]] if len(odd) else todo
        if not len(todo):
            break
        scan[todo] = COMPOSE[scan[todo - span], scan[todo]]
        span *= 2
    state = IMAGES[scan, S_START]
    for h in odd:  # texts that begin with an apostrophe ending: step through until the state is free of it
        s, i = S_START, h
        while i < n and (i == h or not first[i]):
            s = _step(s, int(sym[i]))[0]
            state[i] = s
            i += 1
            if s not in (S_E1, S_E2, S_DONE):
                break
    before = np.empty(n, np.uint8)
    before[1:] = state[:-1]
    before[first[:n]] = S_START
    return lead[STARTS[before, sym]]


# --- ranks --------------------------------------------------------------------


class Ranks:
    """A vocabulary of byte strings with ranks; ids are ranks."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            pairs = [x.split() for x in f if x.strip()]
        self.rank = {base64.b64decode(a): int(b) for a, b in pairs}
        size = max(self.rank.values()) + 1
        by_id = [b""] * size
        for token, i in self.rank.items():
            by_id[i] = token
        self.length = np.array([len(x) for x in by_id], np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.length)])
        self.bytes = np.frombuffer(b"".join(by_id), np.uint8)
        self.of_byte = np.array([self.rank.get(bytes([b]), -1) for b in range(256)], np.int64)
        if (self.of_byte < 0).any():
            raise ValueError("the vocabulary lacks single bytes")
        keys, ids = [], []
        for token, i in self.rank.items():
            for cut in range(1, len(token)):
                left, right = self.rank.get(token[:cut]), self.rank.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    ids.append(i)
        order = np.argsort(np.array(keys, np.int64))
        self.pair_key = np.array(keys, np.int64)[order]
        self.pair_id = np.array(ids, np.int64)[order]
        self.pairs = dict(zip(keys, ids, strict=True))

    NONE = 1 << 40

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Id of each merged pair, or NONE."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
        return np.where(self.pair_key[at] == key, self.pair_id[at], self.NONE)

    def merge_matrix(self, parts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pair merging of many equally long slices: yields (row numbers, ids) as rows come to rest."""
        rows = np.arange(len(parts))
        ids = parts
        rank = self.merged(ids[:, :-1], ids[:, 1:])
        while len(rows):
            if ids.shape[1] == 1:
                yield rows, ids
                return
            at = rank.argmin(axis=1)
            best = rank[np.arange(len(rows)), at]
            rest = best == self.NONE
            if rest.any():
                yield rows[rest], ids[rest]
                go = ~rest
                rows, ids, rank, at, best = rows[go], ids[go], rank[go], at[go], best[go]
                if not len(rows):
                    return
            n, width = ids.shape
            r = np.arange(n)
            ids[r, at] = best
            keep = np.ones((n, width), bool)
            keep[r, at + 1] = False
            ids = ids[keep].reshape(n, width - 1)
            if width == 2:
                yield rows, ids
                return
            # the pair that was merged goes; its neighbours get new ranks
            keep = np.ones((n, width - 1), bool)
            keep[r, at] = False
            rank = rank[keep].reshape(n, width - 2)
            has = np.flatnonzero(at > 0)
            rank[has, at[has] - 1] = self.merged(ids[has, at[has] - 1], ids[has, at[has]])
            has = np.flatnonzero(at < width - 2)
            rank[has, at[has]] = self.merged(ids[has, at[has]], ids[has, at[has] + 1])

    def merge_long(self, part: bytes) -> list[int]:
        """Pair merging of one long slice with a heap, in n log n steps."""
        ids = [int(self.of_byte[b]) for b in part]
        n = len(ids)
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        alive = [True] * n
        heap = [(m, i, ids[i], ids[i + 1]) for i in range(n - 1)
                if (m := self.pairs.get(ids[i] << 32 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            m, i, left, right = heapq.heappop(heap)
            j = nxt[i]
            if not alive[i] or j >= n or ids[i] != left or ids[j] != right:
                continue
            ids[i] = m
            alive[j] = False
            nxt[i] = nxt[j]
            if nxt[j] < n:
                prv[nxt[j]] = i
            for a, b in ((prv[i], i), (i, nxt[i])):
                if a >= 0 and b < n and (x := self.pairs.get(ids[a] << 32 | ids[b])) is not None:
                    heapq.heappush(heap, (x, a, ids[a], ids[b]))
        return [x for x, ok in zip(ids, alive, strict=True) if ok]


class Encoder:
    """Encodes documents; keeps the ids of slices it has met by their bytes, up to ``cache_slices`` and ``cache_bytes``."""

    MATRIX_BYTES = 48

    def __init__(self, ranks: Ranks, cache_slices: int = 400_000, cache_bytes: int = 16 << 20):
        self.ranks, self.limit, self.limit_bytes = ranks, cache_slices, cache_bytes
        self._clear()

    def _clear(self) -> None:
        self.slot: dict[bytes, int] = {}
        self.held = 0
        self.at = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int32)

    def _merge_new(self, buf: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each slice, their ids one after the other)."""
        r = self.ranks
        rows_all, counts_all, ids_all = [], [], []
        for size in np.unique(length):
            who = np.flatnonzero(length == size)
            if size <= self.MATRIX_BYTES:
                block = max(1, (1 << 20) // int(size))
                for b in range(0, len(who), block):
                    part = who[b:b + block]
                    parts = r.of_byte[buf[start[part][:, None] + np.arange(size)]]
                    for rows, ids in r.merge_matrix(parts):
                        rows_all.append(part[rows])
                        counts_all.append(np.full(len(rows), ids.shape[1], np.int64))
                        ids_all.append(ids.astype(np.int32).ravel())
            else:
                for i in who:
                    ids = np.array(r.merge_long(buf[start[i]:start[i] + size].tobytes()), np.int32)
                    rows_all.append(np.array([i]))
                    counts_all.append(np.array([len(ids)]))
                    ids_all.append(ids)
        rows, counts, ids = (np.concatenate(x) for x in (rows_all, counts_all, ids_all))
        order = np.argsort(rows, kind="stable")
        begin = np.cumsum(counts) - counts
        return counts[order], ids[ranges(begin[order], counts[order])]

    def encode(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all documents one after the other, offsets of the documents in them)."""
        start = token_slices(buf, off)
        if not len(start):
            return np.zeros(0, np.int32), np.zeros(len(off), np.int64)
        end = np.append(start[1:], len(buf))
        # slices are told apart by their bytes: a dictionary of this run, then the cache
        coded = pa.Array.from_buffers(pa.large_binary(), len(start), [
            None, pa.py_buffer(np.append(start, len(buf)).astype(np.int64).tobytes()), pa.py_buffer(buf.tobytes())]).dictionary_encode()
        inverse = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        first = np.empty(len(coded.dictionary), np.int64)
        first[inverse[::-1]] = np.arange(len(start) - 1, -1, -1)
        names = coded.dictionary.to_pylist()
        size = int((end - start)[first].sum())
        if len(self.slot) + len(names) > self.limit or self.held + size > self.limit_bytes:
            self._clear()
        at = np.array([self.slot.get(x, -1) for x in names], np.int64)
        new = np.flatnonzero(at < 0)
        if len(new):
            counts, ids = self._merge_new(buf, start[first[new]], (end - start)[first[new]])
            begin = len(self.ids) + np.cumsum(counts) - counts
            at[new] = len(self.at) + np.arange(len(new))
            self.slot.update(zip([names[k] for k in new.tolist()], at[new].tolist(), strict=True))
            self.held += int((end - start)[first[new]].sum())
            self.ids = np.concatenate([self.ids, ids])
            self.at = np.concatenate([self.at, begin])
            self.count = np.concatenate([self.count, counts])
        n = self.count[at][inverse]
        out = self.ids[ranges(self.at[at][inverse], n)]
        total = np.concatenate([[0], np.cumsum(n)])
        return out, total[np.searchsorted(start, off)]

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of ids, by the offsets of the tokens in the vocabulary."""
        r = self.ranks
        return r.bytes[ranges(r.start[ids], r.length[ids])]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """This process's encoder for a rank file."""
    if path not in _encoders:
        _encoders[path] = Encoder(Ranks(path))
    return _encoders[path]


def encode_documents(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
                     with_ids: bool = False) -> DataFrame:
    """Encode and decode every text.

    ``vocabulary``: path of a rank file, present on every machine. Returns
    (id, n_tokens, ids_sha256, decoded_sha256); with ``with_ids`` also
    ``ids`` and ``offsets`` (the byte at which each token starts).
    """
    schema = f"{id_col} long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>, offsets array<int>" if with_ids else ""

    classes = class_ranges()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use_classes(classes)
        enc = encoder(vocabulary)
        for batch in batches:
            buf, off = string_buffers(arrow_column(batch, "_text"))
            n_tokens, ids_sha, dec_sha, ids_out, offs_out = [], [], [], [], []
            for i, j in doc_chunks(off):
                ids, doc_at = enc.encode(buf[off[i]:off[j]], off[i:j + 1] - off[i])
                raw = ids.astype("<u4")
                back = enc.decode(ids)
                byte_at = np.concatenate([[0], np.cumsum(enc.ranks.length[ids])])
                for d in range(j - i):
                    a, b = doc_at[d], doc_at[d + 1]
                    n_tokens.append(int(b - a))
                    ids_sha.append(hashlib.sha256(raw[a:b]).hexdigest())
                    dec_sha.append(hashlib.sha256(back[byte_at[a]:byte_at[b]]).hexdigest())
                    if with_ids:
                        ids_out.append(ids[a:b])
                        offs_out.append((byte_at[a:b] - byte_at[a]).astype(np.int32))
            cols = [arrow_column(batch, "_id"), pa.array(n_tokens, pa.int64()), pa.array(ids_sha, pa.string()),
                    pa.array(dec_sha, pa.string())]
            names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                cols += [pa.array(ids_out, pa.list_(pa.int32())), pa.array(offs_out, pa.list_(pa.int32()))]
                names += ["ids", "offsets"]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    small_batches(on_workers(docs.sparkSession))
    return (docs.select(docs[id_col].cast("long").alias("_id"), docs[text_col].alias("_text"))
            .mapInArrow(lambda b: giving_back(run(b)), schema))
