"""Offset-preserving SentencePiece (BPE) encoding and decoding.

*Normalisation.* The model's compiled character map is a double-array trie over UTF-8
bytes; at each place the longest matching prefix is replaced by its entry, anything else
passes one character at a time. Every normalised character keeps the byte offset of the
source text it came from, so each piece projects to a span of original bytes.

*Encoding.* No piece holds a word mark after another character (checked on loading), so
merges never cross a word mark and the normalised text falls into chunks that are encoded
on their own. A task encodes each distinct chunk of a batch once: short chunks of like
length are merged together as integer matrices (best-ranked adjacent pair, leftmost
first), long ones with a heap. Chunks stay in a table of about ``CACHE`` entries
between batches; when it is full, those the batch at hand does not use go. Unknown characters become byte pieces, or one unknown piece per run.

*Decoding* follows the library: control pieces vanish, byte runs are decoded with U+FFFD
for malformed bytes, the first word mark is the dummy prefix and is dropped.

Supported are BPE models without unused pieces, which is checked. Defined cases: a null
text encodes as the empty text (an end id only); texts that contain the names of control
pieces are ordinary text; rows are independent, so repeated rows repeat their result;
other columns are passed through.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import string
from collections.abc import Callable, Iterable, Iterator
from itertools import chain, pairwise, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendspark.llm.common import fresh, map_batches, table

MARK = "▁"
CACHE = 300_000
DIGESTS = ("n_tokens", "ids_sha256", "decoded_sha256")
SPANS = ("begins", "ends")
LONG = 48          # chunks of more characters are merged with a heap
GROUP = 1 << 20    # bytes of text encoded at once
WIDTHS = (4, 8, 12, 16, 24, 32, LONG)
_CELLS = 1 << 18   # symbols merged at once
_NORMAL, _UNKNOWN, _CONTROL, _USER, _UNUSED, _BYTE = 1, 2, 3, 4, 5, 6
_NO_PAIR = np.int32(1 << 30)


class CharMap:
    """The compiled character map: longest-prefix replacement on UTF-8 bytes."""

    def __init__(self, blob: bytes) -> None:
        size = int.from_bytes(blob[:4], "little")
        self.units = np.frombuffer(blob[4:4 + size], "<u4").tolist()
        self.strings = blob[4 + size:]

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """(bytes consumed, replacement) of the longest entry that starts at ``at``."""
        node, found = self._offset(self.units[0]), None
        for i in range(at, len(data)):
            node ^= data[i]
            unit = self.units[node] if node < len(self.units) else 0
            if unit & 0x800000FF != data[i]:
                break
            node ^= self._offset(unit)
            if unit >> 8 & 1:
                found = (i + 1 - at, self.units[node] & 0x7FFFFFFF)
        if found is None:
            return None
        end = self.strings.index(b"\0", found[1])
        return found[0], self.strings[found[1]:end]


def _chunk_rule(pieces: Iterable[str]) -> str:
    """A pattern of chunks that no merge can leave, from what stands side by side in pieces.

    If no piece holds a word mark after another character, a mark starts a chunk. A line
    feed that is in no piece is a chunk. Punctuation that follows other characters in no
    piece starts a chunk after them.
    """
    pieces = list(pieces)
    if any(MARK in p.lstrip(MARK) for p in pieces):
        return r"(?s:.+)"
    apart = "" if any("\n" in p for p in pieces) else "\n"
    marks = {c for c in string.punctuation}
    while True:     # shrink to the characters that only ever follow marks of the set
        bad = {b for p in pieces for a, b in zip(p, p[1:]) if b in marks and a != MARK and a not in marks}
        if not bad:
            break
        marks -= bad
    q = "".join(re.escape(c) for c in sorted(marks))
    if not q:
        return rf"{MARK}*[^{MARK}{apart}]+|{MARK}+" + (r"|\n" if apart else "")
    return rf"{MARK}*[{q}]*[^{MARK}{apart}{q}]+|{MARK}*[{q}]+|{MARK}+" + (r"|\n" if apart else "")


class PieceModel:
    """A loaded model: vocabulary, merges and normaliser settings (plain data, picklable)."""

    def __init__(self, blob: bytes) -> None:
        from sentencepiece import sentencepiece_model_pb2 as proto
        model = proto.ModelProto()
        model.ParseFromString(blob)
        norm = model.normalizer_spec
        kinds = [p.type for p in model.pieces]
        if model.trainer_spec.model_type != 2 or _UNUSED in kinds:
            raise ValueError("only BPE models without unused pieces are supported")
        self.names = [p.piece for p in model.pieces]
        self.kinds = kinds
        self.charmap = CharMap(norm.precompiled_charsmap) if norm.precompiled_charsmap else None
        self.dummy, self.trim = norm.add_dummy_prefix, norm.remove_extra_whitespaces
        self.escape = norm.escape_whitespaces
        self.suffix = model.trainer_spec.treat_whitespace_as_suffix
        self.fallback = model.trainer_spec.byte_fallback
        self.unk = kinds.index(_UNKNOWN)
        self.unk_surface = model.trainer_spec.unk_surface or " ⁇ "
        self.eos = self.names.index(model.trainer_spec.eos_piece or "</s>")
        self.bytes = {int(n[3:5], 16): i for i, (n, k) in enumerate(zip(self.names, kinds)) if k == _BYTE}
        usable = {n: i for i, (n, k) in enumerate(zip(self.names, kinds)) if k in (_NORMAL, _USER)}
        self.user = sorted((n for n, i in usable.items() if kinds[i] == _USER), key=len, reverse=True)
        # characters that only occur inside pieces get symbols of their own
        self.symbol = dict(usable)
        for name in list(usable):
            for c in name:
                self.symbol.setdefault(c, len(self.names) + len(self.symbol))
        scores = {i: p.score for i, p in enumerate(model.pieces)}
        rank = {s: r for r, s in enumerate(sorted({scores[i] for i in usable.values()}, reverse=True))}
        keys, out, order = [], [], []
        for name, i in usable.items():
            for cut in range(1, len(name)):
                a, b = self.symbol.get(name[:cut]), self.symbol.get(name[cut:])
                if a is not None and b is not None and self._merges(a) and self._merges(b):
                    keys.append(a << 32 | b)
                    out.append(i)
                    order.append(rank[scores[i]])
        at = np.argsort(np.array(keys, np.int64))
        self.pair = np.array(keys, np.int64)[at]
        self.pair_out = np.array(out, np.int32)[at]
        self.pair_rank = np.array(order, np.int32)[at]
        self.chunk = _chunk_rule(usable)
        self.plain = [n.replace(MARK, " ") for n in self.names]
        self.digits = [str(i) for i in range(len(self.names))]
        self.code = np.full(0x110000, -1, np.int32)       # symbol of each single character
        for c, i in self.symbol.items():
            if len(c) == 1:
                self.code[ord(c)] = i

    def state(self) -> dict:
        """Plain data to send to tasks, which need not have this module."""
        plain = {k: v for k, v in vars(self).items() if k not in ("charmap", "_table")}
        return plain | {"charmap": vars(self.charmap) if self.charmap else None}

    @classmethod
    def from_state(cls, state: dict) -> PieceModel:
        model = cls.__new__(cls)
        vars(model).update(state)
        if state["charmap"]:
            model.charmap = CharMap.__new__(CharMap)
            vars(model.charmap).update(state["charmap"])
        return model

    def _merges(self, symbol: int) -> bool:
        return symbol >= len(self.kinds) or self.kinds[symbol] != _USER


def normalise(model: PieceModel, text: str) -> tuple[str, list[int]]:
    """(normalised text, source byte offset of each of its characters and of its end)."""
    data = text.encode()
    user = re.compile("|".join(map(re.escape, model.user))) if model.user else None
    pairs: list[tuple[str, int, int]] = []           # (characters, source start, source end)
    at, pos = 0, 0
    while pos < len(text):
        hit = user.match(text, pos) if user else None
        if hit:
            size, new = len(hit.group().encode()), hit.group()
            pos += len(hit.group())
        else:
            got = model.charmap.longest(data, at) if model.charmap else None
            if got:
                size, new = got[0], got[1].decode()
                pos += len(data[at:at + size].decode())
            else:
                new = text[pos]
                size = len(new.encode())
                pos += 1
        pairs.append((new, at, at + size))
        at += size
    space = MARK if model.escape else " "
    out: list[str] = []
    source: list[int] = []
    if model.trim:
        while pairs and pairs[0][0] in (" ", ""):
            pairs.pop(0)
    start = pairs[0][1] if pairs else at
    if model.dummy and not model.suffix and pairs:
        out.append(space)
        source.append(start)
    gap = model.trim                                  # whether a space came just before
    for new, a, _ in pairs:
        if gap and model.trim:
            new = new.lstrip(" ")
        for c in new:
            out.append(space if c == " " else c)
            source.append(a)
        if new:
            gap = new.endswith(" ")
    end = pairs[-1][2] if pairs else at
    if model.trim:
        while out and out[-1] == space:
            out.pop()
            end = source.pop()
    if model.dummy and model.suffix and pairs:
        out.append(space)
        source.append(end)
    return "".join(out), [*source, end]


def aligned(model: PieceModel, text: str) -> tuple[str, np.ndarray]:
    """``normalise`` for any model; where no prefix can be replaced, offsets are read off the UTF-8 bytes at once."""
    if model.charmap or model.trim or model.suffix or not model.escape or model.user:
        out, source = normalise(model, text)
        return out, np.array(source, np.int32)
    data = np.frombuffer(text.encode(), np.uint8)
    starts = np.flatnonzero((data & 0xC0) != 0x80)
    lead = [0] if model.dummy and text else []
    return (MARK if lead else "") + text.replace(" ", MARK), np.concatenate([lead, starts, [len(data)]]).astype(np.int32)


def normalised(model: PieceModel, text: str) -> str:
    """The text of ``normalise`` without offsets."""
    return aligned(model, text)[0]


def chunker(model: PieceModel) -> Callable[[str], list[str]]:
    """Cuts a normalised text where no merge can cross."""
    parts = "|".join(map(re.escape, model.user))
    if not parts:
        return re.compile(model.chunk).findall
    user, plain = re.compile(f"({parts})"), re.compile(model.chunk).findall
    return lambda text: [c for i, s in enumerate(user.split(text)) if s for c in ([s] if i % 2 else plain(s))]


def _pair_lookup(model: PieceModel, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    key = np.where((a < 0) | (b < 0), -1, a.astype(np.int64) << 32 | b)
    at = np.minimum(np.searchsorted(model.pair, key), max(len(model.pair) - 1, 0))
    if not len(model.pair):
        return np.full(a.shape, _NO_PAIR), np.zeros(a.shape, np.int32)
    hit = model.pair[at] == key
    return np.where(hit, model.pair_rank[at], _NO_PAIR), model.pair_out[at]


def merge_matrix(model: PieceModel, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge the rows of a matrix of symbols, padded with -1 at the end: final symbols and their numbers."""
    n, width = ids.shape
    length = np.full(n, width)
    live = np.arange(n)
    rank, out = _pair_lookup(model, ids[:, :-1], ids[:, 1:])
    final = np.full((n, width), -1, np.int32)
    while len(live):
        best = rank.argmin(axis=1) if rank.shape[1] else np.zeros(len(live), np.int64)
        row = np.arange(len(live))
        go = rank[row, best] < _NO_PAIR if rank.shape[1] else np.zeros(len(live), bool)
        if not go.all():
            done = live[~go]
            final[done, :ids.shape[1]] = ids[~go]
            live, ids, rank, out, best = live[go], ids[go], rank[go], out[go], best[go]
            if not len(live):
                break
        length[live] -= 1
        row, width = np.arange(len(live)), ids.shape[1]
        ids[row, best] = out[row, best]
        cols = np.arange(width)[None, :]
        ids = ids[cols != best[:, None] + 1].reshape(len(live), width - 1)
        keep = cols[:, :-1] != np.minimum(best, width - 2)[:, None]
        rank, out = rank[keep].reshape(len(live), width - 2), out[keep].reshape(len(live), width - 2)
        for side in (best - 1, best):                  # the pairs next to the merged symbol
            ok = np.flatnonzero((side >= 0) & (side < width - 2))
            if len(ok):
                at = side[ok]
                rank[ok, at], out[ok, at] = _pair_lookup(model, ids[ok, at], ids[ok, at + 1])
    return final, length


def merge_long(model: PieceModel, ids: list[int]) -> list[int]:
    """The same merges for one long chunk, with a heap of adjacent pairs."""
    table = getattr(model, "_table", None)
    if table is None:
        table = dict(zip(model.pair.tolist(), zip(model.pair_rank.tolist(), model.pair_out.tolist())))
        model._table = table
    n = len(ids)
    nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
    heap: list[tuple] = []

    def push(i: int) -> None:
        j = nxt[i]
        if j < n and ids[i] >= 0 and ids[j] >= 0:
            got = table.get(ids[i] << 32 | ids[j])
            if got:
                heapq.heappush(heap, (got[0], i, ids[i], ids[j], got[1]))
    for i in range(n - 1):
        push(i)
    gone = bytearray(n + 1)
    while heap:
        _, i, a, b, made = heapq.heappop(heap)
        j = nxt[i]
        if gone[i] or j >= n or ids[i] != a or ids[j] != b:
            continue
        ids[i], gone[j], nxt[i] = made, 1, nxt[j]
        if nxt[j] < n:
            prv[nxt[j]] = i
        push(i)
        if prv[i] >= 0:
            push(prv[i])
    return [s for i, s in enumerate(ids) if not gone[i]]


def _pieces(model: PieceModel, chunk: str, symbols: list[int]) -> tuple[list[int], list[int]]:
    """(ids, characters of the chunk that each id ends); unknown symbols become bytes."""
    ids: list[int] = []
    sizes: list[int] = []
    at, top = 0, len(model.names)
    unknown = False
    for s in symbols:
        size = len(model.names[s]) if 0 <= s < top else 1
        if 0 <= s < top:
            ids.append(s)
            sizes.append(size)
            unknown = False
        elif model.fallback:
            raw = chunk[at].encode()
            ids.extend(model.bytes[b] for b in raw)
            sizes.extend([0] * (len(raw) - 1) + [1])
        elif unknown:
            sizes[-1] += 1
        else:
            ids.append(model.unk)
            sizes.append(1)
            unknown = True
        at += size
    return ids, sizes


def places(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The places of runs, one run after the other: ``count`` places from ``first`` on."""
    end = np.cumsum(count)
    return np.arange(end[-1] if len(end) else 0) + np.repeat(first - (end - count), count)


class Encoded:
    """Ids of numbered chunks, one chunk after the other, and the characters that each id ends."""

    def __init__(self) -> None:
        self.number: dict[str, int] = {}
        self.first, self.count = np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.flat, self.ended = np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.ids = self                                # ids[chunk]
        self.used = np.zeros(0, np.int64)

    def _run(self, chunk: str) -> slice:
        k = self.number[chunk]
        return slice(int(self.first[k]), int(self.first[k]) + int(self.count[k]))

    def __getitem__(self, chunk: str) -> list[int]:
        return self.flat[self._run(chunk)].tolist()

    def sizes(self, model: PieceModel, chunk: str) -> list[int]:
        """Characters of the chunk that each id ends."""
        return self.ended[self._run(chunk)].tolist()

    def add(self, chunks: list[str], count: np.ndarray, flat: np.ndarray, ended: np.ndarray) -> None:
        have = len(self.number)
        self.number.update(zip(chunks, range(have, have + len(chunks))))
        self.first = np.append(self.first, len(self.flat) + np.cumsum(count) - count)
        self.count = np.append(self.count, count.astype(np.int32))
        self.flat = np.append(self.flat, flat.astype(np.int32))
        self.ended = np.append(self.ended, ended.astype(np.int32))

    def keep(self, k: np.ndarray) -> None:
        """Forget all chunks but those of the numbers ``k`` (ascending), which are numbered anew."""
        chunks, at = list(self.number), places(self.first[k], self.count[k])   # chunks lie in the order of their numbers
        chunks, count, flat, ended = [chunks[i] for i in k.tolist()], self.count[k], self.flat[at], self.ended[at]
        self.__init__()
        self.add(chunks, count, flat, ended)


def _blocks(chunks: Iterable[str]) -> Iterator[tuple[int, list[str]]]:
    """(width, chunks of at most that many characters), long ones under their own length."""
    chunks = sorted(chunks, key=len)
    size = np.fromiter(map(len, chunks), np.int64, len(chunks))
    lo = 0
    while lo < len(chunks):
        wide = next((w for w in WIDTHS if size[lo] <= w), int(size[lo]))
        hi = min(int(np.searchsorted(size, wide, side="right")), lo + max(1, _CELLS // wide))
        yield wide, chunks[lo:hi]
        lo = hi


def encode_chunks(model: PieceModel, chunks: Iterable[str], into: Encoded) -> None:
    """Encode distinct chunks, those of like length together."""
    top = len(model.names)
    lengths = np.array([len(n) for n in model.names], np.int32)
    found: list[tuple[list[str], np.ndarray, np.ndarray, np.ndarray]] = []

    def slow(some: list[str], symbols: Iterable[list[int]]) -> None:
        made = [_pieces(model, c, row) for c, row in zip(some, symbols)]
        found.append((some, np.array([len(ids) for ids, _ in made]), np.array([i for ids, _ in made for i in ids]),
                      np.array([n for _, sizes in made for n in sizes])))

    if model.user:
        whole = [c for c in chunks if c in model.user]
        chunks = [c for c in chunks if c not in model.user]
        found.append((whole, np.ones(len(whole), int), np.array([model.symbol[c] for c in whole], int),
                      np.array([len(c) for c in whole], int)))
    for wide, some in _blocks(chunks):
        points = np.frombuffer("".join(some).encode("utf-32-le", "surrogatepass"), np.uint32)
        size = np.fromiter(map(len, some), np.int64, len(some))
        ids = np.full((len(some), wide), -1, np.int32)
        ids[np.arange(wide) < size[:, None]] = model.code[points]
        if wide > LONG:
            slow(some, [merge_long(model, row) for row in ids.tolist()])
            continue
        rows, length = merge_matrix(model, ids)
        length = length - (wide - size)                # without the padding
        real = np.arange(wide) < length[:, None]
        plain = (((rows >= 0) & (rows < top)) | ~real).all(axis=1)
        symbols = rows[real & plain[:, None]]
        found.append(([c for c, ok in zip(some, plain.tolist()) if ok] if not plain.all() else some,
                      length[plain], symbols, lengths[symbols]))
        odd = np.flatnonzero(~plain).tolist()
        if odd:
            slow([some[r] for r in odd], [rows[r, :length[r]].tolist() for r in odd])
    if found:
        into.add([c for f in found for c in f[0]], *[np.concatenate([f[k] for f in found]) for k in (1, 2, 3)])


def decode(model: PieceModel, ids: Iterable[int]) -> str:
    """The text of a list of ids."""
    out: list[str] = []
    raw = bytearray()
    start, seen = True, False
    for i in ids:
        kind = model.kinds[i]
        if kind == _BYTE:
            raw.append(int(model.names[i][3:5], 16))
            continue
        if raw:
            out.append(_broken_utf8(bytes(raw)))
            raw.clear()
        if seen or any(out):
            start = False
        seen = False
        if kind == _CONTROL:
            continue
        if kind == _UNKNOWN:
            out.append(model.unk_surface)
            continue
        name = model.names[i]
        if start and (model.dummy or model.trim) and name.startswith(MARK):
            name = name[1:]
            seen = not model.trim
        out.append(name.replace(MARK, " "))
    if raw:
        out.append(_broken_utf8(bytes(raw)))
    return "".join(out)


def _broken_utf8(raw: bytes) -> str:
    """UTF-8 with one U+FFFD for each byte that starts no valid character."""
    out, at = [], 0
    while at < len(raw):
        for size in (1, 2, 3, 4):
            try:
                out.append(raw[at:at + size].decode())
                at += size
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


def load_model(path: str) -> PieceModel:
    """Read a model on the driver; about half a megabyte, sent to the tasks as it is."""
    with open(path, "rb") as f:
        return PieceModel(f.read())


def _encoder(model: PieceModel) -> Callable[[list[str]], tuple[Encoded, list[list[str]]]]:
    """A table of encoded chunks that is kept between batches up to its bound; ``used`` numbers the batch's chunks."""
    known = Encoded()
    cut = chunker(model)

    def run(normal: list[str]) -> tuple[Encoded, list[list[str]]]:
        lists = [cut(t) for t in normal]
        flat = list(chain.from_iterable(lists))
        used = np.fromiter(map(known.number.get, flat, repeat(-1)), np.int64, len(flat))
        missing = np.flatnonzero(used < 0).tolist()
        new = {flat[i] for i in missing}
        if len(known.number) + len(new) > CACHE:
            kept, at = np.unique(used, return_inverse=True)
            known.keep(kept[kept >= 0])
            used = at - int(bool(missing))
        if new:
            encode_chunks(model, new, known)
            used[missing] = [known.number[flat[i]] for i in missing]
        known.used = used
        return known, lists
    return run


def _groups(column: pa.Array, bound: int = GROUP) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of runs of rows with at most ``bound`` bytes, or of one row; null is empty."""
    end = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(end, (end[lo - 1] if lo else 0) + bound, side="right")))
        yield lo, [t or "" for t in column.slice(lo, hi - lo).to_pylist()]
        lo = hi


class _Strings:
    """Byte strings by id, looked up for many ids at once."""

    def __init__(self, strings: list[bytes]) -> None:
        self.data = np.frombuffer(b"".join(strings), np.uint8)
        self.size = np.array([len(s) for s in strings], np.int64)
        self.first = np.cumsum(self.size) - self.size

    def joined(self, ids: np.ndarray, rows: np.ndarray) -> tuple[bytes, list[int]]:
        """The strings of all ids, and where each row's start; row r ends before id ``rows[r + 1]``."""
        size = self.size[ids]
        return self.data[places(self.first[ids], size)].tobytes(), np.append(0, np.cumsum(size))[rows].tolist()


def _surface(model: PieceModel, i: int) -> bytes:
    """What an id adds to a decoded text: a byte piece its byte, a control piece nothing."""
    if model.kinds[i] == _BYTE:
        return bytes([int(model.names[i][3:5], 16)])
    if model.kinds[i] == _UNKNOWN:
        return model.unk_surface.encode()
    return b"" if model.kinds[i] == _CONTROL else model.plain[i].encode()


def encode_pieces(docs: DataFrame, text: str, model: PieceModel, out: str = "pieces") -> DataFrame:
    """``docs`` with a struct column ``out``: ids (with the end id), the span of original
    bytes of each (``begins``, ``ends``; leading byte pieces and the end id are empty spans), and
    n_tokens, ids_sha256 and decoded_sha256 of the ids."""
    sent = docs.sparkSession.sparkContext.broadcast(model.state())
    column, names = docs.columns.index(text), docs.columns
    ints = T.ArrayType(T.IntegerType())
    kind = T.StructType([*[T.StructField(c, ints) for c in ("ids", "begins", "ends")], T.StructField("n_tokens", T.LongType()),
                         T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = PieceModel.from_state(sent.value)
        encode = _encoder(m)
        digits = _Strings([b"%d " % i for i in range(len(m.names))])
        surfaces = _Strings([_surface(m, i) for i in range(len(m.names))])
        # else a text that is not empty starts with the prefix, and its byte pieces are whole characters
        library = m.trim or not m.dummy or m.suffix or not m.fallback or MARK not in m.symbol
        for batch in batches:
            for lo, some in _groups(batch.column(column).cast(pa.string())):
                normal, sources = zip(*[aligned(m, t) for t in some])
                known, lists = encode(normal)
                cut = np.fromiter(map(len, lists), np.int64, len(lists))
                k = known.used
                del lists
                count = known.count[k]
                at = places(known.first[k], count)
                ids, size = known.flat[at], known.ended[at]
                stop = np.append(0, np.cumsum(count))[np.append(0, np.cumsum(cut))]     # ids before each text
                counts = np.diff(stop)
                last = np.append(0, np.cumsum(size))
                source, points = np.concatenate(sources), np.fromiter(map(len, sources), np.int64, len(sources))
                # places in ``source``: its texts' characters, each text's end after them
                last = last[1:] + np.repeat(np.cumsum(points) - points - last[stop[:-1]], counts)
                ends, over = source[last], source[np.cumsum(points) - 1]
                flat = np.insert(ids, stop[1:], m.eos)
                begins, ends = np.insert(source[last - size], stop[1:], over), np.insert(ends, stop[1:], over)
                bounds = np.append(0, np.cumsum(counts + 1))
                data, edge = digits.joined(flat, bounds)
                of_ids = [hashlib.sha256(data[a:b - 1]).hexdigest() for a, b in pairwise(edge)]
                if library:
                    back = [decode(m, flat[a:b].tolist()).encode() for a, b in pairwise(bounds.tolist())]
                else:
                    data, edge = surfaces.joined(flat, bounds)
                    back = [data[a + 1:b] for a, b in pairwise(edge)]                   # without the prefix
                found = pa.StructArray.from_arrays(
                    [*[pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(v, pa.int32())) for v in (flat, begins, ends)],
                     pa.array(counts + 1, pa.int64()), pa.array(of_ids, pa.string()),
                     pa.array([hashlib.sha256(b).hexdigest() for b in back], pa.string())], names=kind.names)
                yield pa.RecordBatch.from_arrays([*batch.slice(lo, len(some)).columns, found], names=[*names, out])
    return map_batches(docs, run, T.StructType([*docs.schema.fields, T.StructField(out, kind)]))


def encode_digests(docs: DataFrame, text: str, model: PieceModel, out: str = "digest") -> DataFrame:
    """``docs`` with a struct column ``out``: n_tokens, ids_sha256, decoded_sha256 of ``encode_pieces``."""
    pieces = fresh("pieces")
    return encode_pieces(docs, text, model, pieces).select(
        *[F.col(f"`{c}`") for c in docs.columns], F.struct(*[F.col(f"{pieces}.{c}") for c in DIGESTS]).alias(out))


def default_model() -> str:
    """Path of the production model, a file of the installed tokenizer package."""
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def op2_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole document encoded and decoded, with the byte span of each piece."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = encode_pieces(docs, "text", load_model(default_model()))
    return found.select("doc_id", *[F.col(f"pieces.{c}").alias(c) for c in (*DIGESTS, *SPANS)])
