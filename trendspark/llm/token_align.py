"""Alignment of two tokenizers' tokens over the bytes of a text, by merge paths.

Tokenizer A is a byte-level BPE (``tokenizers`` file), B a SentencePiece model; both are
encoded by libraries, without special tokens, A on a space and the text, B on the text
(its model adds the space). Where A's file has the usual pattern and its merges in the
order of their ids, ``tiktoken`` encodes it (the same ids at a fraction of the time; a test
compares both on every code point), else ``tokenizers``. The end offsets of A's and of B's tokens are two
ascending lists. A piece of their merge is found by a binary search along a diagonal of
the (A, B) grid, so the pieces hold equal numbers of ends, whatever the texts, and are
merged on their own. Each distinct end gives one *link*, the pair of the A and B token
that hold the byte before it: every overlapping pair of tokens has exactly one. An end
that both sides have closes a *group*. Where such an end falls on a cut, one side's lies
in the earlier piece and the other's in the later: the two are stitched into one.

Pair counts are summed over the whole corpus. The counts of the commonest ``HOT`` pairs
are sent to all tasks; the links of the other pairs are joined with theirs.

Defined cases: null and empty texts, and texts whose joined token bytes are not a space
and the text (such as texts with U+2581), have no tokens: zeros, and '' as digest. Rows
are independent (repeated rows, null ids); other columns pass through; an empty table
gives an empty result. Memory follows one slice of ``SLICE`` characters or the longest text.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendspark.llm.common import Scratch, batch_rows, common_from, map_batches, table

WORK = 1 << 14     # ends of a merge piece
HOT = 1 << 20      # pairs whose counts are sent to all tasks
SLICE = 1 << 17    # text characters aligned at once
LINKS = 1 << 17    # links looked up at once
ROWS = 1000        # rows sent to Python at once, as each has long lists
_HELD = 1 << 19    # distinct pairs a counting task holds before it hands them on
FIELDS = ("n_a", "n_b", "n_groups", "n_links")


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(others)}


class TokenBytes:
    """The bytes of every token id: a flat buffer, starts and sizes."""

    def __init__(self, tokens: list[bytes]) -> None:
        self.sizes = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(tokens), np.uint8)

    def join(self, ids: np.ndarray) -> np.ndarray:
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        return self.data[np.repeat(self.starts[ids] - (ends - sizes), sizes) + np.arange(total)]


def ranked_encoder(a_file: bytes) -> Callable[[str], np.ndarray] | None:
    """A ``tiktoken`` encoder of a ``tokenizers`` file, or None where the two could differ."""
    import public_tokenizers
    import tiktoken
    whole = json.loads(a_file)
    model, cut = whole["model"], whole.get("pre_tokenizer") or {}
    plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
    if whole.get("normalizer") or plain.items() - cut.items() or model.get("dropout") or model.get("ignore_merges"):
        return None
    letters, added = byte_alphabet(), {t["content"] for t in whole["added_tokens"]}
    vocab = {k: v for k, v in model["vocab"].items() if k not in added}
    merged = [m if isinstance(m, str) else " ".join(m) for m in model["merges"]]
    in_order = all(vocab.get(m.replace(" ", "")) == len(letters) + k for k, m in enumerate(merged))
    if not in_order or len(vocab) != len(letters) + len(merged):
        return None
    ranks = {bytes(letters[c] for c in k): v for k, v in vocab.items()}
    encoding = tiktoken.Encoding("ranked", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda text: encoding.encode_to_numpy(text, disallowed_special=())


def library_encoder(a_file: bytes):
    """The file's own library; the strings of its special tokens are plain text."""
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"     # tasks share the cores
    from tokenizers import Tokenizer
    made = Tokenizer.from_str(a_file.decode())
    made.encode_special_tokens = True
    return made


class Pair:
    """Both tokenizers inside a task, from the contents of their files."""

    def __init__(self, a_file: bytes, b_file: bytes) -> None:
        import sentencepiece
        self.fast, self.a = ranked_encoder(a_file), None
        if not self.fast:
            self.a = library_encoder(a_file)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_file)
        letters, whole = byte_alphabet(), json.loads(a_file)
        ids = whole["model"]["vocab"] | {t["content"]: t["id"] for t in whole["added_tokens"]}
        size = max(ids.values()) + 1
        names = [""] * size
        for name, i in ids.items():
            names[i] = name
        self.a_bytes = TokenBytes([bytes(letters[c] for c in n) if set(n) <= letters.keys() else n.encode() for n in names])
        self.b_bytes = TokenBytes([
            bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i)
            else self.b.id_to_piece(i).replace("▁", " ").encode() for i in range(self.b.get_piece_size())])
        self.b_base = 2 * size
        # the text of each id with what follows it: A ',' or '|'; B ',' ';' or nothing
        self.names = [f"{i}{s}" for i in range(size) for s in ",|"] + \
            [f"{i}{s}" for i in range(self.b.get_piece_size()) for s in (",", ";", "")]

    def encode(self, texts: list[str]) -> tuple[list, list[list[int]]]:
        padded = [" " + t for t in texts]
        left = [self.fast(t) for t in padded] if self.fast else \
            [e.ids for e in self.a.encode_batch_fast(padded, add_special_tokens=False)]
        return left, self.b.encode(texts, num_threads=1)


def merge_cuts(a: np.ndarray, b: np.ndarray, work: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the merge of two ascending lists crosses every ``work``-th diagonal.

    Returns the number of elements of ``a`` and of ``b`` before each cut; of equal
    elements that of ``a`` comes first. All diagonals are searched at once.
    """
    total = len(a) + len(b)
    diagonal = np.append(np.arange(0, total, work), total)
    low, high = np.maximum(diagonal - len(b), 0), np.minimum(diagonal, len(a))
    while (low < high).any():
        middle = (low + high) // 2
        open_ = low < high
        i, j = np.where(open_, middle, 0), np.where(open_, diagonal - middle - 1, 0)
        later = open_ & (a[np.minimum(i, len(a) - 1)] <= b[np.maximum(j, 0)])
        low = np.where(later, middle + 1, low)
        high = np.where(open_ & ~later, middle, high)
    return low, diagonal - low


def merge_ends(a: np.ndarray, b: np.ndarray, work: int = WORK) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Merge two ascending lists of ends: (distinct ends, A token and B token of the
    link at each, whether both lists have it). Both lists end alike or are empty."""
    if not len(a) or not len(b):
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(bool)
    at_a, at_b = merge_cuts(a, b, work)
    ends, left, right, both = [], [], [], []
    for i0, i1, j0, j1 in zip(at_a[:-1], at_a[1:], at_b[:-1], at_b[1:]):
        x, y = a[i0:i1], b[j0:j1]
        merged = np.concatenate([x, y])
        merged.sort(kind="stable")                          # two runs: linear
        new = np.append(True, merged[1:] != merged[:-1])
        some = merged[new]
        twice = np.append(~new[1:], False)[new]
        if ends and len(some) and ends[-1][-1] == some[0]:  # the cut fell inside a common end
            both[-1][-1] = True
            some, twice = some[1:], twice[1:]
        if not len(some):
            continue
        ends.append(some)
        left.append(i0 + np.searchsorted(x, some))
        right.append(j0 + np.searchsorted(y, some))
        both.append(twice)
    return np.concatenate(ends), np.concatenate(left), np.concatenate(right), np.concatenate(both)


def _flat(lists: list) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(x) for x in lists], np.int64)
    if lists and isinstance(lists[0], np.ndarray):
        return np.concatenate(lists).astype(np.int64), sizes
    return np.fromiter(chain.from_iterable(lists), np.int64, int(sizes.sum())), sizes


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    total = np.append(0, np.cumsum(values))
    last = np.cumsum(sizes)
    return total[last] - total[last - sizes]


def _same_bytes(tokens: TokenBytes, ids: np.ndarray, sizes: np.ndarray, want: list[bytes]) -> np.ndarray:
    """Which rows' joined tokens are the wanted bytes."""
    length = _sums(tokens.sizes[ids], sizes)
    ok = length == np.array([len(w) for w in want])
    joined = tokens.join(ids).tobytes()
    if ok.all() and joined == b"".join(want):
        return ok
    last = np.cumsum(length)
    return np.array([bool(k) and joined[e - n:e] == w for k, e, n, w in zip(ok, last, length, want)], bool)


def align_texts(pair: Pair, texts: list[str | None], work: int = WORK) -> dict:
    """The alignment of some texts: counts per row, the link and group lists and the groups' text."""
    rows = len(texts)
    a_lists, b_lists = pair.encode([t or "" for t in texts])
    a_ids, n_a = _flat(a_lists)
    b_ids, n_b = _flat(b_lists)
    want = [b" " + t.encode() if t else b"" for t in texts]
    ok = np.array([bool(t) for t in texts], bool)
    ok &= _same_bytes(pair.a_bytes, a_ids, n_a, want) & _same_bytes(pair.b_bytes, b_ids, n_b, want)
    a_ids, b_ids = a_ids[np.repeat(ok, n_a)], b_ids[np.repeat(ok, n_b)]
    n_a, n_b = np.where(ok, n_a, 0), np.where(ok, n_b, 0)
    a_end, b_end = np.cumsum(pair.a_bytes.sizes[a_ids]), np.cumsum(pair.b_bytes.sizes[b_ids])
    ends, left, right, both = merge_ends(a_end, b_end, work)
    row_of_a, row_of_b = np.repeat(np.arange(rows), n_a), np.repeat(np.arange(rows), n_b)
    row = row_of_a[left]
    closes, row_of_group = ends[both], row[both]
    # a group is its A tokens, then its B tokens; both lists' last tokens of a group end together
    ends_a, ends_b = np.zeros(len(a_ids), np.int64), np.zeros(len(b_ids), np.int64)
    ends_a[left[both]] = ends_b[right[both]] = 1
    group_a, group_b = np.cumsum(ends_a) - ends_a, np.cumsum(ends_b) - ends_b
    first_b, last_a = np.append(0, right[both] + 1)[:-1], left[both] + 1
    ends_row = np.append(row_of_b[1:] != row_of_b[:-1], True) if len(row_of_b) else np.zeros(0, bool)
    code = np.empty(len(a_ids) + len(b_ids), np.int64)
    code[np.arange(len(a_ids)) + first_b[group_a]] = 2 * a_ids + ends_a
    code[np.arange(len(b_ids)) + last_a[group_b]] = pair.b_base + 3 * b_ids + np.where(ends_row, 2, ends_b)
    stop = np.cumsum(n_a + n_b)
    start = stop - n_a - n_b
    base = np.cumsum(np.where(ok, [len(w) for w in want], 0)) - np.where(ok, [len(w) for w in want], 0)
    names = pair.names
    return {"n_a": n_a, "n_b": n_b, "n_groups": np.bincount(row_of_group, minlength=rows), "n_links": np.bincount(row, minlength=rows),
            "link_a": a_ids[left], "link_b": b_ids[right], "group_ends": closes - base[row_of_group],
            "groups": ["".join([names[c] for c in code[s:e].tolist()]) for s, e in zip(start, stop)]}


_INTS = T.ArrayType(T.IntegerType())
ALIGNED = T.StructType([*[T.StructField(n, T.LongType()) for n in FIELDS], T.StructField("groups", T.StringType()),
                        T.StructField("group_ends", _INTS), T.StructField("link_a", _INTS), T.StructField("link_b", _INTS)])


def _text_groups(texts: list[str | None], bound: int) -> Iterator[tuple[int, list[str | None]]]:
    lo, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > lo and size + n > bound:
            yield lo, texts[lo:i]
            lo, size = i, 0
        size += n
    if lo < len(texts):
        yield lo, texts[lo:]


def align_tokens(docs: DataFrame, text: str, a_file: str, b_file: str, out: str = "aligned", work: int = WORK) -> DataFrame:
    """``docs`` with a struct column ``out``: n_a, n_b, n_groups, n_links, ``groups``
    (``a1,a2|b1;a3|b2``: ids in order), ``group_ends`` (byte ends of the groups in the
    space and the text) and the A and B ids of each link (``link_a``, ``link_b``).

    The files are read on the driver (a megabyte or two) and sent to the tasks.
    """
    with open(a_file, "rb") as fa, open(b_file, "rb") as fb:
        sent = docs.sparkSession.sparkContext.broadcast((fa.read(), fb.read()))
    names, column = docs.columns, docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = Pair(*sent.value)
        for batch in batches:
            for lo, some in _text_groups(batch.column(column).cast(pa.string()).to_pylist(), SLICE):
                got = align_texts(pair, some, work)

                def lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
                    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), pa.array(values, pa.int32()))
                made = pa.StructArray.from_arrays(
                    [*[pa.array(got[n], pa.int64()) for n in FIELDS], pa.array(got["groups"], pa.string()),
                     lists(got["group_ends"], got["n_groups"]), lists(got["link_a"], got["n_links"]),
                     lists(got["link_b"], got["n_links"])], names=ALIGNED.names)
                yield pa.RecordBatch.from_arrays([*batch.slice(lo, len(some)).columns, made], names=[*names, out])
    return map_batches(docs, run, T.StructType([*docs.schema.fields, T.StructField(out, ALIGNED)]))


def _keys(batch: pa.RecordBatch, a: int, b: int) -> np.ndarray:
    """Pair keys of a batch's links: the A id in the upper half, the B id in the lower."""
    left, right = batch.column(a).flatten().to_numpy(), batch.column(b).flatten().to_numpy()
    return left.astype(np.int64) << 32 | right


def _row_slices(batch: pa.RecordBatch, column: int, bound: int = LINKS) -> Iterator[pa.RecordBatch]:
    """A batch cut into runs of rows with at most ``bound`` entries of a list column (one row at least)."""
    ends = batch.column(column).offsets.to_numpy()
    lo = 0
    while lo < batch.num_rows:
        hi = max(int(np.searchsorted(ends, ends[lo] + bound, "right")) - 1, lo + 1)
        yield batch.slice(lo, hi - lo)
        lo = hi


def pair_counts(links: DataFrame) -> DataFrame:
    """(pair, b, c): how many links hold each pair of ids, over all rows of ``link_a``, ``link_b``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, seen = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def table_of() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(seen)], names=["pair", "c"])
        for batch in batches:
            for part in _row_slices(batch, 0):
                new, n = np.unique(_keys(part, 0, 1), return_counts=True)
                both = np.concatenate([keys, new])
                keys, which = np.unique(both, return_inverse=True)
                seen = np.bincount(which, np.concatenate([seen, n]), len(keys)).astype(np.int64)
                if len(keys) > _HELD:
                    yield table_of()
                    keys, seen = keys[:0], seen[:0]
        if len(keys):
            yield table_of()
    found = links.select("link_a", "link_b").mapInArrow(run, "pair long, c long")
    return found.groupBy("pair").agg(F.sum("c").alias("c")).select("pair", F.col("pair").bitwiseAND(0xFFFFFFFF).alias("b"), "c")


def link_sums(aligned: DataFrame, scratch: Scratch, hot: int = HOT) -> DataFrame:
    """Rows of ``aligned`` (with ``link_a``, ``link_b``) without the links but with ``n_best``
    (links whose pair is the commonest of its B id, ties included) and ``count_sum`` (the
    sum of the links' pair counts)."""
    spark = aligned.sparkSession
    with batch_rows(spark, ROWS):
        counts = scratch.keep(pair_counts(aligned), "counts")
    top = counts.groupBy("b").agg(F.max("c").alias("top"))              # at most one row per B id
    rated = scratch.keep(counts.join(F.broadcast(top), "b").select("pair", "c", (F.col("c") == F.col("top")).alias("best")), "rated")
    scratch.drop(counts)
    least = common_from(rated, hot)
    common = rated.where(F.col("c") >= least).toArrow().sort_by("pair")
    sent = spark.sparkContext.broadcast(
        (common["pair"].to_numpy(), common["c"].to_numpy(), common["best"].to_numpy()))
    kept = [f for f in aligned.schema.fields if f.name not in ("link_a", "link_b")]
    made = T.StructType([*kept, *[T.StructField(n, T.LongType()) for n in ("__row", "__best", "__sum")],
                         T.StructField("__rare", T.ArrayType(T.LongType()))])
    own = [aligned.columns.index(f.name) for f in kept]
    at_a, at_b = aligned.columns.index("link_a"), aligned.columns.index("link_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, seen, best = sent.value
        first = TaskContext.get().partitionId() << 40
        for batch in (part for whole in batches for part in _row_slices(whole, at_a)):
            key = _keys(batch, at_a, at_b)
            sizes = np.diff(batch.column(at_a).offsets.to_numpy()).astype(np.int64)
            row = np.repeat(np.arange(batch.num_rows), sizes)
            place = np.minimum(np.searchsorted(pairs, key), max(len(pairs) - 1, 0))
            hit = pairs[place] == key if len(pairs) else np.zeros(len(key), bool)
            count = np.zeros(len(key), np.int64)
            count[hit] = seen[place[hit]]
            good = np.zeros(len(key), np.int64)
            good[hit] = best[place[hit]]
            rare = np.append(0, np.cumsum(np.bincount(row[~hit], minlength=batch.num_rows)))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in own], pa.array(first + np.arange(batch.num_rows)), pa.array(_sums(good, sizes)),
                 pa.array(_sums(count, sizes)), pa.ListArray.from_arrays(pa.array(rare, pa.int32()), pa.array(key[~hit]))],
                names=made.names)
            first += batch.num_rows
    with batch_rows(spark, ROWS):
        summed = scratch.keep(aligned.mapInArrow(run, made), "summed")
    scratch.drop(aligned)
    rare = (summed.select("__row", F.explode("__rare").alias("pair")).groupBy("__row", "pair").agg(F.count("*").alias("n"))
            .join(rated.where(F.col("c") < least), "pair")
            .groupBy("__row").agg(F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("__best2"),
                                  F.sum(F.col("n") * F.col("c")).alias("__sum2")))
    zero = F.lit(0).cast("long")
    return summed.join(rare, "__row", "left").select(
        *[F.col(f"`{f.name}`") for f in kept],
        (F.col("__best") + F.coalesce("__best2", zero)).alias("n_best"),
        (F.col("__sum") + F.coalesce("__sum2", zero)).alias("count_sum"))


def default_files() -> tuple[str, str]:
    """Paths of the production tokenizers, files of the installed tokenizer package."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def op11_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole document aligned between the two tokenizers, with corpus-wide pair counts."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scratch = Scratch(spark, "align")
    digest = F.when(F.col("aligned.n_a") > 0, F.sha2("aligned.groups", 256)).otherwise("")
    aligned = align_tokens(docs, "text", *default_files()).select(
        "doc_id", *[F.col(f"aligned.{n}").alias(n) for n in FIELDS], digest.alias("groups_sha256"),
        F.col("aligned.link_a").alias("link_a"), F.col("aligned.link_b").alias("link_b"))
    with batch_rows(spark, ROWS):
        found = scratch.keep(aligned, "links")
    return link_sums(found, scratch)
