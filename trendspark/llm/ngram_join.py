"""N-gram Jaccard join with a count-vector tree.

A document's set is its distinct ``k``-word shingles; with fewer words the whole
sequence is the one shingle. Two documents link when
``den * |A & B| >= num * |A | B|``. Equal sets form a class; the work is on classes.

*Points.* Shingles are hashed into ``GROUPS`` groups; the counts per group are the
class's point. The summed coordinate minima of two points bound their overlap from
above, and the minima of a point with a node's coordinate maxima bound it for the whole
node: ``CountTree`` packs points sorted by size into such nodes. Pairs that survive the
tree are bounded once more on fine points, whose groups grow with the set (about two
shingles each), before they are verified.

*Blocks.* One tree over all points would be searched by every point, which grows with
the square of the input since points of unrelated texts have overlapping boxes. So a
tree is built per block: linked sets share one of their ``n - ceil(num * n / den) + 1``
first shingles in any fixed order, hence each linked pair meets in the block of such a
shingle. The order is rare shingles first, by counts of all shingles in ``SKETCH`` hash
buckets, then by hash; it only decides how many unrelated sets meet. A block holds only sets
whose sizes follow one another within the threshold ratio. Blocks with the same members are
searched once.

*Rounds.* First each member is compared with the smallest and the largest class of its
blocks (a join, no grouping), the surviving pairs are bounded on fine points, verified on
whole sets and contracted to components. Then the blocks that still hold several components are
searched with trees, only across components, in tiles of at most ``TILE`` members per
side: a first search names the members with any candidate; these get fine points, and a
second search names those that still have one; these get their whole sets, and a third search
verifies the pairs where they are found and returns those links that join two components. Every
candidate is verified unless its ends are joined already, and no search lists the pairs of a
group: each returns at most as many rows as it reads.

Defined cases: null, empty and wordless texts have an empty set and are linked with
nothing; rows with a null id only count as copies of rows that have one, and else link
with nothing; repeated rows are copies.
Set keys are 64-bit hashes guarded by a second 64-bit hash: if two different sets ever
share a key the job fails and asks for another ``seed``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trendspark.llm.common import Scratch, batch_rows, fresh, table
from trendspark.llm.components import connected_components
from trendspark.llm.textscan import (
    U64, Powers, Words, byte_codes, gram_hashes, splitmix, text_slices)

GROUPS = 64
FINE_MOST = 8192             # most groups of a fine point
LEAF = 32
TILE = 2048
PAIRS = 1 << 18              # candidate pairs that a tree search holds at once
FINE_ROWS = 1024             # rows with fine points that travel in one Arrow batch (8 MB)
SET_ROWS = 64                # rows with whole sets that travel in one Arrow batch
SHINGLES = 1 << 20           # shingles of a tile's whole sets (8 MB), and those looked up at once
STEP = 1 << 15               # candidate pairs between two looks at what is already found
PASSES = 2                   # residue classes of the block tokens, one after the other (bounds disk)
SKETCH = 1 << 19             # buckets that count shingles for the order (2 MB, whatever the input)
SKETCH_PART = 4096           # buckets whose counts are summed in one group
BROADCAST_IDS = 1_000_000    # most document ids that are broadcast (16 MB); more are joined by shuffle


def word_bytes() -> np.ndarray:
    """True for bytes of ``[^\\x20\\x09-\\x0D]``."""
    ok = np.ones(256, bool)
    ok[32] = ok[9] = ok[10] = ok[11] = ok[12] = ok[13] = False
    return ok


def shingle_sets(column: pa.Array, k: int) -> Iterator[tuple]:
    """(slice, row, hash, per-row counts): distinct shingles sorted by row, then hash."""
    powers, mask, codes = Powers(), word_bytes(), byte_codes(True)
    for part in text_slices(column):
        w = Words(part, mask, codes, powers)
        grams = gram_hashes(w.hashes, k)
        row = w.row[:len(grams)]
        inside = row == w.row[k - 1:] if len(grams) else np.zeros(0, bool)
        grams, row = grams[inside], row[inside]
        short = np.flatnonzero((w.counts > 0) & (w.counts < k))
        if len(short):
            extra = np.array([gram_hashes(w.hashes[w.first[r]:w.first[r] + w.counts[r]], int(w.counts[r]))[0]
                              for r in short], np.uint64)
            grams, row = np.append(grams, extra), np.append(row, short)
        order = np.lexsort((grams, row))
        grams, row = grams[order], row[order]
        if len(grams):
            new = np.append(True, (grams[1:] != grams[:-1]) | (row[1:] != row[:-1]))
            grams, row = grams[new], row[new]
        yield part, row, grams, np.bincount(row, minlength=part.rows)


def _per_row(op: np.ufunc, values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    out = np.zeros(len(counts), np.uint64)
    full = np.flatnonzero(counts)
    if len(full):
        first = np.cumsum(counts) - counts
        out[full] = op.reduceat(values, first[full])
    return out


def set_keys(grams: np.ndarray, counts: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit keys of each row's set (order-free)."""
    salt = U64(seed * 2 + 1)
    one = _per_row(np.add, splitmix(grams ^ salt), counts)
    two = _per_row(np.bitwise_xor, splitmix(grams * U64(0xA24BAED4963EE407) + salt), counts)
    n = counts.astype(np.uint64)
    return splitmix(one ^ n), splitmix(two + n)


def count_points(row: np.ndarray, grams: np.ndarray, rows: int) -> np.ndarray:
    """Counts per hash group, one row of GROUPS bytes per text; 255 stands for 255 or more."""
    group = (grams >> U64(17)).astype(np.int64) % GROUPS
    flat = np.bincount(row * GROUPS + group, minlength=rows * GROUPS)
    return np.minimum(flat, 255).astype(np.uint8).reshape(rows, GROUPS)


def fine_points(row: np.ndarray, grams: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """Counts per group with a power of two of groups, at least half the set's size."""
    groups = np.clip(1 << np.ceil(np.log2(np.maximum(counts, 2) / 2)).astype(np.int64), GROUPS, FINE_MOST)
    first = np.cumsum(groups) - groups
    place = first[row] + ((grams >> U64(17)).astype(np.int64) & (groups[row] - 1))
    flat = np.minimum(np.bincount(place, minlength=int(groups.sum())), 255).astype(np.uint8)
    return [flat[a:a + g].tobytes() for a, g in zip(first.tolist(), groups.tolist())]


def fine_bound(fine: list[bytes], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Summed minima of the fine points of pairs, the finer one folded to the coarser."""
    groups = np.array([len(f) for f in fine])
    least = np.minimum(groups[a], groups[b])
    out = np.zeros(len(a), np.int64)
    for g in np.unique(least):
        at = np.flatnonzero(least == g)
        members, code = np.unique(np.concatenate([a[at], b[at]]), return_inverse=True)
        folded = np.empty((len(members), g), np.uint16)
        for i, m in enumerate(members):
            raw = np.frombuffer(fine[m], np.uint8).astype(np.int64)
            raw[raw == 255] = 60_000                      # 255 or more: unlimited
            folded[i] = np.minimum(raw.reshape(-1, g).sum(axis=0), 60_000)
        x, y = code[:len(at)], code[len(at):]
        step = max(1, (1 << 20) // int(g))
        for s in range(0, len(at), step):
            low = np.minimum(folded[x[s:s + step]], folded[y[s:s + step]])
            total = low.sum(axis=1, dtype=np.int64)
            out[at[s:s + step]] = np.where((low >= 60_000).any(axis=1), np.int64(1) << 40, total)
    return out


def overlap_bound(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Summed coordinate minima (last axis); where both hold 255 the bound is unlimited."""
    low = np.minimum(a, b)
    total = low.sum(axis=-1, dtype=np.int64)
    return np.where((low == 255).any(axis=-1), np.int64(1) << 40, total)


def may_link(bound, na, nb, num: int, den: int):
    """Whether an overlap of at most ``bound`` can reach the threshold."""
    return np.minimum(bound, np.minimum(na, nb)) * (num + den) >= num * (na + nb)


class CountTree:
    """Points packed by size into leaves and nodes that keep coordinate maxima."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray) -> None:
        self.order = np.argsort(sizes, kind="stable")
        self.points, self.sizes = points[self.order], sizes[self.order].astype(np.int64)
        self.levels = []
        top, low, high = self.points, self.sizes, self.sizes
        while len(top) > LEAF or not self.levels:
            cut = np.arange(0, len(top), LEAF)
            top = np.maximum.reduceat(top, cut, axis=0)
            low, high = np.minimum.reduceat(low, cut), np.maximum.reduceat(high, cut)
            self.levels.append((top, low, high))

    def search(self, points: np.ndarray, sizes: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, point) whose bound reaches the threshold."""
        none = np.zeros(0, np.int64)
        found_q, found_p = zip((none, none), *self.parts(points, sizes, num, den))
        return np.concatenate(found_q), np.concatenate(found_p)

    def parts(self, points: np.ndarray, sizes: np.ndarray, num: int,
              den: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The pairs of ``search`` in parts of about PAIRS, by blocks of queries."""
        found_q, found_p, held = [], [], 0
        sizes = sizes.astype(np.int64)
        for lo in range(0, len(points), 256):
            hi = min(lo + 256, len(points))
            roots = len(self.levels[-1][0])
            q = np.repeat(np.arange(lo, hi), roots)
            node = np.tile(np.arange(roots), hi - lo)
            for depth in range(len(self.levels) - 1, -1, -1):
                q, node = self._keep(points, sizes, q, node, *self.levels[depth], num, den)
                below = len(self.levels[depth - 1][0]) if depth else len(self.points)
                q, node = np.repeat(q, LEAF), (node[:, None] * LEAF + np.arange(LEAF)).ravel()
                q, node = q[node < below], node[node < below]
            q, node = self._keep(points, sizes, q, node, self.points, self.sizes, self.sizes, num, den)
            found_q.append(q)
            found_p.append(self.order[node])
            held += len(q)
            if held >= PAIRS:
                yield np.concatenate(found_q), np.concatenate(found_p)
                found_q, found_p, held = [], [], 0
        if held:
            yield np.concatenate(found_q), np.concatenate(found_p)

    @staticmethod
    def _keep(points, sizes, q, node, top, low, high, num, den):
        na = sizes[q]
        # a partner's size lies within the threshold ratio
        ok = (low[node] * num <= den * na) & (high[node] * den >= num * na)
        q, node, na = q[ok], node[ok], na[ok]
        keep = np.zeros(len(q), bool)
        for s in range(0, len(q), 65_536):
            e = s + 65_536
            bound = overlap_bound(points[q[s:e]], top[node[s:e]])
            least = np.maximum(low[node[s:e]], -(-na[s:e] * num // den))  # of the partner's size
            keep[s:e] = np.minimum(bound, na[s:e]) * (num + den) >= num * (na[s:e] + least)
        return q[keep], node[keep]


def sketch_bucket(grams: np.ndarray) -> np.ndarray:
    """The counting bucket of each shingle (bits that no point and no pass uses)."""
    return ((grams >> U64(40)) & U64(SKETCH - 1)).astype(np.int64)


def _profile(docs: DataFrame, doc_id: str, text: str, k: int, seed: int) -> DataFrame:
    """Per text: id, set size, keys and point (kind 0); per task: parts of its sketch (kind 1)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(SKETCH, np.int64)
        for batch in batches:
            for part, row, grams, counts in shingle_sets(batch.column(1), k):
                key, guard = set_keys(grams, counts, seed)
                point = count_points(row, grams, part.rows)
                ids = batch.column(0).slice(part.lo, part.rows)
                sketch += np.bincount(sketch_bucket(grams), minlength=SKETCH)
                yield pa.RecordBatch.from_arrays([
                    ids.cast(pa.int64()), pa.array(counts.astype(np.int64)),
                    pa.array(key.view(np.int64), mask=counts == 0), pa.array(guard.view(np.int64), mask=counts == 0),
                    pa.array([p.tobytes() for p in point], pa.binary()), pa.array(np.zeros(part.rows, np.int32))],
                    names=["id", "n", "cls", "guard", "point", "kind"])
        parts = sketch.reshape(-1, SKETCH_PART)
        filled = np.flatnonzero(parts.any(axis=1))
        blank = pa.nulls(len(filled), pa.int64())
        yield pa.RecordBatch.from_arrays([
            pa.array(filled.astype(np.int64)), blank, blank, blank,
            pa.array([p.astype(np.min_scalar_type(p.max())).tobytes() for p in parts[filled]], pa.binary()),
            pa.array(np.ones(len(filled), np.int32))], names=["id", "n", "cls", "guard", "point", "kind"])
    return docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).cast("string").alias("t")) \
        .mapInArrow(run, "id long, n long, cls long, guard long, point binary, kind int")


def _shingle_counts(profile: DataFrame) -> np.ndarray:
    """The summed sketches of all tasks: how many sets hold a shingle of each bucket."""
    def total(rows: pa.Table) -> pa.Table:
        counts = np.zeros(SKETCH_PART, np.int64)
        for part in rows.column("point").to_pylist():
            counts += np.frombuffer(part, np.dtype(f"u{len(part) // SKETCH_PART}")).astype(np.int64)
        counts = np.minimum(counts, np.iinfo(np.uint32).max).astype(np.uint32)
        return pa.table({"id": rows.column("id").slice(0, 1), "counts": pa.array([counts.tobytes()], pa.binary())})

    sketch = np.zeros((SKETCH // SKETCH_PART, SKETCH_PART), np.uint32)
    parts = profile.where("kind = 1").select("id", "point").groupBy("id").applyInArrow(total, "id long, counts binary")
    for row in parts.collect():
        sketch[row["id"]] = np.frombuffer(row["counts"], np.uint32)
    return sketch.ravel()


def _prefixes(docs: DataFrame, text: str, k: int, num: int, den: int, seed: int, sketch: np.ndarray,
              turn: int) -> DataFrame:
    """(token, cls, n): the first shingles of each set, rare ones first, of one residue class."""
    sent = docs.sparkSession.sparkContext.broadcast(sketch)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = sent.value
        for batch in batches:
            for part, row, grams, counts in shingle_sets(batch.column(0), k):
                key, _ = set_keys(grams, counts, seed)
                order = np.lexsort((grams, often[sketch_bucket(grams)], row))
                grams, row = grams[order], row[order]
                place = np.arange(len(grams)) - np.repeat(np.cumsum(counts) - counts, counts)
                first = place < np.repeat(counts - -(-counts * num // den) + 1, counts)
                first &= splitmix(grams) % U64(PASSES) == U64(turn)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(grams[first].view(np.int64)), pa.array(key[row[first]].view(np.int64)),
                     pa.array(counts[row[first]].astype(np.int64))], names=["token", "cls", "n"])
    return docs.select(F.col(text).cast("string").alias("t")).mapInArrow(run, "token long, cls long, n long")


def _sized_blocks(tokens: DataFrame, num: int, den: int) -> DataFrame:
    """(token, cls, lead, last): the members of each block and its smallest and largest class.

    The classes of one token, by size, are cut wherever a size and the next are too far apart to
    link, since no linked pair lies across; each run of two classes or more is a block with a
    token of its own. Unrelated texts that share a shingle mostly end here. One exchange serves all.
    """
    by_size = Window.partitionBy("token").orderBy("n", "cls")
    block = Window.partitionBy("token", "run")
    rows = (tokens.repartition("token").distinct()
            .withColumn("joins", F.coalesce(F.lag("n").over(by_size) * den >= F.col("n") * num, F.lit(False)))
            .withColumn("joined", F.coalesce(F.col("n") * den >= F.lead("n").over(by_size) * num, F.lit(False)))
            .where("joins or joined")
            .withColumn("run", F.count_if(~F.col("joins")).over(by_size.rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("lead", F.min("cls").over(block)).withColumn("last", F.max("cls").over(block)))
    token = F.when(F.col("run") == 1, F.col("token")).otherwise(F.xxhash64("token", "run"))
    return rows.select(token.alias("token"), "cls", "lead", "last")


def _once(members: DataFrame) -> DataFrame:
    """The members of blocks; of blocks with the same members only one."""
    mixed = F.xxhash64("cls")
    blocks = (members.groupBy("token").agg(
        F.min("cls").alias("low"), F.max("cls").alias("high"), F.count("*").alias("c"),
        F.sum(mixed.bitwiseAND(F.lit(0x7FFFFFFF))).alias("s1"), F.sum(F.shiftrightunsigned(mixed, 33)).alias("s2"))
        .groupBy("low", "high", "c", "s1", "s2").agg(F.min("token").alias("token")).select("token"))
    return members.join(blocks, "token")


def _bounded_pairs(pairs: DataFrame, classes: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, b) of classes whose points' summed minima reach the threshold."""
    one = classes.select(F.col("cls").alias("a"), F.col("n").alias("na"), F.col("point").alias("pa"))
    two = classes.select(F.col("cls").alias("b"), F.col("n").alias("nb"), F.col("point").alias("pb"))
    rows = (pairs.join(one, "a").join(two, "b")
            .where(F.expr(f"nb * {num} <= na * {den} and na * {num} <= nb * {den}"))
            .select("a", "b", "na", "nb", "pa", "pb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, GROUPS)
                        for c in (4, 5))
                na, nb = (batch.column(c).to_numpy(zero_copy_only=False) for c in (2, 3))
                ok = pa.array(may_link(overlap_bound(a, b), na, nb, num, den))
                yield batch.select([0, 1]).filter(ok)
    return rows.mapInArrow(run, "a long, b long")


def _blobs(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary column without nulls and the offset of each value, not copied."""
    one = column.combine_chunks().cast(pa.large_binary())
    if isinstance(one, pa.ChunkedArray):
        one = pa.concat_arrays(one.chunks)
    _, offsets, data = one.buffers()
    return np.frombuffer(data, np.uint8), np.frombuffer(offsets, np.int64, len(one) + 1, one.offset * 8)


def shared_shingles(keys: np.ndarray, at: np.ndarray, span: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Overlaps of pairs of sets; ``keys`` holds set * span + shingle code in order, set i from ``at[i]``."""
    counts = at[a + 1] - at[a]
    first = np.cumsum(counts) - counts
    probe = keys[np.arange(counts.sum()) + np.repeat(at[a] - first, counts)] + np.repeat((b - a) * span, counts)
    place = np.minimum(np.searchsorted(keys, probe), len(keys) - 1)
    return np.add.reduceat((keys[place] == probe).astype(np.int64), first)


def _search_block(rows: dict, num: int, den: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of the pairs of one block's tile pair that may link across components, in parts."""
    comp, side, size, point = rows["comp"], rows["side"], rows["n"], rows["point"]
    left, right = side == rows["i"][0], side == rows["j"][0]
    if rows["i"][0] == rows["j"][0]:
        # members of the largest component need not ask: whoever differs asks them
        names, counts = np.unique(comp, return_counts=True)
        left = comp != names[counts.argmax()]
    elif left.sum() > right.sum():
        left, right = right, left
    asks, holds = np.flatnonzero(left), np.flatnonzero(right)
    if not len(asks) or not len(holds):
        return
    for q, p in CountTree(point[holds], size[holds]).parts(point[asks], size[asks], num, den):
        a, b = asks[q], holds[p]
        ok = comp[a] != comp[b]
        a, b = a[ok], b[ok]
        for s in range(0, len(a), STEP):
            yield a[s:s + STEP], b[s:s + STEP]


def _with_candidate(rows: dict, fine: list[bytes], num: int, den: int) -> np.ndarray:
    """Whether each member of a block's tile pair is in any candidate pair (on fine points, if there are any)."""
    some = np.zeros(len(rows["cls"]), bool)
    for a, b in _search_block(rows, num, den):
        if fine:
            ok = ~(some[a] & some[b])
            a, b = a[ok], b[ok]
            ok = may_link(fine_bound(fine, a, b), rows["n"][a], rows["n"][b], num, den)
            a, b = a[ok], b[ok]
        some[a] = some[b] = True
    return some


def _root(up: dict[int, int], comp: int) -> int:
    while comp in up:
        if up[comp] in up:
            up[comp] = up[up[comp]]
        comp = up[comp]
    return comp


def _new_links(rows: dict, grams: np.ndarray, at: np.ndarray, up: dict[int, int], num: int,
               den: int) -> tuple[list[int], list[int]]:
    """Positions of linked pairs of a block's tile pair, one for each two components that they join.

    Set i is ``grams[at[i]:at[i + 1]]``, in order. ``up`` holds the components joined so far, each
    with a smaller one; a pair whose ends are joined already is not verified.
    """
    names, comp = np.unique(rows["comp"], return_inverse=True)
    n, names = rows["n"], names.tolist()
    now = np.array([_root(up, c) for c in names])
    keys, fine, span = None, [], 0
    left, right = [], []
    for a, b in _search_block(rows, num, den):
        ok = now[comp[a]] != now[comp[b]]
        a, b = a[ok], b[ok]
        if keys is None and len(a):
            counts = np.diff(at)
            row = np.repeat(np.arange(len(counts)), counts)
            known, code = np.unique(grams, return_inverse=True)
            span = len(known)
            keys, fine = row * span + code, fine_points(row, grams, counts)
        ok = may_link(fine_bound(fine, a, b), n[a], n[b], num, den)
        a, b = a[ok], b[ok]
        part = np.cumsum(n[a]) // SHINGLES
        for s, e in zip(np.flatnonzero(np.diff(part, prepend=-1)), np.flatnonzero(np.diff(part, append=-1)) + 1):
            x, y = a[s:e], b[s:e]
            ok = now[comp[x]] != now[comp[y]]
            x, y = x[ok], y[ok]
            if not len(x):
                continue
            ok = may_link(shared_shingles(keys, at, span, x, y), n[x], n[y], num, den)
            for p, q in zip(x[ok].tolist(), y[ok].tolist()):
                one, two = _root(up, names[comp[p]]), _root(up, names[comp[q]])
                if one != two:
                    up[max(one, two)] = min(one, two)
                    left.append(p)
                    right.append(q)
            if ok.any():
                now = np.array([_root(up, c) for c in names])
    return left, right


def _spread(members: DataFrame, tile: int, shingles: int | None = None) -> DataFrame:
    """Members of blocks with several components, once per pair (i, j) of their block's tiles.

    A block of at most ``tile`` members (and ``shingles``, if given) has the one pair (0, 0);
    ``side`` is the row's tile.
    """
    tiles = F.ceil(F.col("c") / tile)
    if shingles:
        tiles = F.greatest(tiles, F.ceil(F.col("all") / shingles))
    open_blocks = (members.groupBy("token").agg(F.min("comp").alias("x"), F.max("comp").alias("y"),
                                                F.count("*").alias("c"),
                                                (F.sum("n") if shingles else F.lit(0)).alias("all"))
                   .where("x <> y").select("token", tiles.cast("int").alias("tiles")))
    return (members.join(open_blocks, "token")
            .withColumn("side", F.pmod(F.xxhash64("cls"), F.col("tiles")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
            .withColumn("i", F.least("side", "other")).withColumn("j", F.greatest("side", "other")))


def _tile_search(spread: DataFrame, num: int, den: int, value: str | None = None) -> DataFrame:
    """Tree search in each block's tile pairs.

    The result is (token, cls), the members with any candidate, bounded on points and on fine
    points if ``value`` is ``fine``; or, if it is ``set``, (a, b), links that join components. A
    tile pair lies in one partition; a task holds those that end in one batch.
    """
    names = ["token", "i", "j", "side", "cls", "comp", "n", "point", *([value] if value else [])]
    number = names[:7]
    made = ["a", "b"] if value == "set" else ["token", "cls"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        up: dict[int, int] = {}

        def blocks() -> pa.RecordBatch:
            whole = pa.Table.from_batches(held)
            held.clear()
            cols = {c: whole.column(c).to_numpy() for c in number}
            data, at = _blobs(whole.column("point"))
            cols["point"] = data[at[0]:at[-1]].reshape(-1, GROUPS)
            data, at = _blobs(whole.column(value)) if value else (data, at)
            edge = np.ones(whole.num_rows, bool)
            edge[1:] = False
            for c in names[:3]:
                edge[1:] |= cols[c][1:] != cols[c][:-1]
            edge = np.append(np.flatnonzero(edge), whole.num_rows)
            first, second = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for s, e in zip(edge[:-1], edge[1:]):
                rows = {c: v[s:e] for c, v in cols.items()}
                if value == "set":
                    sets = data[at[s]:at[e]].view(np.uint64)
                    left, right = _new_links(rows, sets, (at[s:e + 1] - at[s]) // 8, up, num, den)
                    first.append(rows["cls"][left])
                    second.append(rows["cls"][right])
                else:
                    fine = [data[at[r]:at[r + 1]] for r in range(s, e)] if value else []
                    second.append(rows["cls"][_with_candidate(rows, fine, num, den)])
                    first.append(np.full(len(second[-1]), rows["token"][0]))
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(first)), pa.array(np.concatenate(second))],
                                              names=made)

        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([batch.column(c).to_numpy() for c in range(3)], axis=1)
            change = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
            if held:
                before = [held[-1].column(c)[held[-1].num_rows - 1].as_py() for c in range(3)]
                if before != key[0].tolist():
                    change = np.append(0, change)
            if len(change):  # all but the last block are complete
                if change[-1]:
                    held.append(batch.slice(0, change[-1]))
                yield blocks()
                held.append(batch.slice(change[-1]))
            else:
                held.append(batch)
        if held:
            yield blocks()

    rows = spread.select(*names).repartition("token", "i", "j").sortWithinPartitions("token", "i", "j")
    return rows.mapInArrow(run, ", ".join(f"{c} long" for c in made)).distinct()


def _scan_classes(wanted: DataFrame, docs: DataFrame, doc_id: str, text: str, classes: DataFrame, k: int,
                  seed: int, scratch: Scratch, what: str) -> DataFrame:
    """(cls, value) of the wanted classes, from the text of their smallest id.

    ``what`` is ``grams`` (the whole set), ``set`` (its bytes, in order) or ``fine`` (its fine point).
    The ids are broadcast while there are at most BROADCAST_IDS of them, else joined by shuffle.
    """
    ids = scratch.keep(wanted.select("cls").distinct().join(classes.select("cls", "rep"), "cls")
                       .select(F.col("rep").alias("__rep"), F.col("cls").alias("__cls")), "wanted")
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    texts = (docs.select(F.col(doc_id).cast("long").alias("__rep"), F.col(text).cast("string").alias("t"))
             .join(ids, "__rep").select("__cls", "t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            want = batch.column(0).to_numpy()
            for part, row, grams, counts in shingle_sets(batch.column(1), k):
                key, _ = set_keys(grams, counts, seed)
                if what == "grams":
                    offsets = np.append(0, np.cumsum(counts)).astype(np.int32)
                    value = pa.ListArray.from_arrays(pa.array(offsets), pa.array(grams.view(np.int64)))
                elif what == "set":
                    cuts = np.append(0, np.cumsum(counts)) * 8
                    raw = grams.tobytes()
                    value = pa.array([raw[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())], pa.binary())
                else:
                    value = pa.array(fine_points(row, grams, counts), pa.binary())
                cls = key.view(np.int64)
                ok = pa.array(cls == want[part.lo:part.hi])  # an id may be shared by different texts
                yield pa.RecordBatch.from_arrays([pa.array(cls), value], names=["cls", "value"]).filter(ok)
    kind = "array<long>" if what == "grams" else "binary"
    return scratch.keep(texts.mapInArrow(run, f"cls long, value {kind}").dropDuplicates(["cls"]), what)


def _fine_pairs(pairs: DataFrame, docs: DataFrame, doc_id: str, text: str, classes: DataFrame,
                k: int, num: int, den: int, seed: int, scratch: Scratch) -> DataFrame:
    """The pairs whose fine points reach the threshold; points of large sets say little, whole sets take most bytes."""
    ends = pairs.select(F.col("a").alias("cls")).union(pairs.select(F.col("b").alias("cls")))
    fine = _scan_classes(ends, docs, doc_id, text, classes, k, seed, scratch, "fine").join(classes.select("cls", "n"), "cls")
    rows = (pairs.join(fine.select(F.col("cls").alias("a"), F.col("n").alias("na"), F.col("value").alias("x")), "a")
            .join(fine.select(F.col("cls").alias("b"), F.col("n").alias("nb"), F.col("value").alias("y")), "b")
            .select("a", "b", "na", "nb", "x", "y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                at = np.arange(batch.num_rows)
                bound = fine_bound(batch.column(4).to_pylist() + batch.column(5).to_pylist(), at, at + len(at))
                na, nb = (batch.column(c).to_numpy(zero_copy_only=False) for c in (2, 3))
                yield batch.select([0, 1]).filter(pa.array(may_link(bound, na, nb, num, den)))
    with batch_rows(docs.sparkSession, FINE_ROWS):
        return scratch.keep(rows.mapInArrow(run, "a long, b long"), "near")


def _verified(pairs: DataFrame, docs: DataFrame, doc_id: str, text: str, classes: DataFrame,
              k: int, num: int, den: int, seed: int, scratch: Scratch) -> DataFrame:
    """The pairs whose whole sets reach the threshold."""
    ends = pairs.select(F.col("a").alias("cls")).union(pairs.select(F.col("b").alias("cls")))
    sets = _scan_classes(ends, docs, doc_id, text, classes, k, seed, scratch, "grams")
    both = (pairs.join(sets.select(F.col("cls").alias("a"), F.col("value").alias("x")), "a")
            .join(sets.select(F.col("cls").alias("b"), F.col("value").alias("y")), "b"))
    common = F.size(F.array_intersect("x", "y")).cast("long")
    links = scratch.keep(
        both.where(common * (num + den) >= (F.size("x") + F.size("y")).cast("long") * num).select("a", "b"), "links")
    scratch.drop(sets)
    return links


def jaccard_components(docs: DataFrame, doc_id: str, text: str, k: int = 5, num: int = 80,
                       den: int = 100, seed: int = 0, tile: int = TILE) -> DataFrame:
    """One row per document: ``id``, ``n_shingles``, ``cls`` (equal sets share it) and
    ``component_id``, the smallest id reachable by links (its own id if it has none)."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "ngram-join")
    profile = scratch.keep(_profile(docs, doc_id, text, k, seed), "profile")
    rows = profile.where("kind = 0")
    classes = scratch.keep(rows.where("cls is not null").groupBy("cls").agg(
        F.min("id").alias("rep"), F.max("n").alias("n"), F.max("point").alias("point"),
        (F.min("guard") != F.max("guard")).alias("mixed")), "classes")
    if classes.where("mixed").limit(1).count():
        raise ValueError("two different sets share a key: choose another seed")
    sketch = _shingle_counts(profile)

    parts = []
    for turn in range(PASSES):
        parts.append(scratch.keep(_sized_blocks(_prefixes(docs, text, k, num, den, seed, sketch, turn), num, den), "found"))
    found = parts[0]
    for more in parts[1:]:
        found = found.union(more)
    members = scratch.keep(_once(found), "members")  # token, cls, lead, last
    scratch.drop(*parts)

    stars = (members.select(F.col("cls").alias("a"), F.col("lead").alias("b"))
             .union(members.select(F.col("last").alias("a"), F.col("cls").alias("b")))
             .where("a <> b").distinct())
    tried = scratch.keep(_bounded_pairs(stars, classes, num, den), "stars")
    hopeful = _fine_pairs(tried, docs, doc_id, text, classes, k, num, den, seed, scratch)
    links = _verified(hopeful, docs, doc_id, text, classes, k, num, den, seed, scratch)
    roots = scratch.keep(connected_components(links), "roots")

    labelled = (members.where("cls <> lead and cls <> last")                 # the stars decided on these
                .join(roots.withColumnRenamed("node", "cls"), "cls", "left")
                .select("token", "cls", F.coalesce("root", "cls").alias("comp")))
    points = classes.select("cls", "n", "point")
    opened = _spread(labelled, tile).join(points, "cls")
    asked = scratch.keep(_once(_tile_search(opened, num, den)), "asked")
    fine = _scan_classes(asked, docs, doc_id, text, classes, k, seed, scratch, "fine")
    near = (_spread(labelled.join(asked, ["token", "cls"]), tile).join(points, "cls")
            .join(fine.withColumnRenamed("value", "fine"), "cls"))
    with batch_rows(spark, FINE_ROWS):
        close = scratch.keep(_once(_tile_search(near, num, den, "fine")), "close")
    scratch.drop(asked, fine)
    sets = _scan_classes(close, docs, doc_id, text, classes, k, seed, scratch, "set")
    last = (_spread(labelled.join(close, ["token", "cls"]).join(points, "cls"), tile, SHINGLES)
            .join(sets.withColumnRenamed("value", "set"), "cls"))
    with batch_rows(spark, SET_ROWS):
        more = scratch.keep(_tile_search(last, num, den, "set"), "more")
    scratch.drop(close, sets, members)
    if more.limit(1).count():
        roots = connected_components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(more))
    named = (classes.select("cls", "rep").join(roots.withColumnRenamed("node", "cls"), "cls")
             .groupBy("root").agg(F.min("rep").alias("low")))
    label = roots.join(named, "root").select(F.col("node").alias("cls"), "low")
    own = classes.select("cls", "rep")
    return (rows.join(own, "cls", "left").join(label, "cls", "left")
            .select("id", F.col("n").alias("n_shingles"), "cls",
                    F.coalesce("low", "rep", "id").alias("component_id")))


def keep_one_per_component(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = 5,
                           num: int = 80, den: int = 100) -> DataFrame:
    """Documents that are their component's smallest id, columns unchanged.

    Rows that repeat an id are kept together; rows with a null id stay.
    """
    name = fresh("keep")
    found = jaccard_components(docs, doc_id, text, k, num, den)
    lose = (found.where("id is not null").groupBy(F.col("id").alias(name))
            .agg(F.min(F.col("component_id") == F.col("id")).alias("__stay")).where("not __stay").select(name))
    return docs.join(lose, F.col(doc_id).cast("long") == F.col(name), "left_anti")


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of 3-word shingle sets at a Jaccard similarity of 0.9 or more."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = jaccard_components(docs, "doc_id", "text", k=3, num=90, den=100)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")
