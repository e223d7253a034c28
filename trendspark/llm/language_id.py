"""Language identification with bit-sliced Bloom filters over byte n-grams.

*Grams.* Lower-cased texts are byte streams in which every ASCII non-letter is a space;
a gram is ``n`` bytes (``n`` in ``SIZES``) whose inner bytes are letters, so only its
first or last byte may be a space.

*Filter.* One array of language bitmasks: a gram of a language sets the language's bit in
``HASHES`` slots, and the AND of a gram's slots returns all languages that contain it in
one look-up. A language contains every gram that is at least ``SHARE`` times as frequent in it
as in the language where the gram is most frequent (counted over every learning text), however
rare. The tasks set the bits; the driver receives the finished filter in pages. It has at least
``ROOM`` slots per gram of the richest language, up to ``2 ** MOST_BITS`` slots (128 MB a mask
word): beyond that no gram is left out, but the fill and with it the corrected rate rise.

*Decision.* Per language, the popcount of its bit over the grams of a text is corrected
for false positives: with fill ``f`` a foreign gram matches with probability
``f ** HASHES``, so ``(c - n p) / (1 - p)`` grams are expected to be true ones. The
largest wins; ties go to the language with more learning grams, then by name.

Defined cases: null texts and texts without a letter give ``und`` and score 0; texts
without a known gram give the language with most learning grams and score 0; without
learning rows every text is ``und``; rows with a null id are held out. Any number of languages
fits (64 to a mask word).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendspark.llm.common import Scratch, fresh, held_out, map_batches, own_columns, table
from trendspark.llm.textscan import U64, Powers, Rolling, byte_codes, splitmix, text_slices

SIZES = (3, 4)
HASHES = 4
ROOM = 16
LEAST_BITS, MOST_BITS = 16, 24
PAGE_BITS = 12             # slots of a page of the filter on its way to the driver
SLICE_BYTES = 256 << 10    # a dozen 8-byte arrays hold a slice
SHARE = 0.25


def _letters() -> np.ndarray:
    ok = np.zeros(256, bool)
    ok[65:91] = ok[97:123] = ok[128:] = True
    return ok


def _grams(column: pa.Array) -> Iterator[tuple]:
    """(slice, row, gram hash) for the grams of bounded slices of a text column."""
    powers, codes, letter = Powers(), byte_codes(True), _letters()
    codes[~letter] = codes[32]
    for part in text_slices(column, SLICE_BYTES):
        roll = Rolling(part.data, codes, powers)
        row = np.repeat(np.arange(part.rows), np.diff(part.offsets))
        inside = np.append(0, np.cumsum(letter[part.data]))
        rows, grams = [], []
        for n in SIZES:
            if len(row) < n:
                continue
            hashes = roll.all(n)
            m = len(hashes)
            inner = inside[n - 1:n - 1 + m] - inside[1:1 + m]
            ok = np.flatnonzero((inner == n - 2) & (row[:m] == row[n - 1:]))
            rows.append(row[ok])
            grams.append(splitmix(hashes[ok] ^ U64(n)))
        yield (part, np.concatenate(rows) if rows else np.zeros(0, np.int64),
               np.concatenate(grams) if grams else np.zeros(0, np.uint64))


def _padded(text: str) -> F.Column:
    return F.concat(F.lit(" "), F.lower(F.col(text).cast("string")), F.lit(" "))


def gram_counts(rows: DataFrame, lang: str, text: str) -> DataFrame:
    """(lang, gram, c): counts over all rows, combined in the task before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, codes = np.unique(batch.column(0).to_numpy(zero_copy_only=False).astype(str), return_inverse=True)
            for part, row, grams in _grams(batch.column(1)):
                own = codes[part.lo:part.hi][row]
                for k, name in enumerate(names):
                    values, seen = np.unique(grams[own == k], return_counts=True)
                    if len(values):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([name] * len(values)), pa.array(values.view(np.int64)),
                             pa.array(seen.astype(np.int64))], names=["lang", "gram", "c"])
    found = rows.select(F.col(lang).cast("string").alias("l"), _padded(text).alias("t")) \
        .mapInArrow(run, "lang string, gram long, c long")
    return found.groupBy("lang", "gram").agg(F.sum("c").alias("c"))


def learn_filter(rows: DataFrame, lang: str, text: str, share: float = SHARE) -> dict:
    """The filter and its false-positive rates, learned from all ``rows``."""
    rows = rows.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    scratch = Scratch(rows.sparkSession, "language")
    counts = scratch.keep(gram_counts(rows, lang, text), "grams")
    totals = counts.groupBy("lang").agg(F.sum("c").alias("n"), F.count("*").alias("kinds")).collect()
    sizes = {r["lang"]: r["n"] for r in totals}
    bits = int(np.ceil(np.log2(ROOM * max((r["kinds"] for r in totals), default=1))))
    bits = min(max(bits, LEAST_BITS), MOST_BITS)
    langs = sorted(sizes)
    slots = np.zeros((1 << bits, max(1, -(-len(langs) // 64))), np.uint64)
    for page, word, masks in filter_pages(counts, langs, sizes, share, bits).collect():
        slots[page << PAGE_BITS:(page + 1) << PAGE_BITS, word] = np.frombuffer(bytes(masks), np.uint64)
    scratch.drop(counts)
    fill = np.array([((slots[:, k // 64] >> U64(k % 64)) & U64(1)).mean() for k in range(len(langs))])
    order = sorted(range(len(langs)), key=lambda k: (-sizes[langs[k]], langs[k]))
    return {"langs": langs, "bits": bits, "slots": slots, "false": fill ** HASHES, "order": np.array(order, np.int64)}


def filter_pages(counts: DataFrame, langs: list[str], sizes: dict[str, int], share: float, bits: int) -> DataFrame:
    """(page, word, masks): the filter of the counted grams, ``2 ** PAGE_BITS`` mask words to a row."""
    number = {name: k for k, name in enumerate(langs)}
    rate = 1 / np.array([sizes[name] for name in langs], float)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            ends = np.cumsum(np.diff(lists.offsets.to_numpy()))
            flat = lists.flatten()
            if not len(flat):
                continue
            k = np.array([number[name] for name in flat.field("lang").to_pylist()])
            rates = flat.field("c").to_numpy() * rate[k]
            begin = np.append(0, ends[:-1])
            own = np.repeat(np.arange(len(ends)), ends - begin)
            has = rates >= share * np.maximum.reduceat(rates, begin)[own]
            grams = batch.column(0).to_numpy().view(np.uint64)
            for word in np.unique(k // 64):
                mine = np.flatnonzero(has & (k // 64 == word))
                masks = np.zeros(len(grams), np.uint64)
                np.bitwise_or.at(masks, own[mine], U64(1) << (k[mine] % 64).astype(np.uint64))
                some = np.flatnonzero(masks)
                for at in slot_places(grams[some], bits):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(at), pa.array(np.full(len(at), word, np.int32)), pa.array(masks[some].view(np.int64))],
                        names=["slot", "word", "mask"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for entries in batch.column(2):
                page = np.zeros(1 << PAGE_BITS, np.int64)
                page[entries.values.field("at").to_numpy()] = entries.values.field("mask").to_numpy()
                made.append(page.tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(made, pa.binary())], names=["page", "word", "masks"])
    marked = (counts.groupBy("gram").agg(F.collect_list(F.struct("lang", "c")).alias("found"))
              .mapInArrow(mark, "slot long, word int, mask long")
              .groupBy("slot", "word").agg(F.bit_or("mask").alias("mask")))
    return (marked.groupBy(F.shiftright("slot", PAGE_BITS).alias("page"), "word")
            .agg(F.collect_list(F.struct(F.col("slot").bitwiseAND((1 << PAGE_BITS) - 1).alias("at"), "mask")).alias("entries"))
            .mapInArrow(pack, "page long, word int, masks binary"))


def slot_places(grams: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    for j in range(HASHES):
        yield (splitmix(grams + U64(j * 0x9E37)) >> U64(64 - bits)).astype(np.int64)


def language_masks(model: dict, grams: np.ndarray) -> np.ndarray:
    """All languages that contain each gram, as mask words."""
    masks = np.full((len(grams), model["slots"].shape[1]), ~U64(0))
    for at in slot_places(grams, model["bits"]):
        masks &= model["slots"][at]
    return masks


def decide(model: dict, row: np.ndarray, grams: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(language number, score) of each row from corrected popcounts; -1 without a model."""
    langs = len(model["langs"])
    if not langs:
        return np.full(rows, -1), np.zeros(rows)
    n = np.bincount(row, minlength=rows).astype(float)
    masks = language_masks(model, grams)
    true = np.zeros((rows, langs))
    for k in range(langs):
        bit = ((masks[:, k // 64] >> U64(k % 64)) & U64(1)).astype(float)
        c = np.bincount(row, weights=bit, minlength=rows)
        p = min(model["false"][k], 0.999)
        true[:, k] = np.clip((c - n * p) / (1 - p), 0, None)
    order = model["order"]
    best = order[true[:, order].argmax(axis=1)]
    top = true[np.arange(rows), best]
    return best, np.clip(np.divide(top, n, out=np.zeros(rows), where=n > 0), 0, 1)


def identify(docs: DataFrame, model: dict, text: str, out: str) -> DataFrame:
    """``docs`` with a struct column ``out``: lang (``und`` without a letter) and score."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    padded, letter = fresh("t"), fresh("letter")
    ready = docs.withColumn(padded, _padded(text)).withColumn(letter, F.col(text).cast("string").rlike(r"\p{L}"))
    kind = T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = sent.value
        labels = np.array([*filters["langs"], "und"], object)
        for batch in batches:
            best, score = [np.zeros(0, np.int64)], [np.zeros(0)]
            for part, row, grams in _grams(batch.column(batch.num_columns - 2)):
                b, s = decide(filters, row, grams, part.rows)
                best.append(b)
                score.append(s)
            has = batch.column(batch.num_columns - 1).fill_null(False).to_numpy(zero_copy_only=False)
            which = np.where(has, np.concatenate(best), -1)
            made = pa.StructArray.from_arrays(
                [pa.array(labels[which].tolist(), pa.string()), pa.array(np.where(which >= 0, np.concatenate(score), 0.0))],
                names=["lang", "score"])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], made], names=[*names, out])
    return map_batches(ready, run, T.StructType([*docs.schema.fields, T.StructField(out, kind)]))


def identify_languages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
                       out: str = "language") -> DataFrame:
    """Learn from the rows that are not held out, then label every row."""
    learn = docs.where(~held_out(doc_id)).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    return identify(docs, learn_filter(learn, "lang", "text"), text, out)


def drop_undetermined(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The documents in some learned language, columns unchanged; ``und`` is rejected."""
    tag = fresh("lang")
    return identify_languages(docs, doc_id, text, lang, tag).where(F.col(f"{tag}.lang") != "und").select(*own_columns(docs))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every whole document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = identify_languages(docs)
    return found.select("doc_id", held_out("doc_id").alias("held_out"),
                        F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score"))
