"""Benchmark decontamination by an FM-index of each training shard.

Documents are cut into shards of about a million words. A shard's index is a row of
binary columns: its sorted vocabulary (64-bit word hashes), the Burrows-Wheeler
transform of its words as a wavelet matrix, and every 32nd suffix position. It does not
depend on what is searched, is written once, and serves any number of phrase blocks.

Test items become windows of ``window`` words; an item of fewer words is one window. All
windows of a block are searched backwards together, a word a step; occurrences are
located by walking to the nearest sampled position; overlapping ones merge to spans.

A word is a run of letters and digits after A-Z are lower-cased: all characters but the
ASCII ones that are neither. Equal words are told by a 64-bit hash.

Defined results: a null or empty text, or one without words, has no words and no spans;
such an item has no windows. Repeated documents each get their row; texts of equal words are
indexed once a shard. Texts longer than a shard are indexed in pieces that overlap by a
window less one word, so no occurrence is lost. Items of equal id count once; an item
without id marks words but is not listed. Empty tables give no rows, or rows without spans.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from syncflow.staging import Staging

WINDOW = 10
#: Words and separators of a shard; rows of a shard (copies share their words).
SHARD_WORDS = 1 << 20
SHARD_ROWS = 1 << 17
#: Every so many positions one is kept.
SAMPLE_STEP = 32
#: Words of test items that are searched at a time; the block is broadcast.
BLOCK_WORDS = 1 << 19
#: Words of an item in one row.
PIECE_WORDS = 4096

_IS_WORD = np.zeros(256, bool)
_IS_WORD[ord("0") : ord("9") + 1] = _IS_WORD[ord("a") : ord("z") + 1] = _IS_WORD[128:] = True
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_VALUES = np.random.default_rng(20).integers(1, 1 << 63, 256, np.uint64)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Bytes that are hashed at a time, and bytes of texts that are taken from a batch.
_SLICE, _BATCH = 1 << 16, 1 << 22


def _powers(base: int, n: int) -> np.ndarray:
    factors = np.full(n, base & (2**64 - 1), np.uint64)
    factors[0] = 1
    return np.cumprod(factors, dtype=np.uint64)


_POWERS: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    if len(_POWERS.get(base, ())) < n:
        _POWERS[base] = _powers(base, max(n, 2 * _SLICE))
    return _POWERS[base][:n]


def _slice_words(part: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(_IS_WORD[part].view(np.int8), prepend=0, append=0))
    starts, ends = edge[::2], edge[1::2]
    total = np.zeros(len(part) + 1, np.uint64)
    np.cumsum(_VALUES[part] * _power(_BASE, len(part)), out=total[1:])
    # Divided by the power at its start, a word's sum does not depend on its place.
    found = (total[ends] - total[starts]) * _power(_INVERSE, len(part) + 1)[starts]
    return starts, ends, (found ^ (found >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def words_in(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts, byte ends and hashes of the words of UTF-8 text, in slices."""
    buffer = np.frombuffer(data.translate(_LOWER), np.uint8)
    parts, at = [], 0
    while at < len(buffer):
        end = min(at + _SLICE, len(buffer))
        while end < len(buffer) and _IS_WORD[buffer[end]] and _IS_WORD[buffer[end - 1]]:
            end += 1
        starts, ends, found = _slice_words(buffer[at:end])
        parts.append((starts + at, ends + at, found))
        at = end
    if not parts:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64)
    return tuple(np.concatenate(p) for p in zip(*parts))


def texts_words(texts: list[bytes]) -> list[np.ndarray]:
    """Word hashes of each text."""
    starts, _, found = words_in(b"\n".join(texts))
    cuts = np.cumsum([len(t) + 1 for t in texts])[:-1]
    return np.split(found, np.searchsorted(starts, cuts))


# -- index of one shard -------------------------------------------------------------


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Order of all suffixes; the last symbol occurs nowhere else.

    Suffixes are sorted by a few packed symbols, then ties by the ranks of what follows,
    in steps that double. Ranks are first places, so sorted groups stay in place.
    """
    n = len(symbols)
    bits = max(1, int(symbols.max()).bit_length())
    step = max(1, 62 // bits)
    padded = np.concatenate((symbols, np.zeros(step, np.int64)))
    key = np.zeros(n, np.int64)
    for i in range(step):
        key = (key << bits) | padded[i : i + n]
    order = np.argsort(key)
    places, rank = np.arange(n), np.empty(n, np.int64)
    key = key[order]
    while True:
        new = np.concatenate(([True], key[1:] != key[:-1]))
        rank[order[places]] = np.maximum.accumulate(np.where(new, places, 0))
        tied = ~(new & np.concatenate((new[1:], [True])))
        places = places[tied]
        if not len(places):
            return order
        held = order[places]
        key = rank[held] * n + rank[held + step]
        sort = np.argsort(key)
        order[places], key = held[sort], key[sort]
        step *= 2


def _bits(flags: np.ndarray) -> bytes:
    packed = np.packbits(flags, bitorder="little")
    return packed.tobytes() + bytes(16 - len(packed) % 8)


def index_texts(texts: list[np.ndarray]) -> dict:
    """The index of texts given as word hashes."""
    k = len(texts)
    sizes = np.array([len(t) + 1 for t in texts])
    starts = np.cumsum(sizes) - sizes
    codes, found = pd.factorize(np.concatenate(texts))
    by_hash = np.argsort(found)
    code = np.empty(len(found), np.int64)
    code[by_hash] = np.arange(len(found))
    n = int(sizes.sum())
    ends = starts + sizes - 1
    is_word = np.ones(n, bool)
    is_word[ends] = False
    symbols = np.empty(n, np.int64)
    symbols[is_word] = code[codes] + k
    symbols[ends] = np.arange(k)
    order = suffix_array(symbols)
    # In the transform all separators are 0.
    symbols = np.where(is_word, symbols - (k - 1), 0).astype(np.uint32)
    before = symbols[order - 1]
    marked = (order % SAMPLE_STEP == 0) | (before == 0)
    out = {
        "n": n,
        "starts": starts.tobytes(),
        "vocabulary": found[by_hash].tobytes(),
        "counts": np.bincount(before, minlength=len(found) + 1).tobytes(),
        "marks": _bits(marked),
        "samples": order[marked].astype(np.int32).tobytes(),
        "levels": [],
    }
    for level in reversed(range(max(1, len(found).bit_length()))):
        bit = (before >> np.uint32(level)) & np.uint32(1) == 1
        out["levels"].append(_bits(bit))
        before = np.concatenate((before[~bit], before[bit]))
    return out


class _Bits:
    """Bits with ranks: how many are set before a place."""

    def __init__(self, data: bytes):
        self.words = np.frombuffer(data, np.uint64)
        self.before = np.zeros(len(self.words), np.int64)
        np.cumsum(np.bitwise_count(self.words[:-1]), out=self.before[1:])

    def rank(self, at: np.ndarray) -> np.ndarray:
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        low = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.before[word] + np.bitwise_count(low)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1


class ShardIndex:
    """Backward search and locating in one index."""

    def __init__(self, row: dict):
        self.n = row["n"]
        self.starts = np.frombuffer(row["starts"], np.int64)
        self.vocabulary = np.frombuffer(row["vocabulary"], np.uint64)
        counts = np.frombuffer(row["counts"], np.int64)
        self.levels = [_Bits(data) for data in row["levels"]]
        self.marks = _Bits(row["marks"])
        self.samples = np.frombuffer(row["samples"], np.int32)
        self.zeros = []
        for level in self.levels:
            self.zeros.append(self.n - int(level.rank(np.array([self.n]))[0]))
        # Words sort behind all separators; at the end of the matrix symbols stand in
        # the order of their reversed bits. The difference leads from one to the other.
        symbols = np.arange(len(counts))
        reverse = np.zeros(len(counts), np.int64)
        for level in range(len(self.levels)):
            reverse = (reverse << 1) | ((symbols >> level) & 1)
        order = np.argsort(reverse)
        last = np.empty(len(counts), np.int64)
        last[order] = np.cumsum(counts[order]) - counts[order]
        self.shift = np.cumsum(counts) - counts - last

    def _step(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Places of the suffixes that ``symbol`` extends, from ranks of the matrix."""
        place = at
        for i, (level, zeros) in enumerate(zip(self.levels, self.zeros)):
            ones = level.rank(place)
            bit = (symbol >> (len(self.levels) - 1 - i)) & 1 == 1
            place = np.where(bit, zeros + ones, place - ones)
        return place + self.shift[symbol]

    def _back(self, at: np.ndarray) -> np.ndarray:
        """Places of the suffixes that begin a word earlier."""
        symbol = np.zeros(len(at), np.int64)
        place = at
        for level, zeros in zip(self.levels, self.zeros):
            bit, ones = level.get(place), level.rank(place)
            symbol = (symbol << 1) | bit
            place = np.where(bit, zeros + ones, place - ones)
        return place + self.shift[symbol]

    def search(self, words: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
        """(phrase, from, to) of the phrases that occur; rows of ``words`` end at the right."""
        if not len(self.vocabulary) or not len(words):
            return (np.zeros(0, np.int64),) * 3
        code = np.minimum(np.searchsorted(self.vocabulary, words), len(self.vocabulary) - 1)
        known = self.vocabulary[code] == words
        used = np.arange(words.shape[1]) >= words.shape[1] - sizes[:, None]
        phrase = np.flatnonzero((known | ~used).all(axis=1))
        code, left = code[phrase] + 1, sizes[phrase]
        low, high = np.zeros(len(phrase), np.int64), np.full(len(phrase), self.n)
        for step in range(words.shape[1]):
            on = left > step
            symbol = code[on, words.shape[1] - 1 - step]
            low[on], high[on] = self._step(symbol, low[on]), self._step(symbol, high[on])
            here = low < high
            phrase, code, left, low, high = (x[here] for x in (phrase, code, left, low, high))
        return phrase, low, high

    def locate(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Positions of all suffixes from ``low`` to ``high``, one range after the other."""
        size = high - low
        at = np.repeat(high - np.cumsum(size), size) + np.arange(size.sum())
        found, open_, steps = np.empty(len(at), np.int64), np.arange(len(at)), 0
        while len(open_):
            known = self.marks.get(at)
            found[open_[known]] = self.samples[self.marks.rank(at[known])] + steps
            open_, at = open_[~known], at[~known]
            at, steps = self._back(at), steps + 1
        return found


# -- shards -------------------------------------------------------------------------

_INDEX = (
    "row_nos array<long>, row_texts array<int>, row_words array<long>, row_offsets array<long>,"
    " n long, starts binary, vocabulary binary, counts binary, marks binary, samples binary,"
    " levels array<binary>"
)


class _Shard:
    """Rows and distinct texts of the shard that is being filled."""

    def __init__(self):
        self.rows: list[tuple] = []
        self.texts: list[np.ndarray] = []
        self.known: dict[bytes, int] = {}
        self.size = 0

    def add(self, number: int, ident, words: np.ndarray, n_words: int, offset: int) -> None:
        key = words.tobytes()
        if key not in self.known:
            self.known[key] = len(self.texts)
            self.texts.append(words)
            self.size += len(words) + 1
        self.rows.append((number, ident, self.known[key], n_words, offset))

    def record(self, schema: pa.Schema) -> pa.RecordBatch:
        numbers, idents, texts, words, offsets = zip(*self.rows)
        row = {
            "ids": list(idents),
            "row_nos": list(numbers),
            "row_texts": list(texts),
            "row_words": list(words),
            "row_offsets": list(offsets),
            **index_texts(self.texts),
        }
        return pa.RecordBatch.from_pylist([row], schema=schema)


def _fields(id_type: T.DataType) -> T.StructType:
    return T.StructType([T.StructField("ids", T.ArrayType(id_type)), *T.StructType.fromDDL(_INDEX)])


def index_shards(
    docs: DataFrame, ident: Column, text: Column, window: int, shard_words: int
) -> DataFrame:
    """A row for each shard: its documents and its index."""
    rows = docs.select(ident.alias("id"), text.cast("binary").alias("text"))
    schema = _fields(rows.schema["id"].dataType)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        number, shard = TaskContext.get().partitionId() << 36, _Shard()
        step = shard_words - (window - 1)
        for batch in batches:
            idents, texts = batch.column(0), batch.column(1)
            at = 0
            while at < batch.num_rows:
                part, size = [], 0
                while at + len(part) < batch.num_rows and (not part or size < _BATCH):
                    part.append(texts[at + len(part)].as_py() or b"")
                    size += len(part[-1])
                for ident, words in zip(idents.slice(at, len(part)).to_pylist(), texts_words(part)):
                    for offset in range(0, max(1, len(words) - window + 1), step):
                        piece = words[offset : offset + shard_words]
                        if shard.rows and (
                            shard.size + len(piece) >= shard_words or len(shard.rows) >= SHARD_ROWS
                        ):
                            yield shard.record(arrow)
                            shard = _Shard()
                        shard.add(number, ident, piece, len(words), offset)
                    number += 1
                at += len(part)
        if shard.rows:
            yield shard.record(arrow)

    return rows.mapInArrow(build, schema)


def _item_pieces(window: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, pieces = [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = words_in(text or b"")[2].view(np.int64)
                for at in range(0, max(min(len(words), 1), len(words) - window + 1), PIECE_WORDS):
                    items.append(item)
                    pieces.append(words[at : at + PIECE_WORDS + window - 1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(items, pa.string()), pa.array(pieces, pa.list_(pa.int64()))],
                names=["item", "words"],
            )

    return cut


class Phrases:
    """The distinct windows of a block of items, and the items of each window."""

    def __init__(self, rows: list[tuple], window: int):
        self.items = sorted({item for item, _ in rows if item is not None})
        number = {item: i for i, item in enumerate(self.items)}
        parts, owners = [np.zeros((0, window), np.uint64)], []
        for item, words in rows:
            words = np.array(words, np.int64).view(np.uint64)
            if len(words) < window:
                line = np.zeros((1, window), np.uint64)
                line[0, window - len(words) :] = words
                sizes = len(words)
            else:
                line, sizes = np.lib.stride_tricks.sliding_window_view(words, window), window
            parts.append(line)
            owners += [(sizes, number.get(item, -1))] * len(line)
        words = np.concatenate(parts)
        held = np.array(owners, np.int64).reshape(-1, 2)
        rows_ = np.column_stack((words, held[:, 0].astype(np.uint64)))
        distinct, of = np.unique(rows_, axis=0, return_inverse=True)
        self.words = np.ascontiguousarray(distinct[:, :window])
        self.sizes = distinct[:, window].astype(np.int64)
        pairs = np.unique(np.column_stack((of.ravel(), held[:, 1])), axis=0)
        self.owners = pairs[pairs[:, 1] >= 0]
        self.first = np.searchsorted(self.owners[:, 0], np.arange(len(distinct) + 1))


def hits_of(index: ShardIndex, phrases: Phrases) -> dict[int, tuple]:
    """By text: starts and ends of merged spans, and numbers of items."""
    phrase, low, high = index.search(phrases.words, phrases.sizes)
    place = index.locate(low, high)
    phrase = np.repeat(phrase, high - low)
    if not len(place):
        return {}
    order = np.argsort(place, kind="stable")
    place, phrase = place[order], phrase[order]
    text = np.searchsorted(index.starts, place, "right") - 1
    reach = np.maximum.accumulate(place + phrases.sizes[phrase])
    new = np.concatenate(([True], place[1:] > reach[:-1]))
    begin, end = place[new], reach[np.concatenate((np.flatnonzero(new)[1:] - 1, [-1]))]
    of, base = text[new], index.starts
    pairs = np.unique(np.column_stack((text, phrase)), axis=0)
    counts = phrases.first[pairs[:, 1] + 1] - phrases.first[pairs[:, 1]]
    spots = np.repeat(phrases.first[pairs[:, 1]] - np.cumsum(counts) + counts, counts)
    owners = phrases.owners[spots + np.arange(len(spots)), 1]
    told = np.unique(np.column_stack((np.repeat(pairs[:, 0], counts), owners)), axis=0)
    out = {}
    for t in np.unique(of):
        a, b = np.searchsorted(of, [t, t + 1])
        c, d = np.searchsorted(told[:, 0], [t, t + 1])
        out[int(t)] = (begin[a:b] - base[t], end[a:b] - base[t], told[c:d, 1])
    return out


_HITS = "row_no long, begins array<long>, ends array<long>, items array<string>"


def _searched(phrases):
    """``phrases`` is a broadcast block."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = phrases.value
        for batch in batches:
            for row in batch.to_pylist():
                found = hits_of(ShardIndex(row), block)
                texts = row["row_texts"]
                hit = [i for i, t in enumerate(texts) if t in found]
                parts = [found[texts[i]] for i in hit]
                far = [row["row_offsets"][i] for i in hit]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["row_nos"][i] for i in hit], pa.int64()),
                        pa.array([p[0] + o for p, o in zip(parts, far)], pa.list_(pa.int64())),
                        pa.array([p[1] + o for p, o in zip(parts, far)], pa.list_(pa.int64())),
                        pa.array(
                            [[block.items[x] for x in p[2]] for p in parts], pa.list_(pa.string())
                        ),
                    ],
                    names=["row_no", "begins", "ends", "items"],
                )

    return search


def search_shards(index: DataFrame, pieces: DataFrame, n_blocks: int, window: int) -> DataFrame:
    """Hits of all items, a block of items after the other; see ``_HITS``.

    ``pieces`` (item, words, block) has rows of some 30 kB at most, dealt by hash, so a block
    that is broadcast has about ``BLOCK_WORDS`` words whatever the size of the items.
    """
    spark, staging = index.sparkSession, Staging(index.sparkSession, "hits")
    columns = [c for c in index.columns if c not in ("ids", "row_words")]
    hits = None
    for block in range(n_blocks):
        rows = [tuple(r) for r in pieces.where(F.col("block") == block).drop("block").collect()]
        if not rows:
            continue
        sent = spark.sparkContext.broadcast(Phrases(rows, window))
        found = staging.write(index.select(*columns).mapInArrow(_searched(sent), _HITS), "hits")
        sent.unpersist()
        hits = found if hits is None else hits.unionByName(found)
    return spark.createDataFrame([], _HITS) if hits is None else hits


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    *,
    doc_id: Column | str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    shard_words: int = SHARD_WORDS,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """A row for each document: ``id``, ``n_words``, ``n_hit``, ``spans`` and ``items``.

    ``spans`` are merged ranges of words (begin, end; from 0, end exclusive) that lie in an
    occurrence of a window, ``n_hit`` is their length, ``items`` the item ids as sorted texts.
    """
    if window < 1 or shard_words < 2 * window:
        raise ValueError("a window needs a word, a shard two windows")
    spark = docs.sparkSession
    staging = Staging(spark, "fm-index")
    ident = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    index = staging.write(
        index_shards(docs, ident, F.col(text), window, shard_words), "index"
    )
    pieces = staging.write(
        items.select(
            F.col(item_id).cast("string").alias("item"), F.col(item_text).cast("binary").alias("text")
        ).mapInArrow(_item_pieces(window), "item string, words array<long>"),
        "items",
    )
    total = pieces.agg(F.sum(F.size("words").cast("long"))).first()[0] or 0
    n_blocks = -(-total // block_words)
    dealt = pieces.withColumn(
        "block", F.pmod(F.xxhash64("item", "words"), F.lit(max(1, n_blocks))).cast("int")
    )
    hits = search_shards(index, dealt, n_blocks, window)

    # Pieces of a document and blocks of items may overlap: merge their spans.
    by_row = Window.partitionBy("row_no").orderBy("begin", "end")
    reach = F.max("end").over(by_row.rowsBetween(Window.unboundedPreceding, -1))
    spans = (
        hits.select("row_no", F.inline(F.arrays_zip(F.col("begins").alias("begin"), F.col("ends").alias("end"))))
        .withColumn("new", F.when(F.col("begin") <= reach, 0).otherwise(1))
        .withColumn("island", F.sum("new").over(by_row))
        .groupBy("row_no", "island")
        .agg(F.min("begin").alias("begin"), F.max("end").alias("end"))
        .groupBy("row_no")
        .agg(
            F.sum(F.col("end") - F.col("begin")).alias("n_hit"),
            F.sort_array(F.collect_list(F.struct("begin", "end"))).alias("spans"),
        )
    )
    told = (
        hits.select("row_no", F.explode("items").alias("item"))
        .groupBy("row_no")
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    )
    rows = index.select(
        F.inline(
            F.arrays_zip(
                F.col("ids").alias("id"),
                F.col("row_nos").alias("row_no"),
                F.col("row_words").alias("n_words"),
                F.col("row_offsets").alias("offset"),
            )
        )
    ).where(F.col("offset") == 0)
    none = F.array().cast("array<struct<begin:bigint,end:bigint>>")
    return (
        rows.join(spans, "row_no", "left")
        .join(told, "row_no", "left")
        .select(
            "id",
            "n_words",
            F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
            F.coalesce("spans", none).alias("spans"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        )
    )


def _cut(text: str, spans: list) -> str:
    data = text.encode()
    starts, ends, _ = words_in(data)
    at, kept = 0, []
    for span in spans:
        kept.append(data[at : starts[span["begin"]]])
        at = int(ends[span["end"] - 1])
    return (b"".join(kept) + data[at:]).decode()


def remove_spans(docs: DataFrame, items: DataFrame, **settings) -> DataFrame:
    """``docs`` with the words of all spans cut out of ``text``, and what stands between them.

    Rows and other columns stay; a text without spans is as before, null included.
    """
    name, key = settings.get("text", "text"), F.col(settings.pop("doc_id", "doc_id"))
    ident = F.struct(key.alias("id"), F.xxhash64(F.col(name)).alias("hash"))
    found = (
        decontaminate(docs, items, doc_id=ident, **settings)
        .where(F.col("n_hit") > 0)
        .groupBy(F.col("id.id").alias("found_id"), F.col("id.hash").alias("found_hash"))
        .agg(F.first("spans").alias("found_spans"))
    )

    @F.pandas_udf("string")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([t if s is None else _cut(t, s) for t, s in zip(texts, spans)], dtype=object)

    rows = docs.select(
        F.struct("*").alias("row"), key.alias("id"), F.xxhash64(F.col(name)).alias("hash"), F.col(name).alias("text")
    )
    same = F.col("id").eqNullSafe(F.col("found_id")) & (F.col("hash") == F.col("found_hash"))
    joined = rows.join(found, same, "left").withColumn("clean", cut("text", "found_spans"))
    return joined.select(F.col("row").withField(f"`{name}`", F.col("clean")).alias("row")).select("row.*")
