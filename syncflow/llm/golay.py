"""Near-duplicates by SimHash, found through Golay-code fuzzy hashing.

The binary Golay code has a codeword within three bits of every 23-bit word. A
word's keys are the 12-bit indices of the codewords that the word itself and its
one-bit neighbours decode to: one key, or six. Two words at most two bits apart
have a neighbour in common, and with it a key; two words one bit apart even share
the key that one of them decodes to (its primary key).

A 64-bit fingerprint is cut into segments of 23, 23 and 18 bits. If two differ in
at most four bits, then in two of the three segments they differ in at most two
bits together: none and up to two, or one and one. So for each pair of segments a
fingerprint is filed under

- one segment as it is and each key of the other, both ways round, and
- each pair of keys; there only pairs with one primary member are compared.

All fingerprints under a key are verified by their distance. Only distinct
fingerprints are filed, and each key emits the links of a spanning forest rather
than all its pairs, so large groups of copies cost a row per member and key.

Defined results: a null or wordless text has fingerprint 0, linked like any
other. Rows without id take part; a component whose rows all lack an id has no
``component_id``. Repeated rows are linked by their equal fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from syncflow.llm.components import components
from syncflow.staging import Staging

SEED = 42
SHINGLE_WORDS = 4
MAX_BITS = 4

# ---------------------------------------------------------------- fingerprints


#: Bits of each byte value, the highest first.
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def shingle_hashes(data: bytes, words_each: int = SHINGLE_WORDS) -> Iterator[bytes]:
    """XXH64 of a text's shingles, joined, in parts; words end at ASCII white space."""
    words = data.lower().split()
    if not words:
        return
    joined = b" ".join(words)
    hash64 = xxhash.xxh64_digest
    if len(words) <= words_each:
        yield hash64(joined, SEED)
        return
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    last = len(words) - words_each + 1
    for at in range(0, last, 1 << 14):
        stop = min(at + (1 << 14), last)
        pieces = zip(
            starts[at:stop], ends[at + words_each - 1 : stop + words_each - 1], strict=True
        )
        yield b"".join([hash64(joined[s : e - 1], SEED) for s, e in pieces])


def fingerprint(data: bytes | None, words_each: int = SHINGLE_WORDS) -> int:
    """The SimHash of a text, as an unsigned number."""
    ones, total = np.zeros(64, np.int64), 0
    for part in shingle_hashes(data or b"", words_each):
        values = np.frombuffer(part, np.uint8).reshape(-1, 8)
        for byte in range(8):
            seen = np.bincount(values[:, byte], minlength=256)
            ones[8 * byte : 8 * byte + 8] += seen @ _BITS
        total += len(values)
    return int.from_bytes(np.packbits(ones * 2 > total).tobytes(), "big")


def simhash(text: Column, words_each: int = SHINGLE_WORDS) -> Column:
    """The SimHash of a text column, as a signed long."""

    @F.pandas_udf("long")
    def hashed(texts: pd.Series) -> pd.Series:
        found = np.fromiter((fingerprint(t, words_each) for t in texts), np.uint64, len(texts))
        return pd.Series(found.view(np.int64))

    return hashed(F.coalesce(text.cast("binary"), F.lit(b"")))


# ------------------------------------------------------------------ Golay keys

#: Generator polynomial of the (23, 12) code.
GENERATOR = 0b110001110101
#: Lowest bit and width of each segment.
SEGMENTS = ((41, 23), (18, 23), (0, 18))
PAIRS = tuple(combinations(range(len(SEGMENTS)), 2))


def _remainder(word: int) -> int:
    for bit in range(22, 10, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - 11)
    return word


def _error_patterns() -> np.ndarray:
    """The error of at most three bits that each syndrome stands for."""
    out = np.zeros(1 << 11, np.int64)
    for weight in (1, 2, 3):
        for bits in combinations(range(23), weight):
            error = sum(1 << b for b in bits)
            out[_remainder(error)] = error
    return out


_ERRORS = _error_patterns()
_HIGH = np.array([_remainder(x << 11) for x in range(1 << 12)], np.int64)


def decode(words: np.ndarray) -> np.ndarray:
    """The index of the codeword nearest to each 23-bit word."""
    syndrome = _HIGH[words >> 11] ^ (words & 0x7FF)
    return (words ^ _ERRORS[syndrome]) >> 11


def neighbour_keys(words: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """A row of keys per word, and which of them are its distinct keys.

    The first column is the word's own index, its primary key.
    """
    flips = np.array([0, *(1 << b for b in range(width))], np.int64)
    keys = decode(words[:, None] ^ flips)
    order = np.argsort(keys, axis=1, kind="stable")
    ranked = np.take_along_axis(keys, order, axis=1)
    first = np.ones(keys.shape, bool)
    first[:, 1:] = ranked[:, 1:] != ranked[:, :-1]
    # No word has more than six keys: keep the distinct ones in front.
    front = np.argsort(~first, axis=1, kind="stable")[:, :6]
    return np.take_along_axis(ranked, front, axis=1), np.take_along_axis(first, front, axis=1)


def _segment(prints: np.ndarray, k: int) -> np.ndarray:
    low, width = SEGMENTS[k]
    return ((prints >> np.uint64(low)) & np.uint64((1 << width) - 1)).astype(np.int64)


#: The kind of a key stands above its value: pair of segments, and form.
_KIND = 40


def file_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of unsigned fingerprints, and the place of the fingerprint of each."""
    segments = [_segment(prints, k) for k in range(len(SEGMENTS))]
    fuzzy = [neighbour_keys(s, SEGMENTS[k][1]) for k, s in enumerate(segments)]
    keys, owners = [], []

    def put(kind: int, values: np.ndarray, kept: np.ndarray) -> None:
        values = values.reshape(len(prints), -1) | (kind << _KIND)
        row, column = np.nonzero(kept.reshape(len(prints), -1))
        keys.append(values[row, column])
        owners.append(row)

    for p, (i, j) in enumerate(PAIRS):
        (ki, oi), (kj, oj) = fuzzy[i], fuzzy[j]
        put(3 * p, segments[i][:, None] << 12 | kj, oj)
        put(3 * p + 1, segments[j][:, None] << 12 | ki, oi)
        put(3 * p + 2, ki[:, :, None] << 12 | kj[:, None, :], oi[:, :, None] & oj[:, None, :])
    return np.concatenate(keys), np.concatenate(owners)


def primary(keys: np.ndarray, prints: np.ndarray) -> np.ndarray:
    """Whether a fingerprint is a primary member under its key."""
    kind = keys >> _KIND
    out = np.ones(len(keys), bool)
    for p, (i, j) in enumerate(PAIRS):
        at = np.flatnonzero(kind == 3 * p + 2)
        own = decode(_segment(prints[at], i)) << 12 | decode(_segment(prints[at], j))
        out[at] = (keys[at] & ((1 << 24) - 1)) == own
    return out


# ----------------------------------------------------------------------- links

#: Keys with more members than this get a spanning search each.
SMALL_RUN = 16
#: Keys of a fingerprint, on average, and keys that a task should hold at most.
MEAN_KEYS = 120
PARTITION_KEYS = 4_000_000
#: Rows that are looked at together.
ROWS = 1 << 18


def _near(a: np.ndarray, b: np.ndarray, max_bits: int) -> np.ndarray:
    return np.bitwise_count(a ^ b) <= max_bits


def spanning_links(
    prints: np.ndarray, leads: np.ndarray, max_bits: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links that connect all members of one key that a chain of links connects.

    Only links with a primary member are followed.
    """
    left, left_leads = prints, leads
    while left_leads.any():
        at = int(left_leads.argmax())
        found = [(left[at], True)]
        keep = np.ones(len(left), bool)
        keep[at] = False
        left, left_leads = left[keep], left_leads[keep]
        while found and len(left):
            one, lead = found.pop()
            near = _near(left, one, max_bits)
            if not lead:
                near &= left_leads
            if near.any():
                yield np.full(int(near.sum()), one), left[near]
                found += zip(left[near], left_leads[near], strict=True)
                left, left_leads = left[~near], left_leads[~near]


def links_of_run(
    keys: np.ndarray, prints: np.ndarray, max_bits: int
) -> tuple[np.ndarray, np.ndarray]:
    """Verified links among rows sorted by key."""
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    lengths = np.diff(np.r_[starts, len(keys)])
    some = np.repeat(lengths > 1, lengths)
    keys, prints = keys[some], prints[some]
    lengths = lengths[lengths > 1]
    starts = np.cumsum(lengths) - lengths
    leads = primary(keys, prints)
    left, right = [], []
    small = np.repeat(lengths <= SMALL_RUN, lengths)
    for step in range(1, SMALL_RUN):
        if step >= len(keys):
            break
        same = np.flatnonzero(
            (keys[step:] == keys[:-step]) & small[step:] & (leads[step:] | leads[:-step])
        )
        if not len(same):
            continue
        near = same[_near(prints[same], prints[same + step], max_bits)]
        left.append(prints[near])
        right.append(prints[near + step])
    for at, length in zip(starts, lengths, strict=True):
        if length > SMALL_RUN:
            own = slice(at, at + length)
            for a, b in spanning_links(prints[own], leads[own], max_bits):
                left.append(a)
                right.append(b)
    if not left:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    a, b = np.concatenate(left), np.concatenate(right)
    pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
    return pairs[:, 0], pairs[:, 1]


def _file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        for at in range(0, len(prints), 1 << 11):
            part = prints[at : at + (1 << 11)]
            keys, owner = file_keys(part)
            yield pa.record_batch(
                [pa.array(keys), pa.array(part[owner].view(np.int64))], ["key", "print"]
            )


def _link(batches: Iterator[pa.RecordBatch], max_bits: int) -> Iterator[pa.RecordBatch]:
    """Links of rows that come sorted by key; holds ``ROWS`` rows and the last key's."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    count = 0

    def out(keys: np.ndarray, prints: np.ndarray) -> Iterator[pa.RecordBatch]:
        a, b = links_of_run(keys, prints, max_bits)
        if len(a):
            yield pa.record_batch(
                [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"]
            )

    for batch in batches:
        keys = batch.column(0).to_numpy(zero_copy_only=False)
        prints = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
        held.append((keys, prints))
        count += len(keys)
        if count >= ROWS:
            keys, prints = (np.concatenate(x) for x in zip(*held, strict=True))
            last = int(np.searchsorted(keys, keys[-1]))
            if last:
                yield from out(keys[:last], prints[:last])
            held, count = [(keys[last:], prints[last:])], 0
    if held:
        keys, prints = (np.concatenate(x) for x in zip(*held, strict=True))
        if len(keys):
            yield from out(keys, prints)


def fingerprint_links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) between distinct fingerprints of a one-column table.

    Their chains reach exactly what chains of all pairs within ``max_bits``
    reach. ``max_bits`` may be 0 to 4, which is what the keys promise.
    """
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"max_bits must be 0 to {MAX_BITS}")
    n_keys = prints.count() * MEAN_KEYS
    usual = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n_parts = max(usual, -(-n_keys // PARTITION_KEYS))
    return (
        prints.repartition(n_parts, "print")
        .mapInArrow(_file, "key long, print long")
        .repartition(n_parts, "key")
        .sortWithinPartitions("key")
        .mapInArrow(lambda b: _link(b, max_bits), "a long, b long")
        .distinct()
    )


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    words_each: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """``doc_id, text_hash, print, root`` and ``component_id`` for every row.

    ``component_id`` is the smallest id that chains of links reach, ``root`` the
    smallest fingerprint (both signed longs); ``text_hash`` tells rows of one id apart.
    """
    staging = Staging(docs.sparkSession, "simhash")
    marked = staging.write(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.xxhash64(text_col).alias("text_hash"),
            simhash(F.col(text_col), words_each).alias("print"),
        ),
        "prints",
    )
    distinct = staging.write(
        marked.groupBy("print").agg(F.min("doc_id").alias("least_id")), "distinct"
    )
    links = fingerprint_links(distinct.select("print"), max_bits)
    rooted = staging.write(components(links, staging), "rooted")
    known = distinct.join(rooted.withColumnRenamed("node", "print"), "print", "left").withColumn(
        "root", F.coalesce("root", "print")
    )
    known = staging.write(known, "known")
    named = known.groupBy("root").agg(F.min("least_id").alias("component_id"))
    labels = known.join(named, "root").select("print", "root", "component_id")
    return marked.join(staging.write(labels, "labels"), "print").select(
        "doc_id", "text_hash", "print", "root", "component_id"
    )


def hex_print(column: Column) -> Column:
    """A signed long as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(column), 16, "0"))
