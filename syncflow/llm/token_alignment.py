"""Alignment of two tokenizers: byte-level BPE (A) and sentence pieces (B).

Both encode a blank and the text. A task takes documents in chunks of some megabytes and
works on Arrow arrays of a chunk's tokens: flattened id lists with parent indices, running
sums of token bytes, whose values are keys of (document, end) because documents follow one
another; Acero joins these keys of A and B, and ends that both have cut the tokens into
groups. Links are counted by ``Table.group_by`` per document and pair, then per chunk.
Spark adds the counts of chunks up; the counts of a chunk's pairs go back to its
documents by a cogroup, which adds them up per document.

Two tokens are linked if their byte ranges overlap: each end of A or B closes one
overlap, of the two tokens that hold the byte before it.

Encoding: neither tokenizer lets a token reach over the place before a blank that follows a
character that is not white space (for pieces this is checked in the vocabulary, else
texts are encoded whole). Texts are cut there; a part is encoded once as long as it is in a
dictionary of bounded size, new parts of a chunk together. Texts with white space before a
blank, or with a blank first, are encoded whole.

Defined results: null and empty texts, and texts that the tokens of A or B do not spell
byte by byte (U+2581, say), have no tokens: zeros and an empty digest. Strings of special tokens are
plain text. Rows are told apart by their place: repeated ids each get a row. Documents of
any length are one unit. Empty tables give empty results. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from syncflow.staging import Staging

#: Fixed value: how the byte-level vocabulary splits texts before it merges bytes.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Bytes of texts in a chunk, if a document does not have more.
CHUNK_BYTES = 2 << 20
#: Tokens that Acero joins at a time: its hash table then stays in the cache.
JOIN_TOKENS = 200_000
#: Tokens of parts of texts that a Python worker remembers, before it starts anew.
KNOWN_TOKENS = 1_500_000
#: Pairs in a row of a chunk's counts.
PAIRS_IN_ROW = 20_000

BLANK = "▁"


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Tokenizers:
    """Both encoders and the bytes of their tokens, from the contents of their files."""

    def __init__(self, bpe_json: bytes, piece_model: bytes):
        spec = json.loads(bpe_json)
        special = {t["content"] for t in spec["added_tokens"]}
        letters = _byte_letters()
        ranks = {
            bytes(letters[c] for c in entry): i
            for entry, i in spec["model"]["vocab"].items()
            if entry not in special
        }
        self.bpe = tiktoken.Encoding("a", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        spelled_a = [b""] * (max(ranks.values()) + 1)
        for entry, i in ranks.items():
            spelled_a[i] = entry
        names = [self.pieces.id_to_piece(i) for i in range(self.pieces.get_piece_size())]
        unused = {i for i in range(len(names)) if self.pieces.is_control(i) or self.pieces.is_unknown(i)}
        spelled_b = [
            b""
            if i in unused
            else bytes([int(name[3:5], 16)])
            if self.pieces.is_byte(i)
            else name.replace(BLANK, " ").encode()
            for i, name in enumerate(names)
        ]
        self.spelled = [pa.array(s, pa.large_binary()) for s in (spelled_a, spelled_b)]
        self.lengths = [np.array([len(x) for x in s]) for s in (spelled_a, spelled_b)]
        self.n_pieces = len(names)
        n_ids = max(len(spelled_a), len(spelled_b))
        self.decimals = pa.array(
            [f"{i}{mark}" for i in range(n_ids) for mark in (",", "|", ";", "")], pa.large_string()
        )
        self.parted = not any(BLANK in n.lstrip(BLANK) for i, n in enumerate(names) if i not in unused)
        self._lone_blank = [self.pieces.piece_to_id(BLANK)]
        self._forget()

    def _forget(self) -> None:
        self.known = _Parts()
        self.ids = ([np.zeros(0, np.int32)], [np.zeros(0, np.int32)])
        self.sizes = ([np.zeros(0, np.int64)], [np.zeros(0, np.int64)])
        self.n_ids = 0

    def _one(self, part: str) -> tuple[list[int], list[int]]:
        """Ids of a blank and ``part``."""
        b = self.pieces.encode(part, num_threads=1) if part else self._lone_blank
        return self.bpe.encode_ordinary(" " + part), b

    def _learn(self, parts: list[str]) -> None:
        """Encode parts that are not known yet: as one text, which is cut at their ends."""
        text = " ".join(parts)
        flat = [np.array(ids, np.int32) for ids in self._one(text)] if parts else []
        wanted = np.cumsum([len(p.encode()) + 1 for p in parts])
        cuts = []
        for ids, lengths in zip(flat, self.lengths):
            ends = np.cumsum(lengths[ids])
            cut = np.minimum(np.searchsorted(ends, wanted), len(ends) - 1)
            if not np.array_equal(ends[cut], wanted):
                break
            cuts.append(cut + 1)
        if len(cuts) == 2:
            for held, sizes, ids, cut in zip(self.ids, self.sizes, flat, cuts):
                held.append(ids)
                sizes.append(np.diff(cut, prepend=0))
            self.n_ids += len(flat[0])
        else:
            self._learn_each(parts)

    def _learn_each(self, parts: list[str]) -> None:
        each = [self._one(part) for part in parts]
        for held, sizes, lists in zip(self.ids, self.sizes, zip(*each)):
            held.append(np.array([i for x in lists for i in x], np.int32))
            sizes.append(np.array([len(x) for x in lists], np.int64))
        self.n_ids += sum(len(x[0]) for x in each)

    def encode(self, texts: list[str]) -> tuple[pa.LargeListArray, pa.LargeListArray]:
        """Id lists of A and B of a blank and each text; none of an empty text."""
        if self.n_ids > KNOWN_TOKENS:
            self._forget()
        parts = [t.split(" ") if t and self.parted else [] for t in texts]
        numbers = array("i")
        for own in parts:
            numbers.extend(map(self.known.__getitem__, own))
        joined, alone = self.known.take_new()
        self._learn(joined)
        self._learn_each(alone)
        # A part that ends in white space may be followed by no other.
        sizes = np.array([len(own) for own in parts], np.int64)
        ends = np.cumsum(sizes)
        numbers = np.array(numbers, np.int64)
        odd = self.known.odd[numbers]
        odd[ends[sizes > 0] - 1] = False
        odd = np.add.reduceat(np.append(odd, False), ends - sizes) * (sizes > 0) > 0
        odd |= np.array([bool(t) and not self.parted for t in texts], bool)
        chosen = self.known.place[numbers]
        if odd.any():
            whole = np.flatnonzero(odd)
            first = self.known.n_places
            self.known.n_places += len(whole)
            self._learn_each([texts[i] for i in whole])
            each = np.split(chosen, ends[:-1])
            for place, i in enumerate(whole, first):
                each[i], sizes[i] = np.array([place]), 1
            chosen = np.concatenate(each)
        ends_of = np.concatenate(([0], np.cumsum(sizes)))
        lists = []
        for ids, lengths in zip(self.ids, self.sizes):
            ids[:], lengths[:] = [np.concatenate(ids)], [np.concatenate(lengths)]
            held = pa.LargeListArray.from_arrays(
                pa.array(np.concatenate(([0], np.cumsum(lengths[0])))), pa.array(ids[0])
            ).take(pa.array(chosen))
            places = np.concatenate(([0], np.cumsum(lengths[0][chosen])))
            lists.append(pa.LargeListArray.from_arrays(pa.array(places[ends_of]), held.flatten()))
        return lists[0], lists[1]


class _Parts(dict):
    """Numbers of parts of texts; new ones are noted until they are encoded.

    ``odd`` tells of each number whether its part is empty or ends in white space, and
    ``place`` where its ids are kept.
    """

    def __init__(self):
        self.new: list[str] = []
        self.odd, self.place = np.zeros(0, bool), np.zeros(0, np.int64)
        self.n_places = 0

    def __missing__(self, part: str) -> int:
        self[part] = number = len(self)
        self.new.append(part)
        return number

    def take_new(self) -> tuple[list[str], list[str]]:
        """The new parts: those to be encoded as one text, and those to be encoded alone."""
        odd = np.array([not p or p[-1].isspace() for p in self.new], bool)
        alone = odd | np.array([BLANK in p for p in self.new], bool)
        place = np.empty(len(alone), np.int64)
        place[~alone] = np.arange(len(alone) - alone.sum())
        place[alone] = np.arange(len(alone) - alone.sum(), len(alone))
        start = self.n_places
        self.odd = np.concatenate((self.odd, odd))
        self.place = np.concatenate((self.place, start + place))
        parts = ([], [])
        for part, one in zip(self.new, alone.tolist()):
            parts[one].append(part)
        self.n_places += len(alone)
        self.new = []
        return parts


_OPEN: dict[bytes, Tokenizers] = {}


def opened(bpe_json: bytes, piece_model: bytes) -> Tokenizers:
    """The tokenizers of these files, made once in a Python worker."""
    key = hashlib.sha256(bpe_json + piece_model).digest()
    if key not in _OPEN:
        _OPEN[key] = Tokenizers(bpe_json, piece_model)
    return _OPEN[key]


@dataclass
class _Chunk:
    """Per document: token, group and link numbers, digest, groups; link counts by pair."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    digests: list[str]
    groups: list[str]
    links: pa.LargeListArray  # places in the chunk's pairs
    times: pa.LargeListArray
    pair_a: np.ndarray
    pair_b: np.ndarray
    pair_n: np.ndarray


def _spells(ids: pa.LargeListArray, spelled: pa.Array, texts: list[bytes]) -> np.ndarray:
    """Whether the tokens of each document spell its text."""
    joined = spelled.take(ids.flatten())
    _, offsets, data = joined.buffers()
    if not len(joined):
        return np.array([not t for t in texts], bool)
    places = np.frombuffer(offsets, np.int64)[ids.offsets.to_numpy()]
    data = memoryview(data).cast("B")
    return np.array(
        [data[a:b] == t for t, a, b in zip(texts, places[:-1], places[1:])], bool
    )


def shared_ends(ends_a: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
    """The document-end keys that both tokenizers have, by hash joins over slices of the keys."""
    found = []
    for at in range(0, len(ends_a), JOIN_TOKENS):
        a = ends_a[at : at + JOIN_TOKENS]
        low, high = np.searchsorted(ends_b, [a[0], a[-1] + 1])
        table = pa.table({"end": a}).join(
            pa.table({"end": ends_b[low:high]}), "end", join_type="left semi", use_threads=False
        )
        found.append(np.sort(table["end"].to_numpy()))
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def align_chunk(texts: list[str], tokenizers: Tokenizers) -> _Chunk:
    a, b = tokenizers.encode(texts)
    whole = [b" " + t.encode() if t else b"" for t in texts]
    fine = _spells(a, tokenizers.spelled[0], whole) & _spells(b, tokenizers.spelled[1], whole)
    if not fine.all():
        kept = pa.array(fine)
        a, b = (pc.if_else(kept, x, pa.scalar([], x.type)) for x in (a, b))
    ids, doc, ends, starts = [], [], [], []
    for lists, lengths in zip((a, b), tokenizers.lengths):
        flat = lists.flatten()
        ids.append(flat.to_numpy())
        doc.append(pc.list_parent_indices(lists).to_numpy())
        ends.append(pc.cumulative_sum(pa.array(lengths[ids[-1]])).to_numpy())
        starts.append(np.concatenate(([0], np.cumsum(pc.list_value_length(lists).to_numpy()))))
    n = len(texts)
    cut = shared_ends(*ends)
    at_a, at_b = (np.searchsorted(e, cut) for e in ends)

    # Each end closes an overlap: of A's token and the token of B around it, or the reverse.
    alone = np.ones(len(ends[1]), bool)
    alone[at_b] = False
    token_a = np.concatenate((np.arange(len(ends[0])), np.searchsorted(ends[0], ends[1][alone])))
    token_b = np.concatenate((np.searchsorted(ends[1], ends[0]), np.flatnonzero(alone)))
    pair = ids[0][token_a].astype(np.int64) * tokenizers.n_pieces + ids[1][token_b]
    coded = pa.array(pair).dictionary_encode()
    per_doc = (
        pa.table({"doc": doc[0][token_a], "pair": coded.indices})
        .group_by(["doc", "pair"], use_threads=False)
        .aggregate([([], "count_all")])
        .sort_by([("doc", "ascending"), ("pair", "ascending")])
    )
    holders, places, times = (per_doc[c].to_numpy() for c in ("doc", "pair", "count_all"))
    in_chunk = (
        per_doc.group_by("pair", use_threads=False)
        .aggregate([("count_all", "sum")])
        .sort_by("pair")
    )
    offsets = pa.array(np.searchsorted(holders, np.arange(n + 1)))
    pairs = coded.dictionary.to_numpy()

    # Tokens in the order of groups, A before B; the mark tells what follows a token.
    before_b = np.concatenate(([0], at_b + 1))
    after_a = at_a + 1
    marked = np.empty(len(ids[0]) + len(ids[1]), np.int32)
    mark_a, mark_b = (np.zeros(len(x), np.int32) for x in ids)
    mark_a[at_a], mark_b[at_b] = 1, 1
    group_a, group_b = (np.cumsum(m) - m for m in (mark_a, mark_b))
    mark_b[at_b] = 2
    mark_b[starts[1][1:][starts[1][1:] > starts[1][:-1]] - 1] = 3
    marked[np.arange(len(ids[0])) + before_b[group_a]] = ids[0] * 4 + mark_a
    if len(ids[1]):
        marked[np.arange(len(ids[1])) + after_a[group_b]] = ids[1] * 4 + mark_b
    shown = tokenizers.decimals.take(pa.array(marked))
    spots = np.zeros(n + 1, np.int64)
    data = memoryview(b"")
    if len(shown):
        spots = np.frombuffer(shown.buffers()[1], np.int64)[starts[0] + starts[1]]
        data = memoryview(shown.buffers()[2])
    said = [data[x:y] for x, y in zip(spots[:-1], spots[1:])]
    return _Chunk(
        np.diff(starts[0]),
        np.diff(starts[1]),
        np.bincount(doc[0][at_a], minlength=n),
        np.bincount(doc[0][token_a], minlength=n),
        [hashlib.sha256(s).hexdigest() if len(s) else "" for s in said],
        said,
        pa.LargeListArray.from_arrays(offsets, pa.array(places.astype(np.int32))),
        pa.LargeListArray.from_arrays(offsets, pa.array(times)),
        (pairs // tokenizers.n_pieces).astype(np.int32),
        (pairs % tokenizers.n_pieces).astype(np.int32),
        in_chunk["count_all_sum"].to_numpy(),
    )


_DOCS = (
    "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, groups string,"
    " links array<int>, times array<long>"
)
_PAIRS = "pair_at int, pair_a array<int>, pair_b array<int>, pair_n array<long>"


def _aligned(sent, schema: T.StructType, keep_groups: bool, chunk_bytes: int):
    """For ``mapInArrow``: rows of documents, and of the counts of each chunk's pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        tokenizers = opened(*sent.value)
        chunk = TaskContext.get().partitionId() << 36

        def record(columns: dict, n: int) -> pa.RecordBatch:
            columns = columns | {"chunk": pa.array([chunk] * n, pa.int64())}
            return pa.RecordBatch.from_arrays(
                [
                    columns[f.name].cast(f.type) if f.name in columns else pa.nulls(n, f.type)
                    for f in arrow
                ],
                schema=arrow,
            )

        for batch in batches:
            at, texts = 0, batch.column(1)
            while at < batch.num_rows:
                part, size = [], 0
                while at + len(part) < batch.num_rows and (not part or size < chunk_bytes):
                    part.append(texts[at + len(part)].as_py() or "")
                    size += len(part[-1])
                done = align_chunk(part, tokenizers)
                columns = {
                    "id": batch.column(0).slice(at, len(part)),
                    **{
                        c: pa.array(getattr(done, c)) for c in ("n_a", "n_b", "n_groups", "n_links")
                    },
                    "groups_sha256": pa.array(done.digests, pa.string()),
                    "links": done.links,
                    "times": done.times,
                }
                if keep_groups:
                    columns["groups"] = pa.array([str(g, "ascii") for g in done.groups], pa.string())
                yield record(columns, len(part))
                for first in range(0, len(done.pair_n), PAIRS_IN_ROW):
                    some = slice(first, first + PAIRS_IN_ROW)
                    yield record(
                        {
                            "pair_at": pa.array([first], pa.int32()),
                            "pair_a": pa.array([done.pair_a[some]], pa.list_(pa.int32())),
                            "pair_b": pa.array([done.pair_b[some]], pa.list_(pa.int32())),
                            "pair_n": pa.array([done.pair_n[some]], pa.list_(pa.int64())),
                        },
                        1,
                    )
                at += len(part)
                chunk += 1

    return run


def _with_counts(names: list[str]):
    """For a cogroup: a chunk's documents with the corpus counts of its pairs."""

    def run(docs: pa.Table, counts: pa.Table) -> pa.Table:
        if not counts.num_rows:
            none = pa.array(np.zeros(docs.num_rows, np.int64))
            return docs.select(names).append_column("n_best", none).append_column("count_sum", none)
        order = np.argsort(counts["place"].to_numpy())
        count = counts["n"].to_numpy()[order]
        best = counts["best"].to_numpy(zero_copy_only=False)[order]
        times = pc.list_flatten(docs["times"]).to_numpy()
        places = pc.list_flatten(docs["links"]).to_numpy()
        ends = np.concatenate(([0], np.cumsum(pc.list_value_length(docs["links"]).to_numpy())))

        def summed(values: np.ndarray) -> pa.Array:
            return pa.array(np.diff(np.concatenate(([0], np.cumsum(values)))[ends]), pa.int64())

        return (
            docs.select(names)
            .append_column("n_best", summed(times * best[places]))
            .append_column("count_sum", summed(times * count[places]))
        )

    return run


@dataclass
class Alignment:
    """``documents``: ``id``, numbers, digest, ``groups`` if asked for, ``n_best``, ``count_sum``.

    ``pairs``: ``a``, ``b``, ``n`` (links of the corpus) and ``best`` (no pair of ``b`` has more).
    """

    documents: DataFrame
    pairs: DataFrame


def align(
    docs: DataFrame,
    bpe_path: str,
    piece_path: str,
    *,
    doc_id: Column | str = "doc_id",
    text: str = "text",
    keep_groups: bool = False,
    chunk_bytes: int = CHUNK_BYTES,
) -> Alignment:
    """Align both tokenizers on every text of ``docs``.

    The vocabulary files, of some megabytes, are read by the driver and broadcast.
    ``groups`` are texts like ``a1,a2|b1;a3|b2,b3``.
    """
    spark = docs.sparkSession
    staging = Staging(spark, "alignment")
    files = []
    for path in (bpe_path, piece_path):
        with open(path, "rb") as file:
            files.append(file.read())
    sent = spark.sparkContext.broadcast(tuple(files))
    rows = docs.select(
        (F.col(doc_id) if isinstance(doc_id, str) else doc_id).alias("id"),
        F.col(text).alias("text"),
    )
    schema = T.StructType(
        [
            T.StructField("chunk", T.LongType()),
            T.StructField("id", rows.schema["id"].dataType),
            *T.StructType.fromDDL(_DOCS),
            *T.StructType.fromDDL(_PAIRS),
        ]
    )
    done = staging.write(
        rows.mapInArrow(_aligned(sent, schema, keep_groups, chunk_bytes), schema), "chunks"
    )
    held = F.posexplode(F.arrays_zip("pair_a", "pair_b", "pair_n")).alias("pos", "pair")
    partial = (
        done.where(F.col("pair_at").isNotNull())
        .select("chunk", "pair_at", held)
        .select(
            "chunk",
            (F.col("pair_at") + F.col("pos")).alias("place"),
            F.col("pair.pair_a").alias("a"),
            F.col("pair.pair_b").alias("b"),
            F.col("pair.pair_n").alias("n"),
        )
    )
    counts = staging.write(partial.groupBy("a", "b").agg(F.sum("n").alias("n")), "counts")
    # A row for each piece: as many as the vocabulary has.
    most = counts.groupBy("b").agg(F.max("n").alias("most"))
    pairs = counts.join(F.broadcast(most), "b").select(
        "a", "b", "n", (F.col("n") == F.col("most")).alias("best")
    )
    told = partial.select(F.col("chunk").alias("of_chunk"), "place", "a", "b").join(
        pairs, ["a", "b"]
    )
    names = ["id", *T.StructType.fromDDL(_DOCS).names[:6]]
    names = names if keep_groups else names[:-1]
    fields = [schema[n] for n in names]
    out = T.StructType(
        [*fields, T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())]
    )
    documents = (
        done.where(F.col("pair_at").isNull())
        .select("chunk", *names, "links", "times")
        .groupBy("chunk")
        .cogroup(told.select("of_chunk", "place", "n", "best").groupBy("of_chunk"))
        .applyInArrow(_with_counts(names), out)
    )
    return Alignment(documents, pairs)
