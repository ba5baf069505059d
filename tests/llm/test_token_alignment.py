from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest
import sentencepiece
from tokenizers import Tokenizer

from syncflow.llm import token_alignment
from syncflow.llm.queries import BYTE_VOCABULARY, VOCABULARY
from syncflow.llm.token_alignment import Tokenizers, _byte_letters, align, align_chunk

SCHEMA = "doc_id long, text string, id string, chunk string, links string"

TEXTS = [
    "Hello world, it's a test.",
    "Hello world, it's a test.",
    "  two  blanks   and\n lines \n\n\n end  ",
    " one in front",
    "one behind ",
    "tabs\tand\r\nreturns \x0b\x0c \x1c x 　  y  z",
    "naïve façade Ångström ẞ 你好,世界 🙂👩‍👩‍👧 ﬁn é",
    "<|endoftext|> <s> </s> <unk> <0x0A> <|endoftext|>",
    "a▁b",
    "nul\x00 and \x7f",
    "",
    None,
    " ",
    "\n",
    "x" * 5000 + " " + "word " * 900 + "äöü " * 600,
    "def f(x):\n    return x  # 4\n",
    "3.14159 26535,89793 1,000,000",
]


def fuzz(n, seed=3):
    rng = random.Random(seed)
    signs = [" ", " ", "  ", "\n", "a", "e", "th", "ing", "'s", "É", "ß", "1", "23", ".", "-", "你", " ", "A"]
    return ["".join(rng.choices(signs, k=rng.randint(1, 60))) for _ in range(n)]


class Reference:
    """Whole texts, encoded by the libraries that the files are for."""

    def __init__(self):
        self.a = Tokenizer.from_file(BYTE_VOCABULARY)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=VOCABULARY)
        letters = _byte_letters()
        self.spelled = {
            i: bytes(letters[c] for c in t)
            for t, i in self.a.get_vocab(with_added_tokens=False).items()
            if all(c in letters for c in t)
        }

    def piece(self, i):
        name = self.b.id_to_piece(i)
        if self.b.is_byte(i):
            return bytes([int(name[3:5], 16)])
        return b"" if self.b.is_control(i) else name.replace("▁", " ").encode()

    def tokens(self, text):
        if not text:
            return [], []
        a = self.a.encode(" " + text, add_special_tokens=False).ids
        b = self.b.encode(text)
        whole = b" " + text.encode()
        if b"".join(self.spelled[i] for i in a) != whole or b"".join(map(self.piece, b)) != whole:
            return [], []
        return a, b


def ranges(ids, spell):
    out, at = [], 0
    for i in ids:
        out.append((i, at, at + len(spell(i))))
        at = out[-1][2]
    return out


def brute(rows):
    ref, docs = Reference(), []
    for doc, text in rows:
        a, b = ref.tokens(text)
        a, b = ranges(a, ref.spelled.__getitem__), ranges(b, ref.piece)
        cuts = sorted({x[2] for x in a} & {x[2] for x in b})
        groups, low = [], 0
        for cut in cuts:
            groups.append(
                "|".join(",".join(str(i) for i, _, end in side if low < end <= cut) for side in (a, b))
            )
            low = cut
        links, j0 = [], 0
        for i, x, y in a:
            while j0 < len(b) and b[j0][2] <= x:
                j0 += 1
            j = j0
            while j < len(b) and b[j][1] < y:
                links.append((i, b[j][0]))
                j += 1
        docs.append((doc, len(a), len(b), groups, links))
    count = Counter(p for d in docs for p in d[4])
    most: dict[int, int] = {}
    for (_, b), n in count.items():
        most[b] = max(most.get(b, 0), n)
    out = []
    for doc, n_a, n_b, groups, links in docs:
        said = ";".join(groups)
        out.append(
            (
                doc,
                n_a,
                n_b,
                len(groups),
                len(links),
                hashlib.sha256(said.encode()).hexdigest() if said else "",
                sum(count[p] == most[p[1]] for p in links),
                sum(count[p] for p in links),
                said,
            )
        )
    return sorted(out, key=repr), count, most


@pytest.mark.parametrize("chunk_bytes,join", [(1, 50), (300, 200_000), (1 << 22, 1000)])
def test_against_brute_force(spark, monkeypatch, chunk_bytes, join):
    monkeypatch.setattr(token_alignment, "JOIN_TOKENS", join)
    texts = TEXTS + fuzz(150) + ["plain words of a text " * i for i in range(1, 20)]
    rows = list(zip([1, *range(len(texts) - 2), None], texts))
    frame = spark.createDataFrame([(*r, "i", "c", "l") for r in rows], SCHEMA).repartition(2)
    found = align(frame, BYTE_VOCABULARY, VOCABULARY, keep_groups=True, chunk_bytes=chunk_bytes)
    docs, count, most = brute(rows)
    columns = [
        "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum", "groups",
    ]
    got = sorted((tuple(r) for r in found.documents.select(*columns).collect()), key=repr)
    assert got == docs
    pairs = {(r["a"], r["b"]): (r["n"], r["best"]) for r in found.pairs.collect()}
    assert pairs == {p: (n, n == most[p[1]]) for p, n in count.items()}


@pytest.fixture(scope="module")
def tokenizers():
    with open(BYTE_VOCABULARY, "rb") as a, open(VOCABULARY, "rb") as b:
        return Tokenizers(a.read(), b.read())


def test_parts_give_the_ids_of_whole_texts(tokenizers, monkeypatch):
    ref = Reference()
    texts = [t for t in TEXTS + fuzz(400, 5) if t]
    assert tokenizers.parted
    for limit in (10**6, 0):
        monkeypatch.setattr(token_alignment, "KNOWN_TOKENS", limit)
        a, b = tokenizers.encode(texts)
        for text, x, y in zip(texts, a.to_pylist(), b.to_pylist()):
            assert x == ref.a.encode(" " + text, add_special_tokens=False).ids, text
            assert y == ref.b.encode(text), text


def test_vocabulary_with_blanks_inside_pieces(tokenizers, monkeypatch):
    texts = [t for t in TEXTS if t]
    parted = tokenizers.encode(texts)
    monkeypatch.setattr(tokenizers, "parted", False)
    assert all(x.equals(y) for x, y in zip(parted, tokenizers.encode(texts)))


def test_chunk_without_tokens(tokenizers):
    done = align_chunk(["", "a▁b"], tokenizers)
    assert done.n_a.tolist() == done.n_links.tolist() == [0, 0]
    assert done.digests == ["", ""] and not len(done.pair_n)


def test_empty_table(spark):
    found = align(spark.createDataFrame([], SCHEMA), BYTE_VOCABULARY, VOCABULARY)
    assert found.documents.collect() == [] and found.pairs.collect() == []
