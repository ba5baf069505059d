"""Personal data, and terms that give it away.

Four kinds of personal data are found by pattern. Their values are the protected
entities. A term (a run of letters outside of e-mail addresses) may give an entity
away although the entity itself is masked: the corpus tells how strongly. Over all
documents,

    disclosure = log(N * n_et / (n_e * n_t)) / log(N / n_e),

the pointwise mutual information of entity and term as a share of the entity's
information content; ``n_e`` documents hold the entity, ``n_t`` the term, and
``n_et`` both. Terms that disclose ``generalise_at`` of an entity or more become
spans of kind ``term`` wherever they stand in the documents that hold it; at
``remove_at`` they are removed from the text, below that they are replaced by a
general word. Texts without an entity stay as they are.

Callers may ask for less: terms of ``min_term`` letters or more, pairs that share
``min_docs`` documents, and only terms ``near`` an entity: wholly within so many
code points of it, and not past the next entity of the same kind.

Everything is DataFrame expressions. Patterns are possessive and anchored at the
starts of runs, so that they take linear time and no stack. Only entities and the
terms of texts that hold some leave the text. As ``n_et`` is at most ``n_e``, a term
of more than ``N * (n_e / N) ** generalise_at`` documents cannot disclose the
entity; such terms, the frequent ones, are left out before pairs are formed.

Defined results: a null text is empty. Every row counts as a document, repeated
ones too; ids may be null. An entity that all documents hold tells nothing. Terms
are compared in lower case. The output has only the columns named here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from syncflow.operators.skew import join_one
from syncflow.staging import Staging

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
#: Letters of the shortest term, if the caller does not say.
MIN_TERM = 4
MIN_DOCS = 1
GENERALISE_AT = 0.8
REMOVE_AT = 0.95

#: Each pattern may begin at the start of a run, or where the last match ended.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}+",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+(?<=[0-9])(?<!\+[0-9])",
}
#: A text without this character, or a match of this pattern, has no such span.
HINTS = {"email": "@", "phone": "+"}
#: Terms are matched together with addresses, so that none begins inside of one.
TERM_PATTERN = r"\p{L}++"
TERM_OR_EMAIL = rf"{PATTERNS['email']}|{TERM_PATTERN}"

_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def prefix_sums(values: Column) -> Column:
    """Running sums of an array, in passes over twice the distance each."""

    def one_pass(step: int):
        def added(sums: Column) -> Column:
            def shifted(x: Column, i: Column) -> Column:
                return x + F.when(i >= step, F.get(sums, i - step)).otherwise(0)

            return F.when(F.size(sums) > step, F.transform(sums, shifted)).otherwise(sums)

        return added

    out = values
    for level in range(24):
        out = let(out, one_pass(1 << level))
    return out


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn test."""
    figures = F.reverse(F.split(digits, ""))
    total = F.aggregate(
        F.transform(
            figures,
            lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
                F.translate(d, "0123456789", "0246813579").cast("int")
            ),
        ),
        F.lit(0),
        lambda s, d: s + d,
    )
    return total % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        digits = _digits(value)
        return F.length(digits).between(12, 19) & luhn(digits)
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def _entity(kind: str, value: Column) -> Column:
    """A value without its spelling: one name for each entity."""
    plain = F.lower(value) if kind in ("email", "ip") else _digits(value)
    return F.concat(F.lit(f"{kind}:"), plain)


def _pieces(text: Column, pattern: str) -> tuple[Column, Column]:
    """Matches, and the texts around them."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)


def _starts(matches: Column, gaps: Column) -> Column:
    """Code points before each match."""
    own = F.zip_with(
        matches, F.slice(gaps, 1, F.size(matches)), lambda m, g: F.length(m) + F.length(g)
    )
    return F.zip_with(prefix_sums(own), matches, lambda end, m: end - F.length(m))


_SPAN = "array<struct<start:int,kind_no:int,end:int,entity:string>>"


def _spans(no: int, kind: str) -> Column:
    """Valid spans of a kind, from its matches and their starts."""
    matches, starts = F.col(f"matches_{kind}"), F.col(f"starts_{kind}")
    spans = F.transform(
        matches,
        lambda m, i: F.struct(
            F.get(starts, i).alias("start"),
            F.lit(no).alias("kind_no"),
            (F.get(starts, i) + F.length(m)).alias("end"),
            F.when(_valid(kind, m), _entity(kind, m)).alias("entity"),
        ),
    )
    return F.filter(spans, lambda s: s["entity"].isNotNull())


def find_entities(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, text, spans``: valid spans of all kinds by start, then kind."""
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    none = F.array().cast("array<string>")

    def hinted(kind: str, value: Column) -> Column:
        if kind in HINTS:
            return F.when(F.instr("text", HINTS[kind]) > 0, value).otherwise(none)
        return value

    pieces = {k: _pieces(F.col("text"), PATTERNS[k]) for k in KINDS}
    found = rows.select("*", *[hinted(k, pieces[k][0]).alias(f"matches_{k}") for k in KINDS])
    some = {k: F.size(f"matches_{k}") > 0 for k in KINDS}
    found = found.select(
        "*", *[F.when(some[k], pieces[k][1]).otherwise(none).alias(f"gaps_{k}") for k in KINDS]
    )
    starts = {k: _starts(F.col(f"matches_{k}"), F.col(f"gaps_{k}")) for k in KINDS}
    found = found.select(
        "*",
        *[
            F.when(some[k], starts[k]).otherwise(F.array().cast("array<int>")).alias(f"starts_{k}")
            for k in KINDS
        ],
    )
    spans = [
        F.when(some[k], _spans(n, k)).otherwise(F.array()).cast(_SPAN)
        for n, k in enumerate(KINDS)
    ]
    return found.select("doc_id", "text", F.array_sort(F.concat(*spans)).alias("spans"))


def _is_term(match: Column, min_term: int) -> Column:
    return ~F.contains(match, F.lit("@")) & (F.length(match) >= min_term)


def distinct_terms(text: Column, min_term: int) -> Column:
    """The terms of a text, each once."""

    def found(pattern: str) -> Column:
        return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    matches = F.when(F.instr(text, "@") > 0, found(TERM_OR_EMAIL)).otherwise(found(TERM_PATTERN))
    terms = F.filter(matches, lambda m: _is_term(m, min_term))
    return F.array_distinct(F.transform(terms, F.lower))


def placed_terms(text: Column, min_term: int) -> Column:
    """(term, start, end) of all terms of a text."""
    matches, gaps = _pieces(text, TERM_OR_EMAIL)
    placed = let(
        matches,
        lambda found: F.zip_with(
            found,
            _starts(found, gaps),
            lambda m, at: F.struct(
                m.alias("term"), at.alias("start"), (at + F.length(m)).alias("end")
            ),
        ),
    )
    return F.transform(
        F.filter(placed, lambda t: _is_term(t["term"], min_term)),
        lambda t: F.struct(F.lower(t["term"]).alias("term"), t["start"], t["end"]),
    )


_PLACES = "array<struct<start:int,end:int>>"


def _beside(place: Column, spans: Column, near: int) -> Column:
    """Whether a place is near one of an entity's spans (start, end, low, high)."""
    return F.exists(
        spans,
        lambda s: (
            (place["start"] >= F.greatest(s["low"], s["start"] - near))
            & (place["end"] <= s["start"])
        )
        | (
            (place["start"] >= s["end"]) & (place["end"] <= F.least(s["high"], s["end"] + near))
        ),
    )


def _entities(rows: DataFrame, near: int | None) -> DataFrame:
    """(row_no, entity) of all rows; with ``near`` also its spans and their borders."""
    if near is None:
        names = F.array_distinct(F.transform("spans", lambda s: s["entity"]))
        return rows.select("row_no", F.explode(names).alias("entity"))
    # Spans of one kind do not overlap; each ends at the neighbours of its kind.
    def of_kind(no: int) -> Column:
        return F.filter("spans", lambda s: s["kind_no"] == no)

    def bordered(own: Column) -> Column:
        return F.transform(
            own,
            lambda s, i: F.struct(
                s["entity"].alias("entity"),
                s["start"].alias("start"),
                s["end"].alias("end"),
                F.coalesce(F.get(own, i - 1)["end"], F.lit(0)).alias("low"),
                F.coalesce(F.get(own, i + 1)["start"], F.lit((1 << 31) - 1)).alias("high"),
            ),
        )

    spans = F.concat(*[let(of_kind(no), bordered) for no in range(len(KINDS))])
    return (
        rows.select("row_no", F.explode(spans).alias("s"))
        .groupBy("row_no", "s.entity")
        .agg(F.collect_list(F.struct("s.start", "s.end", "s.low", "s.high")).alias("at"))
    )


def _shared_terms(
    rows: DataFrame,
    term_docs: DataFrame,
    n_docs: int,
    staging: Staging,
    *,
    near: int | None,
    generalise_at: float,
) -> DataFrame:
    """``row_no, entity, term, n_e, n_t, places`` of all terms that might disclose."""
    held = staging.write(_entities(rows.where(F.size("spans") > 0), near), "entities")
    entity_docs = staging.write(
        held.groupBy("entity").agg(F.count(F.lit(1)).alias("n_e")).where(F.col("n_e") < n_docs),
        "entity-docs",
    )
    most = entity_docs.agg(F.max("n_e")).first()[0] or 1
    # A little more than the bound, for the rounding of the logarithms.
    limit = lambda n_e: n_docs * (n_e / n_docs) ** generalise_at * (1 + 1e-9)
    bound = max(limit(1), limit(most)) if n_docs else 0.0
    frequent, few = staging.write_checked(
        term_docs.where(F.col("n_t") > bound).select("term"), "frequent"
    )
    places = (
        rows.where(F.size("spans") > 0)
        .select("row_no", F.explode("words").alias("w"))
        .select("row_no", "w.term", "w.start", "w.end")
        .join(F.broadcast(frequent) if few else frequent, "term", "left_anti")
        .groupBy("row_no", "term")
        .agg(F.collect_list(F.struct("start", "end")).cast(_PLACES).alias("places"))
        .join(term_docs.where(F.col("n_t") <= bound), "term")
    )
    shared = join_one(held, entity_docs, ["entity"], staging=staging).join(places, "row_no")
    shared = shared.where(F.col("n_t") <= limit(F.col("n_e")))
    if near is not None:
        shared = shared.withColumn(
            "places", F.filter("places", lambda p: _beside(p, F.col("at"), near))
        ).where(F.size("places") > 0)
    return shared.select("row_no", "entity", "term", "n_e", "n_t", "places")


def disclosing_terms(
    shared_terms: DataFrame,
    n_docs: int,
    *,
    min_docs: int = MIN_DOCS,
    generalise_at: float = GENERALISE_AT,
) -> DataFrame:
    """``entity, term, disclosure`` of the pairs at or above the threshold."""
    pairs = (
        shared_terms.groupBy("entity", "term")
        .agg(F.count(F.lit(1)).alias("n_et"), F.max("n_e").alias("n_e"), F.max("n_t").alias("n_t"))
        .where(F.col("n_et") >= min_docs)
    )
    whole = F.lit(float(n_docs))
    disclosure = F.log(whole * F.col("n_et") / (F.col("n_e") * F.col("n_t"))) / F.log(
        whole / F.col("n_e")
    )
    return pairs.select("entity", "term", disclosure.alias("disclosure")).where(
        F.col("disclosure") >= generalise_at
    )


def sanitise(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    near: int | None = None,
    min_term: int = MIN_TERM,
    min_docs: int = MIN_DOCS,
    generalise_at: float = GENERALISE_AT,
    remove_at: float = REMOVE_AT,
    keep_text: bool = True,
) -> DataFrame:
    """``doc_id, spans, terms`` and, if ``keep_text``, ``text`` and ``clean_text``.

    ``spans`` are the base spans (start, kind_no, end, entity), ``terms`` the added
    ones (start, end, disclosure, removed), both by start. Texts are written once
    to the staging folder if they are kept.
    """
    staging = Staging(docs.sparkSession, "disclosure")
    found = find_entities(docs, id_col, text_col)
    words = F.when(F.size("spans") > 0, placed_terms(F.col("text"), min_term)).otherwise(
        F.array().cast("array<struct<term:string,start:int,end:int>>")
    )
    found = found.withColumn("words", words)
    if not keep_text:
        found = found.drop("text")
    # Written row numbers stay the same, whatever is computed again.
    rows = staging.write(found.withColumn("row_no", F.monotonically_increasing_id()), "rows")
    term_docs = staging.write(
        docs.select(
            F.explode(distinct_terms(F.col(text_col).cast("string"), min_term)).alias("term")
        )
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("n_t")),
        "term-docs",
    )
    n_docs = rows.count()
    shared = staging.write(
        _shared_terms(rows, term_docs, n_docs, staging, near=near, generalise_at=generalise_at),
        "shared",
    )
    strong = staging.write(
        disclosing_terms(shared, n_docs, min_docs=min_docs, generalise_at=generalise_at),
        "strong",
    )
    terms = (
        shared.select("row_no", "entity", "term", "places")
        .join(strong, ["entity", "term"])
        .select("row_no", "disclosure", F.explode("places").alias("p"))
        .groupBy("row_no", "p.start", "p.end")
        .agg(F.max("disclosure").alias("disclosure"))
        .groupBy(F.col("row_no").alias("t_row_no"))
        .agg(
            F.array_sort(
                F.collect_list(
                    F.struct(
                        "start",
                        "end",
                        "disclosure",
                        (F.col("disclosure") >= remove_at).alias("removed"),
                    )
                )
            ).alias("terms")
        )
    )
    joined = rows.join(
        terms.hint("shuffle_hash"), F.col("row_no") == F.col("t_row_no"), "left"
    ).select(
        *[c for c in rows.columns if c not in ("row_no", "spans", "words")],
        "spans",
        F.coalesce(
            "terms",
            F.array().cast("array<struct<start:int,end:int,disclosure:double,removed:boolean>>"),
        ).alias("terms"),
    )
    return joined.withColumn("clean_text", clean_text()) if keep_text else joined


def clean_text() -> Column:
    """The text with spans masked, and terms removed or replaced by a general word.

    Spans that overlap are masked as one, under the first one's kind.
    """
    kinds = F.array(*[F.lit(f"<{k}>") for k in KINDS])
    base = F.transform(
        "spans",
        lambda s: F.struct(
            s["start"].alias("start"),
            s["end"].alias("end"),
            F.get(kinds, s["kind_no"]).alias("mask"),
        ),
    )
    added = F.transform(
        "terms",
        lambda t: F.struct(
            t["start"].alias("start"),
            t["end"].alias("end"),
            F.when(t["removed"], "").otherwise("<word>").alias("mask"),
        ),
    )

    def masked(done: Column, span: Column) -> Column:
        after = done["end"] <= span["start"]
        return F.struct(
            F.greatest(done["end"], span["end"]).alias("end"),
            F.when(
                after,
                F.concat(
                    done["out"],
                    F.substring(F.col("text"), done["end"] + 1, span["start"] - done["end"]),
                    span["mask"],
                ),
            )
            .otherwise(done["out"])
            .alias("out"),
        )

    return F.aggregate(
        F.array_sort(F.concat(base, added)),
        F.struct(F.lit(0).alias("end"), F.lit("").alias("out")),
        masked,
        lambda done: F.concat(
            done["out"], F.substring(F.col("text"), done["end"] + 1, F.length("text"))
        ),
    )


def span_list(with_terms: bool) -> Column:
    """``kind:start:end`` by start, then kind, comma-joined."""
    names = F.array(*[F.lit(k) for k in (*KINDS, TERM)])
    spans = F.transform(
        "spans",
        lambda s: F.struct(
            s["start"].alias("start"), s["kind_no"].alias("kind_no"), s["end"].alias("end")
        ),
    )
    if with_terms:
        terms = F.transform(
            "terms",
            lambda t: F.struct(
                t["start"].alias("start"),
                F.lit(len(KINDS)).alias("kind_no"),
                t["end"].alias("end"),
            ),
        )
        spans = F.array_sort(F.concat(spans, terms))
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", F.get(names, s["kind_no"]), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def kind_count(kind: str) -> Column:
    no = KINDS.index(kind)
    return F.size(F.filter("spans", lambda s: s["kind_no"] == no)).cast("long")
