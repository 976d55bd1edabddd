"""Removal of personal data and of the terms that give it away.

Patterns find e-mail and IP addresses, card and phone numbers. Terms beside them may
still disclose them: if nearly every document with a word also has a certain address,
the word stands for the address. How much a term t discloses of an entity e is
measured over the whole corpus:

    PMI(t; e) / IC(e),   PMI = log(co(t, e) * N / (df(t) * df(e))),   IC = log(N / df(e))

with document counts df, the number co of documents that have both t and e, and the
number N of documents. The ratio is 1 when t occurs only where e does. From a ratio of
``generalise`` on a term is generalised to its class, from ``remove`` on it is removed, in
the documents that have e.

A ratio says nothing where little was seen, so the co-occurrence must be more than
chance. Its evidence x is the number of documents or of different contexts (the two words
on either side), whichever is less: copies of a page, or of a phrase, are one context. With
L = df(t) * df(e) / N expected by chance, x or more have a probability of at most
(e * L / x)^x (Chernoff), which times the number of pairs tested may be no more than
``chance``. Pairs are tested for entities in two documents or more: a single one says no
more of one of its words than of another.

Everything is DataFrame code with built-in functions. Offsets come from the pieces
between matches, so the cost is linear in the length of a text. The patterns are
written without nested backtracking; they match what the plain forms beside them do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..sources.staging import stage
from .common import text_of

#: Kinds in their order, each with its pattern. A match that is taken
#: from the start of a run of characters, or from the end of the previous match, is
#: the leftmost one: any later start in the run would end in the same place.
#: email [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
#: ip [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)     card [0-9]([\x20-]?[0-9])+
#: phone \+[0-9][\x20().0-9-]+[0-9]
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = list(PATTERNS)
#: Cheap tests that a text must pass before its pattern is tried.
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9]", "phone": r"\+[0-9]"}
GENERALISED, REMOVED = "generalised", "removed"
MASKS = {kind: f"[{kind.upper()}]" for kind in KINDS}
WORD = r"\p{L}+"
PIECE = 256


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def passes_luhn(digits: Column) -> Column:
    """Whether the digits, up to 19 of them, pass the check of card numbers."""

    def weighed(at: Column) -> Column:
        digit = F.substring(digits, F.length(digits) - at, F.lit(1)).cast("int")
        double = F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
        return F.when(at % 2 == 1, double).otherwise(digit)

    at = F.sequence(F.lit(0), F.length(digits) - 1)
    return F.aggregate(F.transform(at, weighed), F.lit(0), lambda a, b: a + b) % 10 == 0


def is_valid(kind: str, value: Column) -> Column:
    """Whether a match of the kind's pattern is kept."""
    digits = digits_of(value)
    if kind == "ip":

        def small(part: Column) -> Column:
            plain = F.regexp_replace(part, "^0+(?=[0-9])", "")
            return F.when(F.length(plain) <= 3, plain.cast("int") <= 255).otherwise(False)

        return F.forall(F.split(value, r"\."), small)
    if kind == "card":
        return F.when(F.length(digits).between(16, 19), passes_luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


def entity_of(kind: str, value: Column) -> Column:
    """One name for all ways of writing an entity."""
    name = F.lower(value) if kind in ("email", "ip") else digits_of(value)
    return F.concat(F.lit(f"{kind}:"), name)


def matches(text: Column, pattern: Column) -> tuple[Column, Column]:
    """The matches of a pattern and the pieces of text before, between and after."""
    return F.regexp_extract_all(text, pattern, F.lit(0)), F.split(text, pattern, -1)


def kind_matches(kind: str, text: Column) -> Column:
    """The matches of a kind with the length of what stands before each, as an array."""
    found, pieces = matches(text, F.lit(PATTERNS[kind]))
    # Side by side, so that no element is looked up by its place in another array.
    zipped = F.arrays_zip(found.alias("value"), pieces.alias("before"))

    def describe(m: Column, at: Column) -> Column:
        return F.struct(
            F.lit(KINDS.index(kind)).alias("kind"),
            at.alias("at"),
            F.length(m["before"]).alias("gap"),
            F.length(m["value"]).alias("length"),
            is_valid(kind, m["value"]).alias("valid"),
            entity_of(kind, m["value"]).alias("entity"),
        )

    described = F.transform(F.filter(zipped, lambda m: m["value"].isNotNull()), describe)
    none = F.array().cast(
        "array<struct<kind:int,at:int,gap:int,length:int,valid:boolean,entity:string>>"
    )
    return F.when(text.rlike(HINTS[kind]), described).otherwise(none)


def with_matches(docs: DataFrame, text_col: str) -> DataFrame:
    """Every row as ``row`` with its ``text`` and the ``matches`` of all kinds."""
    text = text_of(docs, text_col)
    row = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    return docs.select(row, text.alias("text")).select(
        "row", "text", F.concat(*[kind_matches(k, F.col("text")) for k in KINDS]).alias("matches")
    )


def any_valid(found: str = "matches") -> Column:
    return F.exists(F.col(found), lambda m: m["valid"])


def spans_of(found: DataFrame) -> DataFrame:
    """Start and end of the matches, which come as ``key``, ``kind``, ``at``, ``gap``
    and ``length``; ends are exclusive, in code points."""
    so_far = W.partitionBy("key", "kind").orderBy("at").rowsBetween(W.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("length")).over(so_far)
    return found.withColumn("end", end).withColumn("start", F.col("end") - F.col("length"))


class Disclosure:
    """The rows with personal data and what gives it away. ``hits`` has ``key``, ``row``,
    ``text`` and ``matches`` of each row with a base span, ``rest`` the other rows;
    ``terms`` the terms to generalise and to remove by ``key``."""

    def __init__(
        self,
        docs: DataFrame,
        *,
        text_col: str = "text",
        chance: float = 0.05,
        generalise: float = 0.75,
        remove: float = 0.95,
    ) -> None:
        searched = with_matches(docs, text_col)
        self.rest = searched.where(~any_valid())
        hits = searched.where(any_valid())
        self.hits = stage(hits.withColumn("key", F.monotonically_increasing_id()), "personal")
        found = self.hits.select("key", F.explode("matches").alias("m")).where("m.valid")
        found = found.select("key", "m.entity").distinct()
        entities = found.groupBy("entity").agg(F.count(F.lit(1)).alias("df_e"))
        entities = stage(entities.where("df_e > 1"), "entities")
        found = stage(found.join(entities.select("entity"), "entity"), "row-entities")
        rows = self.hits.join(found.select("key"), "key", "left_semi")
        near = stage(terms_in_context(rows.select("key", "text")), "terms-in-context")
        near = near.join(found, "key")
        contexts = near.select("entity", "term", "context").distinct().groupBy("entity", "term")
        contexts = contexts.agg(F.count(F.lit(1)).alias("contexts"))
        near_terms = near.select("key", "entity", "term").distinct()
        pairs = near_terms.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("co"))
        pairs = stage(pairs.join(contexts, ["entity", "term"]), "entity-terms")
        terms = corpus_counts(docs, text_col)
        n, tests = F.lit(float(docs.count())), F.lit(float(max(1, pairs.count())))
        measured = pairs.join(entities, "entity").join(terms, "term")
        seen = F.least("co", "contexts")
        expected = F.col("df_t") * F.col("df_e") / n
        surprise = seen * (1 + F.log(expected / seen)) + F.log(tests)
        measured = measured.where((seen > expected) & (surprise <= F.log(F.lit(chance))))
        mutual = F.log(F.col("co") * n / (F.col("df_t") * F.col("df_e")))
        own = F.log(n / F.col("df_e"))
        measured = measured.withColumn("ratio", F.when(own > 0, mutual / own).otherwise(F.lit(0.0)))
        self.measured = measured
        telling = stage(measured.where(F.col("ratio") >= generalise), "telling-terms")
        self.terms = stage(
            near_terms.join(telling, ["entity", "term"])
            .groupBy("key", "term")
            .agg(F.max("ratio").alias("ratio"))
            .groupBy("key")
            .agg(
                F.array_sort(F.collect_list(F.when(F.col("ratio") < remove, F.col("term")))).alias(
                    GENERALISED
                ),
                F.array_sort(F.collect_list(F.when(F.col("ratio") >= remove, F.col("term")))).alias(
                    REMOVED
                ),
            ),
            "row-terms",
        )
        base = self.hits.select("key", F.explode("matches").alias("m")).select("key", "m.*")
        self.base = stage(
            spans_of(base).where("valid").select("key", "kind", "start", "end"), "base-spans"
        )

    def term_spans(self) -> DataFrame:
        """``key``, ``kind``, ``start`` and ``end`` of telling terms outside base spans."""
        clear = self.base.select("key", F.col("start").alias("from"), F.col("end").alias("to"))
        parts = []
        for kind, column in enumerate((GENERALISED, REMOVED), len(KINDS)):
            telling = self.terms.where(F.size(column) > 0).select("key", column)
            rows = self.hits.select("key", "text").join(telling, "key")
            rows = rows.select("key", "text", term_pattern(F.col(column)).alias("pattern"))
            found = F.posexplode(term_matches(F.col("text"), F.col("pattern"))).alias("at", "m")
            rows = rows.select("key", found).select("key", F.lit(kind).alias("kind"), "at", "m.*")
            parts.append(spans_of(rows).select("key", "kind", "start", "end"))
        spans = parts[0].union(parts[1])
        inside = (F.col("start") < F.col("to")) & (F.col("from") < F.col("end"))
        met = (spans["key"] == clear["key"]) & inside
        return spans.join(clear, met, "left_anti")


def terms_in_context(rows: DataFrame) -> DataFrame:
    """Each ``term`` of the rows ``key``, ``text`` with its ``context``: a hash of the two
    words before it and the two after it. E-mail addresses hold no terms."""
    plain = F.regexp_replace("text", PATTERNS["email"], " ")
    rows = rows.select("key", F.regexp_extract_all(F.lower(plain), F.lit(WORD), F.lit(0)).alias("w"))
    words, none = F.col("w"), F.lit("")
    zipped = F.arrays_zip(
        words.alias("term"),
        F.concat(F.array(none, none), words).alias("a"),
        F.concat(F.array(none), words).alias("b"),
        F.slice(words, 2, F.greatest(F.size(words), F.lit(1))).alias("c"),
        F.slice(words, 3, F.greatest(F.size(words), F.lit(1))).alias("d"),
    )
    found = rows.select("key", F.explode(zipped).alias("z")).where("z.term is not null")
    around = F.xxhash64("z.a", "z.b", F.coalesce("z.c", none), F.coalesce("z.d", none))
    return found.select("key", "z.term", around.alias("context"))


def corpus_counts(docs: DataFrame, text_col: str) -> DataFrame:
    """Number of documents with each ``term``, over the whole corpus. Each task combines
    the terms that it reads, so what is shuffled follows the vocabulary."""
    words = F.regexp_extract_all(F.lower(text_of(docs, text_col)), F.lit(WORD), F.lit(0))
    found = docs.select(F.explode(F.array_distinct(words)).alias("term"))
    return found.groupBy("term").agg(F.count(F.lit(1)).alias("df_t"))


def term_pattern(terms: Column) -> Column:
    """A pattern of whole words, in either case; terms hold letters only."""
    words = F.array_join(terms, "|")
    return F.concat(
        F.lit(r"(?iu)(?<![\p{L}\p{N}_])(?:"), words, F.lit(r")(?![\p{L}\p{N}_])")
    )


def term_matches(text: Column, pattern: Column) -> Column:
    """The matches of a pattern of terms, with the length of the piece before each."""
    found, pieces = matches(text, pattern)

    def describe(value: Column, before: Column) -> Column:
        return F.struct(F.length(before).alias("gap"), F.length(value).alias("length"))

    # One piece more than matches: what follows the last one.
    return F.filter(F.zip_with(found, pieces, describe), lambda m: m["length"].isNotNull())


def personal_spans(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **thresholds: float
) -> DataFrame:
    """Per row: ``id_col``, the number of spans of each base kind as ``n_<kind>``, the
    base spans as text in ``base`` and all spans in ``spans``: ``kind:start:end`` by kind,
    then start, joined by commas.

    Null text counts as empty and has no span. Rows that repeat an id are rows of their
    own; other columns are not read. An empty table gives an empty result."""
    docs = docs.select(docs[id_col].alias("id"), text_of(docs, text_col).alias("text"))
    found = Disclosure(docs, text_col="text", **thresholds)
    names = F.array(*[F.lit(k) for k in (*KINDS, GENERALISED, REMOVED)])
    spans = found.base.union(found.term_spans())

    def written(some: Column) -> Column:
        def one(s: Column) -> Column:
            return F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])

        return F.array_join(F.transform(some, one), ",")

    per_row = spans.groupBy("key").agg(
        F.array_sort(F.collect_list(F.struct("kind", "start", "end"))).alias("all")
    )
    plain = F.filter("all", lambda s: s["kind"] < len(KINDS))

    def count_of(k: int) -> Column:
        return F.size(F.filter("all", lambda s: s["kind"] == k)).cast("long")

    counts = [count_of(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    with_spans = found.hits.select("key", F.col("row.id").alias("id")).join(per_row, "key")
    with_spans = with_spans.select(
        "id", *counts, written(plain).alias("base"), written(F.col("all")).alias("spans")
    )
    nothing = [F.lit(0).cast("long").alias(f"n_{kind}") for kind in KINDS]
    rest = found.rest.select(
        F.col("row.id").alias("id"), *nothing, F.lit("").alias("base"), F.lit("").alias("spans")
    )
    return with_spans.unionByName(rest).withColumnRenamed("id", id_col)


def mask_kind(kind: str, text: Column) -> Column:
    """``text`` with the valid matches of a kind replaced by the kind's name."""
    found, pieces = matches(text, F.lit(PATTERNS[kind]))

    def one(piece: Column, value: Column) -> Column:
        shown = F.when(value.isNull(), "").when(is_valid(kind, value), MASKS[kind]).otherwise(value)
        return F.concat(piece, shown)

    masked = F.array_join(F.zip_with(pieces, found, one), "")
    return F.when(text.rlike(HINTS[kind]), masked).otherwise(text)


def merged(spans: DataFrame) -> DataFrame:
    """``key``, ``start``, ``end`` and ``mask`` of base spans; those that overlap, of
    whatever kinds, are one span with the names of all of them."""
    order = W.partitionBy("key").orderBy("start", "end", "kind")
    before = F.max("end").over(order.rowsBetween(W.unboundedPreceding, -1))
    opens = F.when(F.col("start") < before, 0).otherwise(1)
    runs = spans.withColumn("opens", opens).withColumn("run", F.sum("opens").over(order))
    first = F.struct("start", "kind")
    runs = runs.groupBy("key", "run", "kind").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.min(first).alias("first")
    )
    masks = F.array(*[F.lit(MASKS[k]) for k in KINDS])
    named = F.transform(F.array_sort(F.collect_list("first")), lambda f: F.get(masks, f["kind"]))
    return runs.groupBy("key", "run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.array_join(named, "").alias("mask")
    )


def without_spans(text: Column, blocks: Column, cuts: Column) -> Column:
    """``text`` with other words in place of the cuts, which are sorted and do not overlap:
    structs of ``since`` (the end of the cut before), ``start`` and ``mask``; the last one
    stands for the end. ``blocks`` is the text in pieces of ``PIECE`` characters, so what is
    between two cuts is found without reading from the start."""

    def kept(cut: Column) -> Column:
        first = F.floor(cut["since"] / PIECE).cast("int")
        count = F.floor(cut["start"] / PIECE).cast("int") - first + 1
        near = F.array_join(F.slice(blocks, first + 1, count), "")
        at = (cut["since"] % PIECE + 1).cast("int")
        between = F.substring(near, at, (cut["start"] - cut["since"]).cast("int"))
        return F.concat(between, cut["mask"])

    return F.array_join(F.transform(cuts, kept), "")


def sanitise(docs: DataFrame, *, text_col: str = "text", **thresholds: float) -> DataFrame:
    """``docs`` with personal data replaced by its kind, telling terms generalised to
    ``[TERM]`` or removed. All rows and columns stay; other rows are unchanged.

    All spans are those of the given text and are cut out at once, so one that overlaps
    another goes whole. A null text stays null; empty texts, texts of any length, rows that
    repeat and columns of any name are dealt with alike. An empty table stays empty."""
    columns = docs.columns
    found = Disclosure(docs, text_col=text_col, **thresholds)
    terms = found.term_spans().select(
        "key", "start", "end", F.when(F.col("kind") == len(KINDS), "[TERM]").otherwise("").alias("mask")
    )
    spans = merged(found.base).drop("run").unionByName(terms)
    order = W.partitionBy("key").orderBy("start")
    since = F.coalesce(F.lag("end").over(order), F.lit(0)).alias("since")
    cuts = spans.select("key", since, "start", "end", "mask").groupBy("key").agg(
        F.array_sort(F.collect_list(F.struct("since", "start", "mask"))).alias("cuts"),
        F.max("end").alias("stop"),
    )
    hits = found.hits.join(cuts, "key")
    end = F.struct(F.col("stop").alias("since"), F.length("text").cast("long").alias("start"), F.lit("").alias("mask"))
    blocks = F.regexp_extract_all("text", F.lit(rf"(?s).{{1,{PIECE}}}"), F.lit(0))
    hits = hits.withColumn("blocks", blocks).withColumn("cuts", F.concat("cuts", F.array(end)))
    hits = hits.withColumn("text", without_spans(F.col("text"), F.col("blocks"), F.col("cuts")))
    # What a dropped match hid may be one now: digits beside an address that is gone.
    for kind in KINDS:
        hits = hits.withColumn("text", mask_kind(kind, F.col("text")))
    cleaned = hits.select(
        *[F.col("text" if c == text_col else "row." + f"`{c}`").alias(c) for c in columns]
    )
    return cleaned.union(found.rest.select("row.*"))
