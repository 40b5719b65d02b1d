"""Personal data: base patterns, and terms that reveal what they stand beside; built-in functions only.

Base spans are e-mail addresses, IP addresses, card and phone numbers. Every distinct value is a
protected entity. The corpus tells how strongly a term reveals it: with document counts, the
pointwise mutual information of entity and term over the information content of the entity,

    ratio = log(n_et * N / (n_e * n_t)) / log(N / n_e),

is 1 when the term is found with the entity only, and 0 when it tells nothing. Terms that share
two documents or more with an entity, wherever they stand in them, are generalised from
``GENERALISE`` on and removed from ``REMOVE`` on: every occurrence in every document, with the
entity or without. A term is a word outside all base spans. Counts are taken over all documents.

Spans count code points, the end exclusive. A regular expression gives the matches, a split by it
the lengths between them. The patterns below find what the plain ones in ``PLAIN`` find; look-behind
and possessive repetition only keep long runs of characters from being tried again and again, and
the stack flat. Defined results: NULL text is empty in counts and stays NULL when sanitised; rows
that repeat count as documents of their own; nothing reveals an
entity that is in every document; an empty table gives an empty one; very long texts are searched
whole; other columns, of any name, come back unchanged from ``sanitise``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pipewatch.llm.bloom import bit_table, filter_bits, with_hits
from pipewatch.llm.common import whole_text, with_plain_names, written

#: The patterns as they are meant, matched leftmost and without overlap.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# A text without this has no such match.
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
LABELS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]"}

TERM = r"\p{L}{3,}+"
TOGETHER = 2
GENERALISE, REMOVE = 0.9, 0.97
GENERALISED = "[TERM]"

_PLACES = "array<struct<value:string,start:bigint,end:bigint>>"
_TERMS = "array<struct<start:bigint,end:bigint,ratio:double>>"
_SPANS = "array<struct<kind:string,value:string,start:bigint,end:bigint>>"


def located(text: Column, pattern: str | Column) -> Column:
    """All matches of a pattern as ``value, start, end``."""
    none = F.array().cast(_PLACES)

    def places(found: Column) -> Column:
        gaps = F.slice(F.split(text, pattern, -1), 1, F.size(found))
        pairs = F.zip_with(gaps, found, lambda g, m: F.struct(g.alias("g"), m.alias("m")))
        begin = F.struct(F.lit(0).cast("long").alias("at"), none.alias("out"))

        def step(state: Column, pair: Column) -> Column:
            start = (state["at"] + F.length(pair["g"])).cast("long")
            end = (start + F.length(pair["m"])).cast("long")
            place = F.struct(pair["m"].alias("value"), start.alias("start"), end.alias("end"))
            return F.struct(end.alias("at"), F.concat(state["out"], F.array(place)).alias("out"))

        return F.aggregate(pairs, begin, step, lambda state: state["out"])

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    # The matches are bound to a name, so that they are looked for once.
    return F.transform(F.array(found), lambda m: F.when(F.size(m) > 0, places(m)).otherwise(none))[0]


def _luhn(digits: Column) -> Column:
    backwards = F.reverse(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(backwards, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def is_valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"^{BYTE}(?:\.{BYTE}){{3}}$")
    if kind == "email":
        return F.lit(True)
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "card":
        return F.when(F.length(digits).between(16, 19), _luhn(digits)).otherwise(False)
    return F.length(digits).between(8, 15)


def base_spans(text: Column) -> Column:
    """``kind, value, start, end`` of the base kinds, by kind as listed, then start."""
    return F.concat(*[_spans_of(text, kind) for kind in PATTERNS]).cast(_SPANS)


def _spans_of(text: Column, kind: str) -> Column:
    own = located(text, PATTERNS[kind])
    if NEEDS[kind]:
        own = F.when(F.contains(text, F.lit(NEEDS[kind])), own).otherwise(F.array().cast(_PLACES))
    own = F.filter(own, lambda s: is_valid(kind, s["value"]))
    named = lambda s: F.struct(F.lit(kind).alias("kind"), s["value"].alias("value"), s["start"].alias("start"), s["end"].alias("end"))
    return F.transform(own, named)


def _count(kind: str) -> Column:
    return F.size(F.filter("_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def masked(text: Column, spans: Column) -> Column:
    """``text`` with a digit for each character of a span, so that places stay and no term reaches into one."""
    begin = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))

    def step(state: Column, span: Column) -> Column:
        between = F.substring(text, (state["at"] + 1).cast("int"), F.greatest(span["start"] - state["at"], F.lit(0)).cast("int"))
        hidden = F.repeat(F.lit("0"), F.greatest(span["end"] - F.greatest(state["at"], span["start"]), F.lit(0)).cast("int"))
        return F.struct(F.greatest(state["at"], span["end"]).alias("at"), F.concat(state["out"], F.array(between, hidden)).alias("out"))

    def end(state: Column) -> Column:
        return F.concat(F.array_join(state["out"], ""), F.substring(text, (state["at"] + 1).cast("int"), F.length(text)))

    places = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))
    return F.when(F.size(spans) > 0, F.aggregate(places, begin, step, end)).otherwise(text)


def _digest(text: str) -> Column:
    return F.unhex(F.sha2(whole_text(text), 256))


def corpus_terms(docs: DataFrame, text: str = "text") -> DataFrame:
    """``_row``, ``_digest`` of the text, ``_entities`` and ``_terms``: its distinct values and terms in lower case; a table without texts."""
    body = whole_text(text)
    spanned = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(text), _digest(text).alias("_digest"), base_spans(body).alias("_spans"))
    values = F.array_distinct(F.transform("_spans", lambda s: F.lower(s["value"])))
    words = F.array_distinct(F.regexp_extract_all(masked(body, F.col("_spans")), F.lit(TERM), F.lit(0)))
    terms = F.array_distinct(F.transform(words, F.lower))
    return written(spanned.select("_row", "_digest", values.alias("_entities"), terms.alias("_terms")), "personal-terms-of")


def _terms_of(marked: DataFrame, *columns: str) -> DataFrame:
    return marked.select(*columns, F.explode("_terms").alias("term"))


def disclosures(marked: DataFrame) -> DataFrame:
    """``term, ratio`` of the terms that reveal an entity of the same document, by the entity they reveal most.

    A ratio from ``GENERALISE`` on needs ``n_t <= n_e ** GENERALISE * N ** (1 - GENERALISE)``, as ``n_et`` is
    ``n_e`` at most, so commoner terms are left before they are paired. Documents with the same entities
    and terms are added up first.
    """
    total = float(marked.count())
    some = marked.where(F.size("_entities") > 0)
    own = some.select("_row", F.explode("_entities").alias("entity"))
    entities = own.groupBy("entity").agg(F.count(F.lit(1)).alias("n_e"))
    # An entity of every document carries no information, and its ratio would be one of zeros.
    entities = entities.where((F.col("n_e") >= TOGETHER) & (F.col("n_e") < total))
    entities = written(entities, "personal-entities")

    def most(n_e: Column) -> Column:
        # The margin is for rounding only; the ratio itself decides.
        return F.pow(n_e, F.lit(GENERALISE)) * F.lit(total ** (1 - GENERALISE) * (1 + 1e-9))

    limit = entities.agg(F.coalesce(most(F.max("n_e")), F.lit(0.0))).first()[0]
    named = own.join(entities, "entity").groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("entity", "n_e"))).alias("_named"))
    beside = written(some.select("_row", "_terms").join(named, "_row"), "personal-beside")
    # Only terms that two documents with such entities hold can reveal one; a Bloom filter lets go of the others before they are counted.
    near = _terms_of(beside).groupBy("term").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= TOGETHER).select("term")
    near = written(near, "personal-near")
    bits = filter_bits(near.count())
    maybe = with_hits(_terms_of(marked), bit_table(near, bits), bits, F.col("term"), "_maybe").where("_maybe")
    terms = maybe.groupBy("term").agg(F.count(F.lit(1)).alias("n_t")).where(F.col("n_t") <= limit).join(near, "term", "left_semi")
    terms = written(terms, "personal-terms")
    said = _terms_of(beside, "_row").join(terms, "term").groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("term", "n_t"))).alias("_terms"))
    alike = beside.select("_row", F.col("_named").alias("_entities")).join(said, "_row")
    alike = alike.groupBy("_entities", "_terms").agg(F.count(F.lit(1)).alias("n"))
    pairs = alike.select("n", "_terms", F.explode("_entities").alias("e"))
    pairs = pairs.select("n", "e", F.explode(F.filter("_terms", lambda t: t["n_t"] <= most(F.col("e.n_e")))).alias("t"))
    pairs = pairs.groupBy("e.entity", "e.n_e", "t.term", "t.n_t").agg(F.sum("n").alias("n_et")).where(F.col("n_et") >= TOGETHER)
    ratio = F.log(F.col("n_et") * F.lit(total) / (F.col("n_e") * F.col("n_t"))) / F.log(F.lit(total) / F.col("n_e"))
    found = pairs.select("term", ratio.alias("ratio")).where(F.col("ratio") >= GENERALISE)
    return written(found.groupBy("term").agg(F.max("ratio").alias("ratio")), "personal-disclosures")


def revealing_terms(marked: DataFrame) -> DataFrame:
    """``_digest`` of each text with revealing terms, and ``_ratios`` of these by term.

    A Bloom filter of the revealing terms lets go of the others before any shuffle; texts that repeat are one row.
    """
    found = disclosures(marked)
    bits = filter_bits(found.count())
    maybe = with_hits(_terms_of(marked, "_digest"), bit_table(found.select("term"), bits), bits, F.col("term"), "_maybe").where("_maybe")
    hits = maybe.join(found, "term").groupBy("_digest").agg(F.map_from_entries(F.collect_set(F.struct("term", "ratio"))).alias("_ratios"))
    return written(hits, "personal-hits")


def term_places(text: Column, ratios: Column) -> Column:
    """``start, end, ratio`` of every word of ``text`` whose lower case is a key of ``ratios``, by start."""
    found = F.regexp_extract_all(text, F.lit(TERM), F.lit(0))

    def places(words: Column) -> Column:
        gaps = F.slice(F.split(text, TERM, -1), 1, F.size(words))
        pairs = F.zip_with(gaps, words, lambda g, w: F.struct(F.length(g).alias("gap"), F.length(w).alias("size"), F.try_element_at(ratios, F.lower(w)).alias("ratio")))
        begin = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(_TERMS).alias("out"))

        def step(state: Column, pair: Column) -> Column:
            start = state["at"] + pair["gap"]
            end = start + pair["size"]
            place = F.struct(start.alias("start"), end.alias("end"), pair["ratio"].alias("ratio"))
            out = F.when(pair["ratio"].isNotNull(), F.concat(state["out"], F.array(place))).otherwise(state["out"])
            return F.struct(end.alias("at"), out.alias("out"))

        return F.aggregate(pairs, begin, step, lambda state: state["out"])

    # The words are bound to a name, so that they are looked for once.
    return F.transform(F.array(found), places)[0]


def with_added(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus ``_spans`` and ``_added``: ``start, end, ratio`` of every revealing term in every document, by start (NULL: none).

    A Bloom filter of the texts with revealing terms lets all others pass straight through; only what hits it is joined.
    """
    hits = revealing_terms(corpus_terms(docs, text))
    bits = filter_bits(hits.count())
    digested = docs.withColumn("_digest", _digest(text))
    tested = with_hits(digested, bit_table(hits.select("_digest"), bits), bits, F.col("_digest"), "_maybe")
    spans = base_spans(whole_text(text)).alias("_spans")
    own = [F.col(c) for c in docs.columns]
    alone = tested.where(~F.col("_maybe")).select(*own, spans, F.lit(None).cast(_TERMS).alias("_added"))
    joined = tested.where("_maybe").join(hits, "_digest", "left").select(*own, spans, "_ratios")
    places = term_places(masked(whole_text(text), F.col("_spans")), F.col("_ratios"))
    added = F.when(F.col("_ratios").isNotNull(), places).alias("_added")
    return alone.unionByName(joined.select(*own, "_spans", added))


def spans_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_personal_data(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, counts by kind, ``base_sha256``, ``spans`` and ``n_terms``."""
    marked = with_added(docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")), "_text")
    terms = F.transform("_added", lambda t: F.struct(F.lit("term").alias("kind"), t["start"].alias("start"), t["end"].alias("end")))
    base = spans_text(F.col("_spans"))
    every = F.array_join(F.filter(F.array(base, spans_text(terms)), lambda s: s != ""), ",")
    return marked.select(
        F.col("_key").alias(key), *map(_count, PATTERNS), F.sha2(base, 256).alias("base_sha256"), every.alias("spans"), F.coalesce(F.size("_added"), F.lit(0)).alias("n_terms")
    ).withColumn("n_terms", F.greatest("n_terms", F.lit(0)))


def _replaced(text: Column, spans: Column) -> Column:
    """``text`` with ``label`` for each span (``start, end, label``, sorted); of overlapping ones the first."""
    begin = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))

    def step(state: Column, span: Column) -> Column:
        between = F.substring(text, (state["at"] + 1).cast("int"), (span["start"] - state["at"]).cast("int"))
        piece = F.when(span["start"] >= state["at"], F.array(between, span["label"])).otherwise(F.array().cast("array<string>"))
        return F.struct(F.greatest(state["at"], span["end"]).alias("at"), F.concat(state["out"], piece).alias("out"))

    def end(state: Column) -> Column:
        rest = F.substring(text, (state["at"] + 1).cast("int"), F.length(text))
        return F.concat(F.array_join(state["out"], ""), rest)

    return F.aggregate(spans, begin, step, end)


def sanitise(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every base span replaced by its label, and revealing terms generalised or removed in every text.

    Other columns, of any name, come back unchanged.
    """
    return with_plain_names(docs, _sanitised, text=text)


def _sanitised(docs: DataFrame, text: str) -> DataFrame:
    marked = with_added(docs, text)
    label = F.create_map(*[x for k, v in LABELS.items() for x in (F.lit(k), F.lit(v))])
    base = F.transform("_spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), label[s["kind"]].alias("label")))
    term = F.transform(
        F.coalesce("_added", F.array().cast(_TERMS)),
        lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"), F.when(t["ratio"] >= REMOVE, "").otherwise(GENERALISED).alias("label")),
    )
    new = F.when((F.size("_spans") > 0) | F.col("_added").isNotNull(), _replaced(F.col(text), F.array_sort(F.concat(base, term)))).otherwise(F.col(text))
    rebuilt = marked.withColumn("_new", new)
    return rebuilt.select(*[F.col("_new").alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])
