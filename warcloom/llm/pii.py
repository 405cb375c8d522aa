"""Information-theoretic sanitisation of personal data, in DataFrame functions only.

Protected entities are what four patterns find: e-mail and IP addresses, payment
cards (Luhn) and phone numbers. What remains of a text may still reveal them,
so corpus co-occurrence measures how much each term gives away:

    PMI(term; entity) = log( p(term, entity) / (p(term) p(entity)) )
    IC(entity)        = -log p(entity)

Probabilities are shares of documents. A term that reaches
``PMI >= threshold * IC`` tells that share of what the entity itself would tell,
and is treated as a disclosure wherever a document holds that entity. Terms are
words of at least three letters anywhere in a document that holds the entity. A
pair needs ``support`` distinct texts, or all texts of an entity that has fewer.

Entities are replaced by their kind, disclosing terms are generalised to
``[TERM]`` (``action="generalise"``) or removed (``action="remove"``).

Every pattern is written with possessive repeats and starts where a run of its
first characters starts, which keeps matching linear on long runs and gives the
same leftmost matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

# The kinds, in the order in which spans are listed, and their patterns.
KINDS = ("email", "ip", "card", "phone")
_PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without this match has no span of the kind; cheap to test.
_HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][0-9 -]{11}", "phone": r"\+[0-9]"}
_SPANS = "array<struct<kind:string,rank:int,start:bigint,stop:bigint,value:string>>"
_NONE = f"cast(array() as {_SPANS})"
#: Word characters of a term, and how many of them it needs.
_WORD = r"\p{L}+"
_TERM_RANK = len(KINDS)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Every second digit from the right doubled, digit sums added, divisible by ten."""
    figures = F.split(F.reverse(digits), "")

    def add(total: Column, place: Column) -> Column:
        d = F.element_at(figures, place).cast("int")
        twice = d * 2
        return total + F.when(place % 2 == 1, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        # At most 255, however many leading zeros.
        return F.forall(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", "").rlike("^([0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    digits = _digits(value)
    if kind == "card":
        # The length is tested first: a long run of digits never reaches the sum.
        return F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(False)
    return F.length(digits).between(9, 15)


def _places(text: Column, kind: str) -> Column:
    """All matches of a kind with their place in code points.

    Splitting by the pattern gives the gaps between matches, so a running sum of
    the lengths of gaps and matches gives every start.
    """
    pattern = F.lit(_PATTERNS[kind])
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    gaps = F.split(text, _PATTERNS[kind], -1)
    steps = F.zip_with(
        found, F.slice(gaps, F.lit(1), F.size(found)),
        lambda value, gap: F.struct(F.length(gap).cast("bigint").alias("gap"), F.length(value).cast("bigint").alias("size"), value.alias("value")),
    )
    empty = F.struct(F.lit(0).cast("bigint").alias("at"), F.expr(_NONE).alias("spans"))

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + x["gap"]
        span = F.struct(
            F.lit(kind).alias("kind"), F.lit(KINDS.index(kind)).alias("rank"), start.alias("start"),
            (start + x["size"]).alias("stop"), x["value"].alias("value"))
        return F.struct((start + x["size"]).alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

    spans = F.aggregate(steps, empty, step, lambda state: state["spans"])
    return F.filter(spans, lambda s: _valid(kind, s["value"]))


def base_spans(text: Column) -> Column:
    """Spans of the four kinds by kind and start; an empty list for null or empty text."""
    whole = F.coalesce(text, F.lit(""))
    found = [F.when(whole.rlike(_HINTS[k]), _places(whole, k)).otherwise(F.expr(_NONE)) for k in KINDS]
    return F.concat(*found)


def spans_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def disclosing_terms(docs: DataFrame, held: DataFrame, threshold: float = 0.9, support: int = 3) -> DataFrame:
    """(entity, term, pmi, ic) at or over the threshold.

    ``held`` has the rows of ``docs`` with an entity and their ``base`` spans.
    Counts are of documents: a term's are those that hold it as a word, an
    entity's those that hold it as a span, a pair's those that hold both, at any
    distance. Only support is counted in distinct texts.
    """
    documents = docs.count()
    texts = held.groupBy(F.sha2("text", 256).alias("_key"))
    entities_of = F.explode(F.array_distinct(F.transform("base", lambda s: s["value"]))).alias("entity")
    holds = cut_lineage(texts.agg(F.count("*").alias("copies"), F.first("base").alias("base")).select("_key", "copies", entities_of))
    entities = holds.groupBy("entity").agg(F.sum("copies").alias("with_entity"), F.count("*").alias("texts"))
    holds = cut_lineage(holds.join(entities, "entity"))

    # A pair is in at most with_entity documents, so no more frequent term can reach the threshold; a hair of slack for rounding.
    most = F.pow(F.lit(float(documents)), F.lit(1 - threshold)) * F.pow("with_entity", F.lit(threshold)) * (1 + 1e-9)
    # Terms are many: they carry a number for their text, and the most frequent term it can use.
    once = cut_lineage(
        texts.agg(F.first("text").alias("text")).join(holds.groupBy("_key").agg(F.max(most).alias("most")), "_key")
        .withColumn("_id", F.monotonically_increasing_id()))
    holds = holds.join(once.select("_key", "_id"), "_key").drop("_key")

    def words_of(text: Column) -> Column:
        return F.explode(F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(_WORD), F.lit(0)))).alias("term")

    words = docs.select(words_of(F.col("text"))).where(F.length("term") >= 3).groupBy("term").agg(F.count("*").alias("with_term"))
    rare = (
        once.select("_id", "most", words_of(F.col("text"))).where(F.length("term") >= 3).join(words, "term")
        .where("with_term <= most").select("_id", "term", "with_term")
    )
    pairs = (
        rare.join(holds, "_id").where(F.col("with_term") <= most).groupBy("entity", "term", "with_entity", "with_term", "texts")
        .agg(F.sum("copies").alias("with_both"), F.count("*").alias("ways"))
        .where(F.col("ways") >= F.least(F.lit(support), F.col("texts")))
    )
    scored = (
        pairs.withColumn("ic", F.log(F.lit(documents) / F.col("with_entity")))
        .withColumn("pmi", F.log(F.col("with_both") * F.lit(documents) / (F.col("with_term") * F.col("with_entity"))))
    )
    # An entity that every document holds tells nothing (ic = 0).
    return scored.where((F.col("ic") > 0) & (F.col("pmi") >= threshold * F.col("ic"))).select("entity", "term", "pmi", "ic")


def _term_spans(text: Column, terms: Column) -> Column:
    """Places of whole words, in either case, that equal a disclosing term."""
    lowered = F.lower(text)
    same_length = F.length(lowered) == F.length(text)
    body = F.when(same_length, lowered).otherwise(text)
    words = F.regexp_extract_all(body, F.lit(_WORD), F.lit(0))
    gaps = F.split(body, _WORD, -1)
    steps = F.zip_with(words, F.slice(gaps, F.lit(1), F.size(words)), lambda w, gap: F.struct(
        F.length(gap).cast("bigint").alias("gap"), F.length(w).cast("bigint").alias("size"), F.array_contains(terms, F.lower(w)).alias("hit")))
    empty = F.struct(F.lit(0).cast("bigint").alias("at"), F.expr(_NONE).alias("spans"))

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + x["gap"]
        stop = start + x["size"]
        span = F.struct(
            F.lit("term").alias("kind"), F.lit(_TERM_RANK).alias("rank"), start.alias("start"), stop.alias("stop"),
            F.lit(None).cast("string").alias("value"))
        spans = F.when(x["hit"], F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct(stop.alias("at"), spans.alias("spans"))

    return F.aggregate(steps, empty, step, lambda state: state["spans"])


def find(docs: DataFrame, threshold: float = 0.9, support: int = 3) -> DataFrame:
    """``docs`` plus ``base`` and ``added``, lists of spans in code points.

    Null text counts as empty and has no span. Rows are neither merged nor
    dropped, and repeated rows get equal spans. Input columns named base or added
    are replaced; none may be named _key or _terms.
    """
    based = docs.withColumn("base", base_spans(F.col("text")))
    # Texts with entities are few; they are kept so that the counts need not search again.
    held = cut_lineage(based.where(F.size("base") > 0))
    pairs = disclosing_terms(docs, held, threshold, support).select("entity", "term")
    # Keyed by a digest of the text: equal texts have equal spans.
    keyed = held.withColumn("_key", F.sha2("text", 256))
    terms = (
        keyed.select("_key", F.explode(F.array_distinct(F.transform("base", lambda s: s["value"]))).alias("entity"))
        .distinct().join(pairs, "entity").groupBy("_key").agg(F.collect_set("term").alias("_terms"))
    )
    added = F.when(F.col("_terms").isNotNull(), _term_spans(F.col("text"), F.col("_terms"))).otherwise(F.expr(_NONE))
    apart = F.filter("added", lambda s: ~F.exists("base", lambda b: (s["start"] < b["stop"]) & (b["start"] < s["stop"])))
    marked = keyed.join(terms, "_key", "left").withColumn("added", added).withColumn("added", apart).drop("_key", "_terms")
    without = based.where(F.size("base") == 0).withColumn("added", F.expr(_NONE))
    return without.unionByName(marked)


def sanitised(text: Column, spans: Column, action: str = "generalise") -> Column:
    """The text with each span replaced; spans that overlap are replaced as one by the first kind."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), s["kind"].alias("kind"))))
    begin = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("parts"))
    source = F.coalesce(text, F.lit(""))

    def mark(kind: Column) -> Column:
        name = F.concat(F.lit("["), F.upper(kind), F.lit("]"))
        return F.when(kind == "term", F.lit("")).otherwise(name) if action == "remove" else name

    def step(state: Column, s: Column) -> Column:
        gap = F.substring(source, (state["at"] + 1).cast("int"), F.greatest(s["start"] - state["at"], F.lit(0)).cast("int"))
        parts = F.when(s["start"] >= state["at"], F.concat(state["parts"], F.array(gap, mark(s["kind"])))).otherwise(state["parts"])
        return F.struct(F.greatest(state["at"], s["stop"]).alias("at"), parts.alias("parts"))

    def finish(state: Column) -> Column:
        return F.concat(F.array_join(state["parts"], ""), F.substring(source, (state["at"] + 1).cast("int"), F.length(source)))

    return F.when(F.size(ordered) == 0, text).otherwise(F.aggregate(ordered, begin, step, finish))


def sanitise(docs: DataFrame, action: str = "generalise", **options) -> DataFrame:
    """``docs`` with personal data and the terms that disclose it replaced in ``text``; other columns stay."""
    packed = docs.select(F.struct(*docs.columns).alias("_row"), "text")
    clean = sanitised(F.col("text"), F.concat("base", "added"), action)
    return find(packed, **options).select(*[clean.alias(c) if c == "text" else F.col("_row")[c].alias(c) for c in docs.columns])
