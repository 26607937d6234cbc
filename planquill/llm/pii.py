"""Personal data: fixed patterns, and terms that disclose what they stand with.

Base spans come from patterns with digit checks. Their values are the protected entities. All words (letters,
marks and digits, of any length, that touch no base span) of a document that holds an entity are counted against it
over the corpus. With n(e), n(t) and n(e, t) documents of n that hold entity, term and both, p(e) = n(e) / n, and the
chance of the entity beside the term estimated with one more observation that says nothing,
p(e | t) = (n(e, t) + p(e)) / (n(t) + 1), a term discloses PMI(e; t) = log p(e | t) / p(e) of the entity's information
-log p(e), and leaves -log p(e | t). The one observation holds back what is seen once: a term that stands nowhere
but beside an entity leaves a full bit if seen in one document, and ever less the more documents say so.

A term is sanitised that discloses ``SHARE`` or more of an entity's information and leaves ``GENERALISE`` bits
or less: removed (replaced by ``GONE``) where it leaves ``REMOVE`` bits or less, else generalised to its category (number, code, name
or word), which half the corpus shares. It goes wherever it stands in documents that hold personal data, and with ``everywhere`` in all
others too, as it discloses its entity there as well. Those are read once more, and only for terms that more documents hold
than those with base spans.

Entities that are in the same documents are one class, as nothing tells them apart: a text with very many
addresses is counted once against its words, not once for each.

Everything here is DataFrame and SQL functions. Counts cover all documents. Places come from running sums over chunks
of the square root of their number, so a text with very many spans costs little more than its length.

Defined results: null and empty texts have no spans; texts are taken whole; rows with equal text
get equal spans and count as documents of their own; null ids pass through; an empty table gives an empty result;
other columns are kept by ``sanitise`` and ignored by ``find``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import documents_of, dropped, key128, let, stored

KINDS = ("email", "ip", "card", "phone")
#: The stated base patterns. Where a run of one character class can only match from its start, that is
#: said by lookbehind (or the end of the match before), and quantifiers without need to give back are possessive:
#: the same matches in linear time. Chains of under 16 digits are never cards, so none is matched.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){15,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Stands for each letter, mark and digit of a base span, so that words keep their places; in no valid text.
HIDDEN = "\uffff"
WORD = r"\p{L}\p{M}\p{N}"
TERM = rf"[{WORD}{HIDDEN}]++"
#: Bits that a term may leave of an entity and be removed, or be generalised; and the share of its information that it must disclose.
REMOVE = 0.75
GENERALISE = 1.0
SHARE = 0.85
#: What is left of a removed term: with nothing there, its neighbours could join to a new address or number.
GONE = "[]"
#: Rows of keys or of disclosing terms that are broadcast at most, some 50 bytes each; more are joined by shuffle.
BROADCAST_ROWS = 200_000

SPAN = "struct<kind:int,start:int,end:int,value:string>"
ADDED = "array<struct<start:int,end:int,action:string,term:string>>"


def running(items: Column, value: Callable[[Column], Column], combine: Callable[[Column, Column], Column]) -> Column:
    """For each item the combination of the values before it, from 0. Arrays are folded in chunks of the
    square root of their size, as a fold that appends costs the square of what it makes."""

    def folded(xs: Column, start: Column, of: Callable[[Column], Column]) -> Column:
        """As many results as items: what stands before each."""
        every = F.aggregate(xs, F.array(start), lambda acc, x: F.concat(acc, F.array(combine(F.element_at(acc, -1), of(x)))))
        return F.slice(every, 1, F.size(xs))

    def chunked(xs: Column, step: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), step), lambda i: F.slice(xs, i * step + 1, step))

    def joined(chunks: Column) -> Column:
        totals = F.transform(chunks, lambda c: F.aggregate(c, F.lit(0), lambda acc, x: combine(acc, value(x))))
        return F.flatten(F.zip_with(chunks, folded(totals, F.lit(0), lambda x: x), lambda c, at: folded(c, at, value)))

    step = F.greatest(F.ceil(F.sqrt(F.size(items))), F.lit(1)).cast("int")
    return let(items, lambda xs: let(step, lambda n: let(chunked(xs, n), joined)))


def located(text: Column, pattern: str, kind: int) -> Column:
    """Spans of a pattern's matches: what lies between matches gives their places by its length."""

    def span(x: Column, at: Column) -> Column:
        begin = at + x["gap"]
        return F.struct(F.lit(kind).alias("kind"), begin.alias("start"), (begin + F.length(x["hit"])).alias("end"), x["hit"].alias("value")).cast(SPAN)

    none = F.array().cast(f"array<{SPAN}>")
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return let(hits, lambda hit: F.when(F.size(hit) > 0, _placed(text, pattern, hit, span)).otherwise(none))


def _placed(text: Column, pattern: str, hits: Column, make: Callable[[Column, Column], Column]) -> Column:
    """``make`` of each match (gap before it, hit) and where that gap begins."""
    pairs = F.zip_with(F.split(text, pattern, -1), hits, lambda gap, hit: F.struct(F.length(gap).alias("gap"), hit.alias("hit")))
    pairs = F.filter(pairs, lambda x: x["hit"].isNotNull())
    return let(pairs, lambda xs: F.zip_with(xs, running(xs, lambda x: x["gap"] + F.length(x["hit"]), lambda a, b: a + b), make))


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether the digits' check sum is right."""
    backwards = F.reverse(number)

    def weight(i: Column) -> Column:
        d = F.substring(backwards, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return d - F.when(d > 9, 9).otherwise(0)

    total = F.aggregate(F.sequence(F.lit(1), F.length(number)), F.lit(0), lambda a, i: a + weight(i))
    return total % 10 == 0


def _byte(part: Column) -> Column:
    bare = F.ltrim(part, F.lit("0"))
    return (F.length(bare) <= 3) & (F.coalesce(F.expr("0") + F.substring(bare, 1, 3).try_cast("int"), F.lit(0)) <= 255)


def _valid(kind: int, value: Column) -> Column:
    """Whether a match of the kind's pattern is what it looks like."""
    if kind == 1:
        return F.forall(F.split(value, r"\."), _byte)
    if kind == 2:
        return (F.length(digits(value)) <= 19) & luhn(digits(value))
    return F.length(digits(value)).between(8, 15) if kind == 3 else F.lit(True)


def _may_hold(kind: int, text: Column) -> Column:
    """A cheap look for the character that every match of the kind has."""
    needed = {"email": "@", "ip": ".", "phone": "+"}.get(KINDS[kind])
    return F.contains(text, F.lit(needed)) if needed else F.lit(True)


def base_spans(text: Column) -> Column:
    """Spans of all kinds, kind by kind as listed and then by start."""
    empty = F.array().cast(f"array<{SPAN}>")

    def of(kind: int) -> Column:
        return F.when(_may_hold(kind, text), F.filter(located(text, PATTERNS[KINDS[kind]], kind), lambda s: _valid(kind, s["value"]))).otherwise(empty)

    return F.concat(*[of(kind) for kind in range(len(KINDS))])


def entity_key(kind: Column, value: Column) -> Column:
    """An entity by the hash of its kind and value, whatever the case and punctuation: no scratch table
    holds the value itself."""
    plain = F.when(kind >= 2, digits(value)).otherwise(F.lower(value))
    return F.sha2(F.concat_ws(":", kind.cast("string"), plain), 256)


def _entity(span: Column) -> Column:
    return entity_key(span["kind"], span["value"])


def _hidden(text: Column, kind: int) -> Column:
    """``text`` at the same length, with no letter or digit of one kind's base spans."""
    pattern = PATTERNS[KINDS[kind]]
    hits = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda h: F.when(_valid(kind, h), F.regexp_replace(h, f"[{WORD}]", HIDDEN)).otherwise(h))
    return F.array_join(F.flatten(F.zip_with(F.split(text, pattern, -1), hits, lambda gap, hit: F.array(gap, F.coalesce(hit, F.lit(""))))), "")


def _raw_terms(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TERM), F.lit(0))


def _of_kind(kind: int) -> Callable[[Column], Column]:
    return lambda s: s["kind"] == kind


def _words(text: Column, base: Column) -> Column:
    """(start, end, term) of the words that touch no base span, in order. With a kind's spans hidden, the words keep their
    number and their places, so what is hidden for any kind is found word by word."""

    def word(x: Column, at: Column) -> Column:
        return F.struct((at + x["gap"]).alias("start"), (at + x["gap"] + F.length(x["hit"])).alias("end"), x["hit"].alias("term"))

    def visible(hits: Column) -> Column:
        words = _placed(text, TERM, hits, word)
        for kind in range(len(KINDS)):
            some = F.exists(base, _of_kind(kind))
            words = F.zip_with(words, F.when(some, _raw_terms(_hidden(text, kind))).otherwise(hits), lambda w, m: F.when(~F.contains(m, F.lit(HIDDEN)), w))
        return F.filter(words, lambda w: w.isNotNull())

    return let(_raw_terms(text), visible)


def category(term: Column) -> Column:
    """What a term is generalised to, by its characters alone."""
    return (
        F.when(term.rlike(r"^\p{N}+$"), "[NUMBER]").when(term.rlike(r"\p{N}"), "[CODE]").when(term.rlike(r"^\p{Lu}"), "[NAME]").otherwise("[WORD]")
    )


def search(docs: DataFrame, share: float = SHARE, generalise: float = GENERALISE, remove: float = REMOVE, everywhere: bool = False) -> tuple[DataFrame, DataFrame]:
    """Two written tables: (doc_id, k1, k2, base, entities) with a row for each document, and (k1, k2, added) with one
    for each text that has disclosing terms."""
    scan = _scan(docs)
    texts = held_texts(docs, scan)
    flagged = disclosing_terms(scan, texts, docs, share, generalise, remove)
    terms = stored(flagged.groupBy(F.col("term").alias("low")).agg(F.min("left").alias("left"), F.first("n_term").alias("n_term")), "pii-flagged")
    few = terms.count() <= BROADCAST_ROWS
    hit = _flagged_words(texts.drop("entities"), F.broadcast(terms) if few else terms).drop("n_term")
    scratch = [texts, terms, flagged]
    if everywhere:
        held = hit.select("k1", "k2", "n", "low").distinct().groupBy("low").agg(F.sum("n").alias("n_held"))
        beyond = stored(terms.join(held, "low").where(F.col("n_term") > F.col("n_held")).select("low", "left"), "pii-beyond")
        others = other_texts(docs, scan, beyond)
        hit = hit.drop("n").unionByName(_flagged_words(others, F.broadcast(beyond) if few else beyond))
        scratch += [beyond, others]
    action = F.when(F.col("left") <= remove, "remove").otherwise("generalise")
    spans = F.sort_array(F.collect_list(F.struct("start", "end", action.alias("action"), "term"))).cast(ADDED)
    added = stored(hit.groupBy("k1", "k2").agg(spans.alias("added")), "pii-added")
    dropped(*scratch)
    return scan, added


def _flagged_words(texts: DataFrame, terms: DataFrame) -> DataFrame:
    """A row for each place of a disclosing term, with the columns of its text and term."""
    words = texts.withColumn("w", F.explode("words")).drop("words").select("*", "w.*", F.lower("w.term").alias("low")).drop("w")
    return words.join(terms, "low")


def other_texts(docs: DataFrame, scan: DataFrame, terms: DataFrame) -> DataFrame:
    """(k1, k2, words) of each different text that has no base spans and holds one of the terms."""
    n, none = terms.count(), F.array().cast(f"array<{SPAN}>")
    held = scan.where(F.size("base") > 0).select("k1", "k2").distinct()
    if not n:
        return stored(held.limit(0).select("k1", "k2", _words(F.lit(""), none).alias("words")), "pii-others")
    low = terms.select("low")
    keys = _keyed(docs).select("k1", "k2", F.explode(_terms(F.col("text"))).alias("low")).join(F.broadcast(low) if n <= BROADCAST_ROWS else low, "low", "left_semi")
    keys = stored(keys.select("k1", "k2").distinct().join(held, ["k1", "k2"], "left_anti"), "pii-other-keys")
    few = keys.count() <= BROADCAST_ROWS
    some = _keyed(docs).join(F.broadcast(keys) if few else keys, ["k1", "k2"], "left_semi").groupBy("k1", "k2").agg(F.first("text").alias("text"))
    others = stored(some.select("k1", "k2", _words(F.col("text"), none).alias("words")), "pii-others")
    dropped(keys)
    return others


def _keyed(docs: DataFrame) -> DataFrame:
    return documents_of(docs).select("doc_id", "text", *[k.alias(n) for n, k in zip(("k1", "k2"), key128(F.col("text")), strict=True)])


def _scan(docs: DataFrame) -> DataFrame:
    """A light row for each document: id, text key, base spans, and their entities."""
    d = _keyed(docs).withColumn("base", base_spans(F.col("text")))
    places = F.transform("base", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return stored(d.select("doc_id", "k1", "k2", places.alias("base"), F.array_distinct(F.transform("base", _entity)).alias("entities")), "pii-scan")


def held_texts(docs: DataFrame, scan: DataFrame) -> DataFrame:
    """A row for each different text with base spans: its key, the number n of its documents, entities and words."""
    held = scan.where(F.size("base") > 0).groupBy("k1", "k2").agg(F.count("*").alias("n"), F.first("entities").alias("entities"), F.first("base").alias("base"))
    held = stored(held, "pii-held")
    few = held.count() <= BROADCAST_ROWS
    keys = held.select("k1", "k2")
    some = _keyed(docs).join(F.broadcast(keys) if few else keys, ["k1", "k2"], "left_semi").groupBy("k1", "k2").agg(F.first("text").alias("text"))
    texts = stored(some.join(held, ["k1", "k2"]).select("k1", "k2", "n", "entities", _words(F.col("text"), F.col("base")).alias("words")), "pii-texts")
    dropped(held)
    return texts


def _terms(text: Column) -> Column:
    return F.array_distinct(F.transform(_raw_terms(text), F.lower))


def entity_classes(texts: DataFrame) -> DataFrame:
    """(entity, class, n_entity, texts): entities of the very same texts are one class, told by sums of hashes of the texts."""
    one = texts.select("n", F.xxhash64("k1", "k2").alias("a"), F.xxhash64("k2", "k1").alias("b"), F.explode("entities").alias("entity"))
    sums = one.groupBy("entity").agg(F.sum("n").alias("n_entity"), F.count("*").alias("texts"), F.sum(F.col("a").cast("decimal(38,0)")).alias("a"), F.sum(F.col("b").cast("decimal(38,0)")).alias("b"))
    return sums.select("entity", F.xxhash64("n_entity", "texts", "a", "b").alias("class"), "n_entity")


def disclosing_terms(scan: DataFrame, texts: DataFrame, docs: DataFrame, share: float = SHARE, generalise: float = GENERALISE, remove: float = REMOVE) -> DataFrame:
    """(class, term, n_entity, n_both, n_term, disclosed, left) of the pairs of entity class and term that exceed the thresholds."""
    n = F.lit(float(max(scan.count(), 1)))
    classes = stored(entity_classes(texts), "pii-classes")
    of_text = texts.select("k1", "k2", F.explode("entities").alias("entity")).join(classes, "entity").groupBy("k1", "k2").agg(F.collect_set("class").alias("classes"))
    words = texts.join(of_text, ["k1", "k2"]).select("n", "classes", F.array_distinct(F.transform("words", lambda w: F.lower(w["term"]))).alias("terms"))
    words = stored(words, "pii-words")
    within = words.select("n", F.explode("terms").alias("term")).groupBy("term").agg(F.sum("n").alias("n_held"))
    together = words.select("n", "terms", F.explode("classes").alias("class")).select("n", "class", F.explode("terms").alias("term"))
    together = together.groupBy("class", "term").agg(F.sum("n").alias("n_both"))
    sizes = classes.groupBy("class").agg(F.first("n_entity").alias("n_entity"))

    def measured(df: DataFrame, n_term: str) -> DataFrame:
        entity = F.col("n_entity") / n
        near = (F.col("n_both") + entity) / (F.col(n_term) + 1)
        information = -F.log2(entity)
        df = df.withColumns({"left": -F.log2(near), "disclosed": F.when(information > 0, F.log2(near / entity) / information).otherwise(F.lit(0.0))})
        return df.where((F.col("left") <= generalise) & (F.col("disclosed") >= share))

    # A term stands in as many documents at least as in those that hold entities: pairs that miss the
    # thresholds even so are out before the corpus is read for the rest.
    pairs = measured(together.join(within, "term").join(sizes, "class"), "n_held").drop("left", "disclosed", "n_held")
    pairs = stored(pairs, "pii-pairs")
    # The corpus is counted word by word before the join, which has one row for each candidate term.
    n_term = documents_of(docs).select(F.explode(_terms(F.col("text"))).alias("term")).groupBy("term").agg(F.count("*").alias("n_term"))
    wanted = stored(n_term.join(pairs.select("term").distinct(), "term"), "pii-terms")
    out = stored(measured(pairs.join(wanted, "term"), "n_term"), "pii-disclosing")
    dropped(classes, words, pairs, wanted)
    return out


def find(docs: DataFrame, **thresholds) -> DataFrame:
    """doc_id, k1, k2 (key of the text), ``base`` spans by kind and start, and ``added`` spans
    (start, end, action, term) of disclosing terms by start, for every row."""
    scan, added = search(docs, **thresholds)
    out = scan.select("doc_id", "k1", "k2", "base").join(added, ["k1", "k2"], "left")
    return out.select("doc_id", "k1", "k2", "base", F.coalesce("added", F.array().cast(ADDED)).alias("added"))


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **thresholds) -> DataFrame:
    """``docs``, all columns, with base spans replaced by their kind in brackets, disclosing terms
    removed or replaced by their category; null text becomes empty."""
    scan, added = search(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), **thresholds)
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    base = scan.where(F.size("base") > 0).groupBy("k1", "k2").agg(F.first("base").alias("base")).join(added, ["k1", "k2"], "full" if thresholds.get("everywhere") else "left")
    marks = F.concat(
        F.transform(F.coalesce("base", F.array().cast(scan.schema["base"].dataType)), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.element_at(names, s["kind"] + 1).alias("by"))),
        F.transform(F.coalesce("added", F.array().cast(ADDED)), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.when(s["action"] == "remove", GONE).otherwise(category(s["term"])).alias("by"))),
    )
    marked = base.select(F.col("k1").alias("_pii_1"), F.col("k2").alias("_pii_2"), F.sort_array(marks).alias("_pii_marks"))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    a, b = key128(text)
    rows = docs.withColumns({"_pii_a": a, "_pii_b": b})
    same = (F.col("_pii_a") == F.col("_pii_1")) & (F.col("_pii_b") == F.col("_pii_2"))
    out = rows.join(marked, same, "left").withColumn(text_col, F.when(F.col("_pii_marks").isNull(), text).otherwise(_replaced(text, F.col("_pii_marks"))))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def _replaced(text: Column, marks: Column) -> Column:
    """``text`` with each mark's place replaced. Kinds may overlap (an address within a mail address): what an earlier
    span covers is not marked again."""

    def rebuilt(chars: Column) -> Column:
        def piece(s: Column, upto: Column) -> Column:
            gap = F.slice(chars, upto + 1, F.greatest(s["start"] - upto, F.lit(0)))
            return F.concat(F.array_join(gap, ""), F.when(s["start"] >= upto, s["by"]).otherwise(F.lit("")))

        covered = running(marks, lambda s: s["end"], lambda a, b: F.greatest(a, b))
        end = F.array_max(F.transform(marks, lambda s: s["end"]))
        tail = F.slice(chars, end + 1, F.greatest(F.size(chars) - end, F.lit(0)))
        return F.concat(F.array_join(F.zip_with(marks, covered, piece), ""), F.array_join(tail, ""))

    return let(F.split(text, ""), rebuilt)
