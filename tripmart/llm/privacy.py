"""Personal data: fixed patterns and information-theoretic sanitisation.

Base spans (mails, IP addresses, cards, phones) are found by patterns.  Each
value found is a protected entity.  The corpus tells how strongly a term
discloses it: with c counts of occurrences, the share of an entity's information
that a term near it gives away is

    PMI(e; t) / IC(e) = 1 + ln(c(e, t) / c(t)) / -ln p(e),

1 if the term occurs nowhere else.  Terms at or above a threshold are spans too,
if they meet the entity in several texts or more often than chance would have it:
generalised, or removed if they disclose almost everything.  All of it is
DataFrame expressions; Python only builds the plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import materialize, shield, table

KINDS = ("email", "ip", "card", "phone")
#: The contract's patterns.  A start inside a run that began earlier can not
#: match (unless a match ended there: \G), and loops at the end are possessive:
#: the matches stay the same, and long runs cost linear time and no stack.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold to be searched at all.
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][ -]?[0-9]", "phone": r"\+[0-9]"}
TERM = r"\p{L}+"
NEAR = 160  # code points on either side of an entity
#: Different surroundings in which a term must meet an entity.
MIN_TOGETHER = 3  # (and texts)
#: Or, in fewer: the chance that any word near an entity meets it so by accident.
CHANCE = 0.05
GENERALISE, REMOVE = 0.7, 0.9
SPAN = "struct<kind:string,start:int,end:int,value:string>"


CHUNK = 256  # elements folded together


def _bound(value: Column, body) -> Column:
    """``body`` of a value that is computed once: named in a lambda, not repeated."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _fold(items: Column, state: Column, kind: str, step) -> Column:
    """struct(state, out) after all ``items``: ``step(state, item)`` gives the next state
    and an array to append.

    An array that grows by one element per step is copied each time; folded chunk
    by chunk, many thousand elements cost little."""
    nothing = F.array().cast(f"array<{kind}>")

    def chunks(found: Column) -> Column:
        def one(acc: Column, k: Column) -> Column:
            def grow(a: Column, item: Column) -> Column:
                after, more = step(a["state"], item)
                return F.struct(after.alias("state"), F.concat(a["out"], more).alias("out"))

            some = F.aggregate(F.slice(found, k * CHUNK + 1, CHUNK), F.struct(acc["state"].alias("state"), nothing.alias("out")), grow)
            return _bound(some, lambda x: F.struct(x["state"].alias("state"), F.concat(acc["out"], x["out"]).alias("out")))

        # the last number may be of an empty chunk
        return F.aggregate(F.sequence(F.lit(0), F.floor(F.size(found) / CHUNK).cast("int")),
                           F.struct(state.alias("state"), nothing.alias("out")), one)

    return _bound(items, chunks)


def _matches(text: Column, pattern: str, kind: str) -> Column:
    """array<SPAN> of all matches, leftmost and non-overlapping, with code point
    offsets: the lengths of what lies between the matches and of the matches."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)  # one more than matches
    # Paired first: an expression inside a lambda would be computed per element.
    pairs = F.filter(F.zip_with(found, gaps, lambda m, g: F.struct(m.alias("m"), F.char_length(g).alias("gap"))), lambda p: p["m"].isNotNull())

    def step(at: Column, p: Column) -> tuple[Column, Column]:
        start = at + p["gap"]
        end = start + F.char_length(p["m"])
        return end, F.array(F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), p["m"].alias("value")))

    return _fold(pairs, F.lit(0), SPAN, step)["out"]


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def add(acc: Column, i: Column) -> Column:
        d = F.substring(digits, F.char_length(digits) - i, F.lit(1)).cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return acc + F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), F.char_length(digits) - 1), F.lit(0), add) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        def small(p: Column) -> Column:
            bare = F.ltrim(p, F.lit("0"))
            return (F.char_length(bare) <= 3) & (F.coalesce(bare.try_cast("int"), F.lit(0)) <= 255)
        return F.forall(F.split(value, r"\."), small)
    n = F.char_length(_digits(value))
    if kind == "card":
        return F.when(n.between(16, 19), _luhn(_digits(value))).otherwise(F.lit(False))
    return n.between(8, 15)


def _validity(kind: str):
    return lambda span: _valid(kind, span["value"])


def _of_kind(kind: str):
    return lambda span: span["kind"] == kind


def base_spans(text: Column) -> Column:
    """array<SPAN> of a whole text: by kind as listed, then start; null text: none."""
    text = F.coalesce(text, F.lit(""))
    kinds = []
    for kind in KINDS:
        may = F.rlike(text, F.lit(HINTS[kind]))
        found = F.filter(_matches(text, PATTERNS[kind], kind), _validity(kind))
        kinds.append(F.when(may, found).otherwise(F.array().cast(f"array<{SPAN}>")))
    return F.concat(*kinds)


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))


def _digest(text: Column) -> Column:
    return F.substring(F.unhex(F.sha2(text, 256)), 1, 16)


BLOCK, LONG = 4096, 512  # code points of a block of text; longer spans are looked at in the whole text
MARGIN = LONG + NEAR + 2


def _blocks(text: Column) -> Column:
    """The text in pieces of ``BLOCK`` code points, in one pass."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}+"), F.lit(0))


def _part(blocks: Column, start: Column, end: Column) -> Column:
    """The text between two places, from the blocks it lies in: no count from the
    text's beginning."""
    i, j = F.floor(start / BLOCK).cast("int"), F.floor(end / BLOCK).cast("int")
    within = lambda n: F.coalesce(F.get(blocks, n), F.lit(""))
    one = F.substring(within(i), start % BLOCK + 1, end - start)
    many = F.concat(F.substring(within(i), start % BLOCK + 1, F.lit(BLOCK)), F.array_join(F.slice(blocks, i + 2, F.greatest(j - i - 1, F.lit(0))), ""),
                    F.substring(within(j), F.lit(1), end % BLOCK))
    return F.when(i == j, one).otherwise(many)


def _near(found: DataFrame) -> DataFrame:
    """(key, entity, around, term, start, end, copies): terms within NEAR of each entity.

    ``found``: key, text and base spans of each text once, and its copies.  Words cut by the edge of the
    surroundings, and words of base spans, are not terms.  A text is cut into blocks
    with margins first, so that a span meets the text and the spans around it, not
    all of them; only spans of more than ``LONG`` code points take the whole text
    along."""
    short = F.filter("spans", lambda s: s["end"] - s["start"] <= LONG)
    blocks = found.filter(F.size(short) > 0).select("key", "copies", _blocks(F.col("text")).alias("blocks"))
    with_margins = _bound(F.col("blocks"), lambda b: F.transform(b, lambda x, k: F.struct(
        k.alias("k"), F.when(k > 0, F.substring(F.get(b, k - 1), F.lit(BLOCK - MARGIN + 1), F.lit(MARGIN))).otherwise("").alias("before"), x.alias("x"),
        F.coalesce(F.substring(F.get(b, k + 1), 1, MARGIN), F.lit("")).alias("after"))))
    blocks = blocks.select("key", "copies", F.explode(with_margins).alias("b")).select(
        "key", "copies", "b.k", (F.col("b.k") * BLOCK - F.char_length("b.before")).alias("off"), F.concat("b.before", "b.x", "b.after").alias("text"))
    # Each block's own spans and those that reach into what is around them.
    each = found.select("key", F.explode("spans").alias("s"))
    first = F.greatest(F.floor((F.col("s.start") - 2 * MARGIN) / BLOCK), F.lit(0))
    each = each.select("key", "s", F.explode(F.sequence(first.cast("int"), F.floor((F.col("s.end") + 2 * MARGIN) / BLOCK).cast("int"))).alias("k"))
    held = each.groupBy("key", "k").agg(F.collect_list("s").alias("spans"))  # of at most BLOCK + 4 * MARGIN places
    own = F.filter("spans", lambda s: (F.floor(s["start"] / BLOCK) == F.col("k")) & (s["end"] - s["start"] <= LONG))
    local = blocks.join(held, ["key", "k"]).withColumn("own", own)
    whole = found.withColumn("own", F.filter("spans", lambda s: s["end"] - s["start"] > LONG)).withColumn("off", F.lit(0))
    columns = ["key", "copies", "text", "off", "spans", "own"]
    return _terms(local.select(*columns)).unionByName(_terms(whole.select(*columns)))


def _terms(found: DataFrame) -> DataFrame:
    """Terms near the ``own`` spans of texts that begin ``off`` places into the whole."""
    one = found.select("key", "copies", "text", "off", "spans", F.explode("own").alias("s"))
    left_from = F.greatest(F.col("s.start") - NEAR, F.lit(0))
    one = one.select("key", "copies", F.concat_ws(":", "s.kind", F.lower("s.value")).alias("entity"),
                     F.filter("spans", lambda x: (x["end"] > F.col("s.start") - NEAR) & (x["start"] < F.col("s.end") + NEAR)).alias("spans"),
                     F.col("s.start").alias("from"), F.col("s.end").alias("to"), left_from.alias("lo"),
                     F.substring(F.col("text"), left_from - F.col("off") + 1, F.col("s.end") - left_from + NEAR + 1).alias("around"))
    terms = _matches(F.col("around"), TERM, "term")
    one = one.withColumn("t", F.explode(terms)).select(
        "key", "copies", "entity", "spans", F.xxhash64("around").alias("around"), F.lower("t.value").alias("term"),
        (F.col("lo") + F.col("t.start")).alias("start"), (F.col("lo") + F.col("t.end")).alias("end"),
        ((F.col("t.start") > 0) | (F.col("lo") == 0)).alias("whole"), (F.col("to") + NEAR).alias("edge"))
    apart = ~F.exists("spans", lambda x: (x["start"] < F.col("end")) & (F.col("start") < x["end"]))
    return one.filter(F.col("whole") & (F.col("end") <= F.col("edge")) & apart).select("key", "entity", "around", "term", "start", "end", "copies")


def disclosures(docs: DataFrame, near: DataFrame, together: int = MIN_TOGETHER, least: float = GENERALISE) -> DataFrame:
    """(entity, term, share): the terms that disclose at least ``least`` of an entity.

    Counts are of all occurrences in the corpus.  A pair counts by the texts it
    meets in, those with the same surroundings all as one, so that copies and
    repeated lines show nothing: in ``together`` of them, or in fewer if that many
    meetings have a chance of at most ``CHANCE`` over all terms near the entity
    (the likelihood of the term's share of occurrences near it, against the
    entity's share of the corpus).  Pairs are as many as words near entities, and
    are summed before they are shuffled."""
    met = (near.groupBy("entity", "term", "key", "around").agg(F.sum("copies").alias("n"))
           .groupBy("entity", "term", "key").agg(F.sum("n").alias("n"), F.bit_xor("around").alias("around")))  # of a set, in any order
    often = met.groupBy("entity", "term").agg(F.sum("n").alias("both"), F.count_distinct("around").alias("around"))
    often = materialize(often, "pii-pairs")
    if often.isEmpty():
        return often.select("entity", "term", F.lit(0.0).alias("share"))
    words = docs.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(TERM), F.lit(0))).alias("term"))
    counts = words.groupBy("term").agg(F.count("*").alias("times")).join(often.select("term").distinct(), "term")
    entities = (near.groupBy("entity").agg(F.count_distinct("key", "around").alias("seen"))
                .join(often.groupBy("entity").agg(F.count("*").alias("terms")), "entity"))
    places = docs.agg((F.coalesce(F.sum(F.char_length("text")), F.lit(0)) / (2 * NEAR) + 1).alias("places"))
    places = places.first()["places"]
    info = F.greatest(-F.log(F.least(F.col("seen") / F.lit(places), F.lit(1.0))), F.lit(1e-9))
    q = F.least(F.col("both") / F.col("times"), F.lit(1.0))
    p = F.least(F.col("seen") / F.lit(places), F.lit(1 - 1e-9))
    share = 1 + F.log(q) / info
    # Logarithms of how much likelier a meeting, and the term's other places for each, are than by chance.
    gain = F.log(q / p) + F.when(q < 1, (1 - q) / q * F.log((1 - q) / (1 - p))).otherwise(0.0)
    sure = (F.col("around") >= together) | ((q > p) & (F.col("around") * gain >= F.log(F.col("terms") / CHANCE)))
    return (often.join(counts, "term").join(entities, "entity").filter(sure).select("entity", "term", share.alias("share"))
            .filter(F.col("share") >= least))


def find(docs: DataFrame, together: int = MIN_TOGETHER, least: float = GENERALISE) -> DataFrame:
    """(doc_id, key, base, terms) of every row: base spans, and the term spans of
    its text (null if none) with the greatest share disclosed.

    A null text is empty; repeated rows and copies get equal spans; empty texts
    and an empty table give no span.  Whole texts count, however long, and spans cost
    time in proportion to their number.  Columns of ``docs`` other than doc_id and
    text do not matter, whatever their names."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumns({"key": _digest(F.col("text")), "base": base_spans(F.col("text"))})
    # One pass of patterns; only texts with base spans are kept, for their surroundings.
    narrow = materialize(rows.select("doc_id", "key", "base", F.when(F.size("base") > 0, F.col("text")).alias("text")), "pii-base")
    texts = (narrow.filter(F.col("text").isNotNull()).groupBy("key")
             .agg(F.first("text").alias("text"), F.first("base").alias("spans"), F.count("*").alias("copies")))
    near = materialize(_near(texts), "pii-near")
    shown = materialize(disclosures(rows, near, together, least), "pii-shown")
    terms = (near.select("key", "entity", "term", "start", "end").join(shown, ["entity", "term"]).groupBy("key", "start", "end").agg(F.max("share").alias("share"))
             .groupBy("key").agg(F.sort_array(F.collect_list(F.struct("start", "end", "share"))).alias("terms")))
    terms = materialize(terms, "pii-terms")
    return narrow.join(terms, "key", "left").select("doc_id", "key", "base", "terms")


def _replaced(text: Column, spans: Column) -> Column:
    """The text with its spans (struct<start,end,put>) put in, the outer one of
    overlapping spans first."""
    kind = "struct<start:int,end:int,put:string>"
    none = F.lit(None).cast(kind)

    def merge(last: Column, s: Column) -> tuple[Column, Column]:
        apart = last.isNull() | (s["start"] >= last["end"])
        wider = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"), last["put"].alias("put"))
        return F.when(apart, s).otherwise(wider), F.when(apart & last.isNotNull(), F.array(last)).otherwise(F.array().cast(f"array<{kind}>"))

    merged = _fold(F.array_sort(spans.cast(f"array<{kind}>")), none, kind, merge)
    merged = _bound(merged, lambda m: F.concat(m["out"], F.array(m["state"])))

    # What stays lies between the spans.
    def pieces(blocks: Column, m: Column) -> Column:
        ends = F.concat(F.array(F.lit(0)), F.transform(m, lambda s: s["end"]))
        starts = F.concat(F.transform(m, lambda s: s["start"]), F.array(F.char_length(text)))
        return F.zip_with(F.zip_with(ends, starts, lambda a, z: _part(blocks, a, z)), F.transform(m, lambda s: s["put"]),
                          lambda kept, put: F.concat(kept, F.coalesce(put, F.lit(""))))

    out = _bound(_blocks(text), lambda b: F.array_join(_bound(merged, lambda m: pieces(b, m)), ""))
    return F.when(F.size(spans) == 0, text).otherwise(out)


def sanitise(docs: DataFrame, together: int = MIN_TOGETHER, least: float = GENERALISE, remove: float = REMOVE) -> DataFrame:
    """Every row of ``docs`` with its personal data replaced in ``text``.

    Base spans become [EMAIL], [IP], [CARD], [PHONE]; disclosing terms become
    [TERM], or nothing from ``remove`` on.  A null text stays null; n_chars, if
    the table has it, follows the new text where it was the old text's length;
    other columns stay, whatever their names."""
    safe, own = shield(docs, "doc_id", "text", "n_chars")
    terms = find(safe, together, least).filter("terms IS NOT NULL").select("key", "terms").dropDuplicates(["key"])
    terms = materialize(terms, "pii-found")
    # Only texts with base spans can hold any: the others stay where they are.
    rows = safe.withColumn("base", base_spans(F.col("text")))
    plain, marked = rows.filter(F.size("base") == 0), rows.filter(F.size("base") > 0)
    marked = marked.withColumn("__key", _digest(F.col("text"))).join(terms.withColumnRenamed("key", "__key"), "__key", "left")
    base = F.transform("base", lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("put")))
    more = F.transform(F.coalesce("terms", F.array().cast("array<struct<start:int,end:int,share:double>>")), lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), F.when(s["share"] >= remove, "").otherwise("[TERM]").alias("put")))
    marked = marked.withColumn("__new", _replaced(F.col("text"), F.concat(base, more)))
    if "n_chars" in docs.columns:
        marked = marked.withColumn("n_chars", F.when(F.col("n_chars") == F.char_length("text"), F.char_length("__new").cast("long")).otherwise(F.col("n_chars")))
    return plain.select(*own).unionByName(marked.withColumn("text", F.col("__new")).select(*own))


def query(spark, sf_dir):
    """op9: the spans of every document."""
    found = find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.col("base")
    terms = F.transform(F.coalesce("terms", F.array().cast("array<struct<start:int,end:int,share:double>>")),
                        lambda s: F.concat_ws(":", F.lit("term"), s["start"], s["end"]))
    return found.select("doc_id", *[F.size(F.filter(base, _of_kind(k))).cast("long").alias(f"n_{k}") for k in KINDS],
                        F.sha2(listed(base), 256).alias("base_sha256"),
                        F.concat_ws(",", F.transform(base, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), terms).alias("spans"),
                        F.size(terms).cast("long").alias("n_terms"))
