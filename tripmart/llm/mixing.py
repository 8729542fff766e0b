"""Mixing sources to target weights by Pareto order sampling.

Every source has a word target.  A document of a source is due ``target /
source size`` copies on average over the source's words: the whole part is certain for
every document, the fraction f is shared out as inclusion probabilities p.  They lean
by length: a document's level grows with size / (size + mean size of its source), and
p = f + LEAN min(f, 1 - f) (level - mean level by words), so that the words expected
are exactly those missing and 0 < p < 1.  Documents are ranked by their random odds
over their inclusion odds, q = (u / (1 - u)) / (p / (1 - p)) with u from a hash of the
document, and the first of each source are taken once more as long as the words still
missing allow.  A second pass down the order fills up with documents that still fit, and
one document whose size fits best ends it.  Nothing is sorted whole: a histogram of
q finds the one bin per source in which the order matters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripmart.llm.common import materialize, n_words, shield, table, without

#: Weights of the sources in order, repeating, and the mix's size and copy limit (fixed by the contract).
WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2
#: Steps of a document's level, and how far the odds lean to long documents (-1 to 1; 0: all alike).
LEVELS, LEAN = 64, 0.5
SURE = 1 - 1e-12  # no p reaches 1 by rounding
BINS = 65_536
ROUNDS = 2
SEED = "mix-1"


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, source_size, target): shares of all words by weight, each at
    most ``most`` times its source; what is above goes to the others by weight.

    One row per source: sources fill up in the order of cap over weight, so the
    resharing ends in one sorted pass."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    per = per.withColumns({"w": weight.cast("long"), "cap": F.col("source_size") * most})
    everything = Window.partitionBy(F.lit(0))
    fill = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    per = per.withColumns({
        "total": F.sum("source_size").over(everything).cast("double") * share,
        "before": F.coalesce(F.sum("cap").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "open": F.sum("w").over(fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)),
    })
    per = per.withColumn("full", F.col("cap") * F.col("open") <= (F.col("total") - F.col("before")) * F.col("w"))
    per = per.withColumns({
        "spent": F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(everything),
        "rest": F.sum(F.when(F.col("full"), 0).otherwise(F.col("w"))).over(everything),
    })
    target = F.when(F.col("full"), F.col("cap").cast("double")).otherwise(
        (F.col("total") - F.col("spent")) / F.col("rest") * F.col("w"))
    return per.select("source", "source_size", target.alias("target"))


def uniform(seed: str = SEED) -> Column:
    """A number in (0, 1) that follows from doc_id (without one: from the text)."""
    who = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text:"), F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))))
    digits = F.substring(F.md5(F.concat(F.lit(seed + ":"), who).cast("binary")), 1, 12)
    return (F.conv(digits, 16, 10).cast("long") + 0.5) / float(1 << 48)


def _level() -> Column:
    """0 to LEVELS - 1: how long a document is beside the ``mean`` of its source."""
    return F.when(F.col("size") > 0, F.floor(LEVELS * F.col("size") / (F.col("size") + F.col("mean")))).otherwise(0).cast("long")


def leaning(docs: DataFrame, goals: DataFrame) -> DataFrame:
    """``goals`` with the ``mean`` size of each source and its mean level by words, ``centre``."""
    means = docs.groupBy("source").agg((F.sum("size") / F.count("*")).alias("mean"))
    goals = _keyed(without(goals, "mean", "centre"), means, "mean")
    level = (docs.alias("d").join(goals.alias("g"), _same(F.col("d.source"), F.col("g.source")))
             .select("d.source", "d.size", "g.mean").withColumn("level", _level()))
    words = level.groupBy("source").agg(F.sum("size").alias("words"), F.sum(F.col("level") * F.col("size")).alias("levels"))
    centre = F.when(F.col("words") > 0, F.col("levels") / F.col("words")).otherwise(0.0)
    return _keyed(goals, words.select("source", centre.alias("centre")), "centre")


def _ranked(rows: DataFrame) -> DataFrame:
    """Certain copies, words still missing and the Pareto rank of each document."""
    rows = rows.withColumn("due", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
    rows = rows.withColumn("certain", F.floor("due"))
    f = F.col("due") - F.col("certain")
    p = F.least(f + LEAN * F.least(f, 1 - f) * ((_level() - F.col("centre")) / LEVELS), F.lit(SURE))
    rows = rows.withColumn("p", F.when(f > 0, p).otherwise(0.0))
    return rows.withColumns({
        "need": F.col("target") - F.col("certain") * F.col("source_size"),
        "q": F.when(F.col("p") > 0, (F.col("u") / (1 - F.col("u"))) / (F.col("p") / (1 - F.col("p"))))})


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def plan(docs: DataFrame, goals: DataFrame) -> DataFrame:
    """Per source: target and, per round, the words missing before it and the
    last Pareto rank (q, doc_id, size) it takes; then one best fitting rank.

    ``docs``: doc_id, source, size, u; ``goals``: from :func:`leaning`."""
    cut = goals
    for k in range(ROUNDS):
        cut = materialize(_round(_joined(docs, cut), cut, k), "mix-cut")
    rest = (_joined(docs, cut).withColumn("missing", F.col("need") - F.col(f"words{ROUNDS - 1}"))
            .filter((F.col("p") > 0) & ~_taken() & (F.abs(F.col("size") - F.col("missing")) < F.col("missing")))
            .groupBy("source").agg(F.min_by(_rank(), F.struct(F.abs(F.col("size") - F.col("missing")), _rank())).alias("extra")))
    return _keyed(cut, rest, "extra")


def _joined(docs: DataFrame, cut: DataFrame) -> DataFrame:
    """Documents with what is known of their source (a row per source: small)."""
    names = [f"d.`{c}`" for c in docs.columns]
    return _ranked(docs.alias("d").join(cut.alias("c"), _same(F.col("d.source"), F.col("c.source")))
                   .select(*names, *[f"c.`{c}`" for c in cut.columns if c != "source"]))


def _keyed(left: DataFrame, right: DataFrame, *names: str) -> DataFrame:
    return (left.alias("l").join(right.alias("r"), _same(F.col("l.source"), F.col("r.source")), "left")
            .select("l.*", *[f"r.{n}" for n in names]))


def _round(rows: DataFrame, cut: DataFrame, k: int) -> DataFrame:
    """One pass down the Pareto order: take documents until one does not fit.

    Round 0 sees all; a later one, those left that are no longer than what is missing."""
    before = F.col(f"words{k - 1}") if k else F.lit(0)
    rows = rows.withColumn("missing", F.col("need") - before).filter("p > 0 AND missing > 0")
    if k:
        rows = rows.filter(~_taken(k) & (F.col("size") <= F.col("missing")))
    rows = rows.withColumn("bin", _bin())
    bins = rows.groupBy("source", "bin").agg(F.sum("size").alias("words"), F.first("missing").alias("missing"))
    upto = Window.partitionBy("source").orderBy("bin")  # at most BINS rows of a source
    bins = bins.withColumn("start", F.sum("words").over(upto) - F.col("words"))
    edge = materialize(bins.filter("start < missing").groupBy("source")
                       .agg(F.max("bin").alias("bin"), F.max_by("start", "bin").alias("start")), "mix-edge")
    near = (rows.alias("r").join(edge.alias("e"), _same(F.col("r.source"), F.col("e.source")) & (F.col("r.bin") == F.col("e.bin")))
            .select("r.*", "e.start"))
    order = Window.partitionBy("source").orderBy("q", F.col("doc_id").asc_nulls_last(), "size")
    near = near.withColumn("upto", F.col("start") + F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    last = (near.filter("upto <= missing").groupBy("source").agg(F.max(_rank()).alias(f"last{k}"), F.max("upto").alias("upto")))
    out = _keyed(_keyed(cut, edge.withColumnRenamed("bin", f"edge{k}"), f"edge{k}", "start"), last, f"last{k}", "upto")
    return out.withColumn(f"words{k}", F.coalesce("upto", "start", F.lit(0)) + before).drop("start", "upto")


def _rank() -> Column:
    return F.struct(F.col("q"), F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("doc_id"), F.col("size"))


def _bin() -> Column:
    return F.least(F.floor(F.col("q") / (1 + F.col("q")) * BINS), F.lit(BINS - 1)).cast("int")


def _taken(rounds: int = ROUNDS) -> Column:
    """Taken in one of the first rounds: in a bin before its edge, or up to its last rank."""
    out = F.lit(False)
    for k in range(rounds):
        here = (_bin() < F.col(f"edge{k}")) | (_rank() <= F.col(f"last{k}"))
        if k:
            here = here & (F.col("size") <= F.col("need") - F.col(f"words{k - 1}"))
        out = out | F.coalesce(here, F.lit(False))
    return out


def take(docs: DataFrame, goals: DataFrame | None = None, seed: str = SEED) -> DataFrame:
    """Every row with size, source_size, target, copies and taken (words).

    Needs doc_id, source and text.  A null text has size 0 and takes no words;
    null sources are one source, the last; a null doc_id draws by its text;
    repeated rows draw alike, and such ties are all in or all out when they
    share the last rank; a very long text is counted whole, one longer than what is
    missing is passed over in the second pass; an empty table stays empty; extra columns named like an
    output are replaced.  Reruns agree."""
    docs, own = shield(without(docs, "size", "source_size", "target", "copies", "taken"), "doc_id", "source", "text")
    keys = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), uniform(seed).alias("u"))
    keys = materialize(keys, "mix-sizes")  # the texts are read once for the plan
    goals = materialize(leaning(keys, goals if goals is not None else targets(keys)), "mix-targets")
    cut = materialize(plan(keys, goals), "mix-plan")
    rows = _joined(docs.withColumns({"size": n_words(F.col("text")), "u": uniform(seed)}), cut)
    more = (F.col("p") > 0) & (_taken() | F.coalesce(_rank() == F.col("extra"), F.lit(False)))
    rows = rows.withColumn("copies", F.col("certain") + more.cast("long"))
    return rows.select(*own, "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mix(docs: DataFrame, goals: DataFrame | None = None) -> DataFrame:
    """The mixed table: each row as often as it is taken, with its own columns."""
    safe, own = shield(docs, "doc_id", "source", "text")
    out = take(safe, goals)
    return (out.withColumn("__copy", F.explode(F.expr("CASE WHEN copies > 0 THEN sequence(1L, copies) ELSE array() END")))
            .select(*own))


def query(spark, sf_dir):
    """op2: the mix of all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return take(docs).select("doc_id", "size", "source_size", "target", "taken")


ORACLE = f"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
    (('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, 'text:' || md5(coalesce(text, '')))), 1, 12))::BIGINT + 0.5::DOUBLE)
      / 281474976710656::DOUBLE AS u
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [{', '.join(map(str, WEIGHTS))}][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)}) + 1]::BIGINT AS w
  FROM d GROUP BY source),
f AS (
  SELECT *, source_size * {MOST} AS cap, (sum(source_size) OVER ())::DOUBLE * {SHARE}::DOUBLE AS total,
    coalesce(sum(source_size * {MOST}) OVER (ORDER BY (source_size * {MOST})::DOUBLE / w, source NULLS LAST
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS before,
    (sum(w) OVER (ORDER BY (source_size * {MOST})::DOUBLE / w, source NULLS LAST
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS open
  FROM s),
g AS (SELECT *, cap * open <= (total - before) * w AS is_full FROM f),
t AS (
  SELECT source, source_size, CASE WHEN is_full THEN cap::DOUBLE ELSE
    (total - (sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER ())::DOUBLE)
      / (sum(CASE WHEN is_full THEN 0 ELSE w END) OVER ())::DOUBLE * w END AS target
  FROM g),
e AS (
  SELECT *, CASE WHEN size > 0 THEN floor({LEVELS} * size::DOUBLE / (size::DOUBLE + (sum(size) OVER (PARTITION BY source))::DOUBLE
    / (count(*) OVER (PARTITION BY source))::DOUBLE))::BIGINT ELSE 0 END AS level
  FROM d),
v AS (
  SELECT source, CASE WHEN sum(size) > 0 THEN sum(level * size)::DOUBLE / sum(size)::DOUBLE ELSE 0::DOUBLE END AS centre
  FROM e GROUP BY source),
r AS (
  SELECT e.doc_id, e.size, e.u, e.level, v.centre, t.source, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN t.target / t.source_size::DOUBLE ELSE 0::DOUBLE END AS due
  FROM e JOIN t ON e.source IS NOT DISTINCT FROM t.source JOIN v ON e.source IS NOT DISTINCT FROM v.source),
i AS (
  SELECT *, floor(due) AS certain, CASE WHEN due > floor(due) THEN
    least((due - floor(due)) + {LEAN}::DOUBLE * least(due - floor(due), 1 - (due - floor(due))) * ((level - centre) / {LEVELS}::DOUBLE),
      {SURE!r}::DOUBLE) ELSE 0::DOUBLE END AS p
  FROM r),
q AS (
  SELECT *, CASE WHEN p > 0 THEN (u / (1 - u)) / (p / (1 - p)) END AS q FROM i),
k AS (
  SELECT *, target - certain * source_size AS need, sum(size) OVER (PARTITION BY source, p > 0 ORDER BY q, doc_id NULLS LAST, size
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS words FROM q),
m AS (
  SELECT *, need - coalesce(max(CASE WHEN p > 0 AND words <= need THEN words END) OVER (PARTITION BY source), 0) AS missing FROM k),
n AS (
  SELECT *, p > 0 AND words > need AND size <= missing AS again, sum(size) OVER (PARTITION BY source, p > 0 AND words > need
    AND size <= missing ORDER BY q, doc_id NULLS LAST, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS more FROM m),
o AS (
  SELECT *, (p > 0 AND words <= need) OR (again AND more <= missing) AS taken_once,
    missing - coalesce(max(CASE WHEN again AND more <= missing THEN more END) OVER (PARTITION BY source), 0) AS gap FROM n),
x AS (
  SELECT *, CASE WHEN p > 0 AND NOT taken_once AND abs(size - gap) < gap THEN
    row_number() OVER (PARTITION BY source, p > 0 AND NOT taken_once AND abs(size - gap) < gap
      ORDER BY abs(size - gap), q, doc_id NULLS LAST, size) END AS pick FROM o)
SELECT doc_id, size, source_size, target,
  (size * (certain + CASE WHEN taken_once OR pick = 1 THEN 1 ELSE 0 END))::BIGINT AS taken
FROM x
"""
