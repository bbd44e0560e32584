"""Mixing sources to target weights by entropy balancing (operator 3).

Every source gets a target number of words: sources in code point order (null
last) weigh 5, 2, 1, repeating, and share 150 % of all words; a target stops at
twice its source's words and the excess is shared again by weight.

The document rates nearest to one copy each (in relative entropy) that give a
source its target, with no rate above the cap, are exponentially tilted:
``rate = min(cap, exp(lambda * size / mean size))``.  One ``lambda`` a source is
the solution of the convex dual, found by Newton steps inside a bracket.  Every
iteration is one aggregate over the (source, size) counts of all documents,
which are exact and far fewer than the documents.

Rates are rounded to whole copies: the whole part, and one more for the
documents whose hash-to-fraction key lies below a threshold.  The threshold is
refined by histograms over all documents until the source's words come nearest
to its target (within about half a document).  All sums are whole numbers or
decimals, so reruns agree whatever the partitioning.

Defined results: null text has size 0 and costs nothing (one copy).  A source
whose target is its cap is taken at the cap.  A source without words has target
0.  Rows that repeat an id and its text get the same number of copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from needlens.llm.shared import packed, quoted, staged
from needlens.operators.ranking import global_row_number

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2
TOLERANCE = 1e-7  # of a target, at which Newton stops
BINS = 1024
LEVELS = 3
WORDS = r"[^\x20\x09-\x0D]+"


def text_size(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORDS)).cast("long")


def _sized_columns(id_col: str, text_col: str, source_col: str) -> dict[str, Column]:
    row_id, text = F.col(quoted(id_col)), F.col(quoted(text_col))
    h = F.shiftrightunsigned(F.xxhash64(row_id, text), 11)
    return {"id": row_id, "source": F.col(quoted(source_col)), "size": text_size(text),
            "u": (h.cast("double") + 0.5) / float(1 << 53)}


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """``id, source, size`` and ``u``, a number in (0, 1) from id and text."""
    return docs.select(*[c.alias(n) for n, c in _sized_columns(id_col, text_col, source_col).items()])


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """``source, source_size, n, target, full`` from rows (source, size, n)."""
    src = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("n"))
    src = src.withColumn("last", F.col("source").isNull())
    src = global_row_number(src, ["last", "source"], [True, True], "place")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    src = staged(src.withColumn("weight", F.element_at(cycle, (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1).cast("int")))
                    .select("source", "source_size", "n", "weight"), "mix-sources")
    total = src.agg(F.sum("source_size")).first()[0] or 0
    level, most = 0.0, F.col("source_size") * float(cap)
    while True:  # the level only rises; it stands still when no further source is full
        full = F.col("weight") * F.lit(level) >= most
        row = src.agg(F.sum(F.when(full, most).otherwise(0.0)).alias("taken"),
                      F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("open")).first()
        if not row["open"]:
            break
        nxt = (share * total - row["taken"]) / row["open"]
        if nxt <= level:
            break
        level = nxt
    full = F.col("weight") * F.lit(level) >= most
    return src.select("source", "source_size", "n",
                      F.when(full, most).otherwise(F.col("weight") * F.lit(level)).alias("target"), full.alias("full"))


def _rate(lam: Column, size: Column, mean: Column, full: Column, cap: float) -> Column:
    return F.when(full, F.lit(float(cap))).otherwise(F.least(F.lit(float(cap)), F.exp(lam * size / mean)))


def _fixed(x: Column) -> Column:
    """A number in fixed point, so that sums don't depend on their order."""
    return F.round(x * 1e9).cast("decimal(18,0)")


def balance(sizes: DataFrame, goals: DataFrame, cap: float = CAP) -> DataFrame:
    """Adds ``mean`` and ``lam`` to ``goals``: the dual's solution for each source."""
    mean = F.greatest(F.col("source_size").cast("double"), F.lit(1.0)) / F.col("n")
    now = staged(goals.withColumns({"mean": mean, "lam": F.lit(0.0), "lo": F.lit(None).cast("double"),
                                    "hi": F.lit(None).cast("double"), "done": F.col("full")}), "mix-lambda")
    for _ in range(500):
        if not now.where("NOT done").limit(1).count():
            return now.select("source", "source_size", "n", "target", "full", "mean", "lam")
        rows = sizes.join(now.where("NOT done").select(F.col("source").alias("s"), "mean", "lam"),
                          sizes["source"].eqNullSafe(F.col("s")))
        rate = _rate(F.col("lam"), F.col("size"), F.col("mean"), F.lit(False), cap)
        words = (F.col("size") * F.col("n")).cast("decimal(18,0)")
        grown = F.when(rate < float(cap), rate).otherwise(0.0) * F.least(F.col("size") / F.col("mean"), F.lit(1e6))
        sums = rows.groupBy("s").agg(
            (F.sum((words * _fixed(rate)).cast("decimal(38,0)")).cast("double") / 1e9).alias("got"),
            (F.sum((words * _fixed(F.least(grown, F.lit(1e8)))).cast("decimal(38,0)")).cast("double") / 1e9).alias("slope"))
        off = F.col("got") - F.col("target")
        j = now.join(sums, now["source"].eqNullSafe(F.col("s")), "left")
        lo = F.when(off < 0, F.col("lam")).otherwise(F.col("lo"))
        hi = F.when(off > 0, F.col("lam")).otherwise(F.col("hi"))
        step = F.col("lam") - off / F.when(F.col("slope") > 0, F.col("slope"))
        inside = ((F.isnull("nlo") | (F.col("step") > F.col("nlo"))) & (F.isnull("nhi") | (F.col("step") < F.col("nhi")))
                  & (F.abs(F.col("step") - F.col("lam")) < 2 + F.abs("lam")))
        fallback = (F.when(F.isnull("nhi"), F.col("lam") * 2 + 1).when(F.isnull("nlo"), F.col("lam") * 2 - 1)
                     .otherwise((F.col("nlo") + F.col("nhi")) / 2))
        nxt = F.when(F.col("step").isNotNull() & inside, F.col("step")).otherwise(fallback)
        near = (F.abs(off) <= F.col("target") * TOLERANCE) | (F.col("nhi") - F.col("nlo") < 1e-12)
        j = (j.withColumns({"nlo": lo, "nhi": hi, "step": step})
              .withColumn("met", F.col("done") | F.coalesce(near, F.lit(False))))
        now = staged(j.select("source", "source_size", "n", "target", "full", "mean",
                              F.when(F.col("met"), F.col("lam")).otherwise(nxt).alias("lam"),
                              F.col("nlo").alias("lo"), F.col("nhi").alias("hi"), F.col("met").alias("done")), "mix-lambda")
    raise RuntimeError("the dual did not converge")


def _rounded(rows: DataFrame, cap: float) -> DataFrame:
    """Adds ``base`` copies and ``key`` (null without a fraction) to rows joined with the plan."""
    rate = _rate(F.col("lam"), F.col("size"), F.col("mean"), F.col("full"), cap)
    rows = rows.withColumn("rate", F.when(F.col("size") == 0, F.lit(1.0)).otherwise(rate))
    rows = rows.withColumn("base", F.floor("rate"))
    fraction = F.col("rate") - F.col("base")
    return rows.withColumn("key", F.when(fraction > 0, F.col("u") / (F.col("u") + fraction)))


def thresholds(sized: DataFrame, plan: DataFrame, cap: float = CAP) -> DataFrame:
    """Adds ``theta``: documents with a key below it get one more copy."""
    p = plan.withColumnRenamed("source", "s")
    rows = _rounded(sized.join(p, sized["source"].eqNullSafe(F.col("s"))), cap).select("source", "size", "base", "key")
    rows = staged(rows, "mix-keys")
    whole = rows.groupBy("source").agg(F.sum(F.col("base") * F.col("size")).alias("whole"))
    cut = plan.join(whole.withColumnRenamed("source", "s"), plan["source"].eqNullSafe(F.col("s")), "left").select(
        plan["*"], (F.col("target") - F.coalesce("whole", F.lit(0))).alias("rest"),
        F.lit(0.0).alias("theta"), F.lit(0).cast("long").alias("below"))
    cut = staged(cut, "mix-cut")
    width = 1.0
    for _ in range(LEVELS):
        width /= BINS
        c = cut.select(F.col("source").alias("s"), "rest", "theta", "below")
        inside = (rows.join(c, rows["source"].eqNullSafe(F.col("s")))
                      .where((F.col("key") >= F.col("theta")) & (F.col("key") < F.col("theta") + width * BINS)))
        bins = inside.groupBy("s", "rest", "theta", "below", F.floor((F.col("key") - F.col("theta")) / width).alias("bin")) \
                     .agg(F.sum("size").alias("words"))
        upto = Window.partitionBy("s", "rest", "theta", "below").orderBy("bin")  # at most BINS rows a source
        run = bins.withColumn("upto", F.col("below") + F.sum("words").over(upto))
        # the first bin that passes the target is refined next; all below it is taken
        over = F.col("upto") > F.col("rest")
        edge = run.groupBy("s").agg(F.min(F.when(over, F.col("bin"))).alias("bin"),
                                    F.max(F.when(~over, F.col("upto"))).alias("upto"))
        j = cut.join(edge, cut["source"].eqNullSafe(edge["s"]), "left")
        reached = F.when(F.col("bin").isNotNull(), F.col("bin") * width).when(F.col("upto").isNotNull(), width * BINS)
        cut = staged(j.select(*plan.columns, "rest", (F.col("theta") + F.coalesce(reached, F.lit(0.0))).alias("theta"),
                              F.coalesce("upto", "below").alias("below")), "mix-cut")
    # the documents of the bin at the threshold are taken too if that comes nearer to the target
    c = cut.select(F.col("source").alias("s"), "theta")
    nxt = (rows.join(c, rows["source"].eqNullSafe(F.col("s")))
               .where((F.col("key") >= F.col("theta")) & (F.col("key") < F.col("theta") + width))
               .groupBy("s").agg(F.sum("size").alias("more")))
    j = cut.join(nxt, cut["source"].eqNullSafe(nxt["s"]), "left")
    gain = F.abs(F.col("rest") - F.col("below") - F.col("more")) < F.abs(F.col("rest") - F.col("below"))
    return staged(j.select(*plan.columns, F.when(gain, F.col("theta") + width).otherwise(F.col("theta")).alias("theta")),
                  "mix-plan")


def fit(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """One row per source: sizes, target, tilt and rounding threshold."""
    sizes = staged(sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "mix-sizes")
    return thresholds(sized, balance(sizes, targets(sizes, weights, share, cap), cap), cap)


def copies(sized: DataFrame, plan: DataFrame, cap: float = CAP) -> DataFrame:
    """``sized`` with ``source_size``, ``target``, ``rate`` and whole ``copies``."""
    p = plan.withColumnRenamed("source", "_s")
    rows = _rounded(sized.join(p, sized["source"].eqNullSafe(F.col("_s")), "left"), cap)
    more = F.coalesce(F.col("key") < F.col("theta"), F.lit(False)).cast("long")
    return rows.withColumn("copies", F.col("base") + more).select(*sized.columns, "source_size", "target", "rate", "copies")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """The mixture itself: every row of ``docs`` as often as it has copies."""
    plan = fit(staged(_sized(docs, id_col, text_col, source_col), "mix-sized"), weights, share, cap)
    rows = packed(docs, *[_sized_columns(id_col, text_col, source_col)[c].alias(c) for c in ("source", "size", "u")])
    taken = copies(rows, plan, cap).where("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")


def op3_mixing(spark, sf_dir):
    """Contract query: the words that the mix takes of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    sized = staged(_sized(docs, "doc_id", "text", "source"), "mix-sized")
    return copies(sized, fit(sized)).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target",
        (F.col("copies") * F.col("size")).alias("taken"), "copies")
