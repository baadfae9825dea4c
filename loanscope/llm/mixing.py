"""Mixing sources to target weights: raking to marginals, then calibrated sampling, natively.

Token weights are raked: the tokens of each (source, language, topic) cell are multiplied by one factor
per source, language and topic until the cells' sums meet the targets of all three marginals (iterative
proportional fitting).  A document's inclusion probability is its cell's factor over the largest factor,
times ``share``, so in expectation the sampled tokens have the target marginals, and no
probability exceeds 1.  A document is in the sample if a hash of its id falls below its probability:
the sample is the same in every run and nested for smaller shares.  Raking ends when a round moves next to nothing, or after
``ROUNDS`` rounds where no weights meet all targets (they contradict each other, or cells are empty); ``gap``, the
largest difference left between a marginal and its target as a share of all tokens, tells which, and a caller can refuse it.

Documents are counted by cell and later joined with the cells' probabilities; in between all is on cells, aggregated map-side, so a source with a third of all rows is one row per task and cell.
Each round of raking is landed; marginals join back by size, as the planner finds them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanscope.llm.common import land, packed, quoted
from loanscope.llm.exact_dedup import normalised
from loanscope.sources.tables import read_table

DIMENSIONS = ("source", "lang", "topic")
FLATTEN = 0.9  # default targets: each marginal's token shares to this power
ROUNDS = 50
TOLERANCE = 1e-6  # of all tokens, moved in a round
SEED = 17
MISSING = ""  # the category of a null source or language


def word_tokens(text: Column) -> Column:
    """Words between white space stand for tokens."""
    t = F.trim(normalised(text))
    return F.when(t == "", 0).otherwise(F.length(t) - F.length(F.replace(t, F.lit(" "))) + 1).cast("long")


def surface_topic(text: Column) -> Column:
    """A document's topic by its form; the first that fits."""
    return (F.when(text.contains("icensed") | text.contains("opyright") | text.contains("ights reserved"), "legal")
            .when(text.contains("@"), "contact")
            .when(text.rlike(r"[0-9]{4}"), "figures")
            .when(F.length(text) >= 8000, "longform")
            .when(F.length(text) < 500, "note").otherwise("prose"))


def categorised(docs: DataFrame, topic: Callable[[Column], Column] = surface_topic) -> DataFrame:
    """row (of ``docs``), source, lang, topic (never null) and tokens."""
    text = F.coalesce("row.text", F.lit(""))
    return packed(docs).select("row", *[F.coalesce(F.col(f"row.{d}").cast("string"), F.lit(MISSING)).alias(d) for d in ("source", "lang")],
                               F.coalesce(topic(text), F.lit(MISSING)).alias("topic"), word_tokens(text).alias("tokens"))


def default_targets(cells: DataFrame, dimension: str, power: float = FLATTEN) -> DataFrame:
    shares = cells.groupBy(dimension).agg(F.sum("tokens").alias("t")).filter("t > 0")
    return shares.select(dimension, F.pow(F.col("t").cast("double"), F.lit(power)).alias("want"))


def raked(cells: DataFrame, targets: Mapping[str, DataFrame], rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> tuple[DataFrame, float]:
    """``cells`` (source, lang, topic, tokens) with ``w``, tokens raked to the targets' marginals, and the gap left.

    ``targets``: for a dimension its values and ``want`` (any scale).  Values without a target get weight 0;
    targets of absent values are left out and the others scaled to the same total.
    """
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    if not total:
        return cells.withColumn("w", F.lit(0.0)), 0.0
    present = {}
    for d in DIMENSIONS:
        t = targets[d].groupBy(d).agg(F.sum("want").alias("want")).join(cells.filter("tokens > 0").select(d).distinct(), d)
        t = land(t, f"mix-target-{d}")
        scale = t.agg(F.sum("want")).first()[0]
        present[d] = t.select(d, (F.col("want") * (float(total) / scale)).alias("want")) if scale else t.select(d, F.lit(0.0).alias("want"))
    now = land(cells.withColumn("w", F.col("tokens").cast("double")), "mix-cells")
    for _ in range(rounds):
        step = now.withColumn("was", F.col("w"))
        for d in DIMENSIONS:
            sums = step.groupBy(d).agg(F.sum("w").alias("has"))
            factor = sums.join(present[d], d, "left").select(
                d, F.when(F.col("has") > 0, F.coalesce("want", F.lit(0.0)) / F.col("has")).otherwise(0.0).alias("f"))
            step = step.join(factor, d).withColumn("w", F.col("w") * F.col("f")).drop("f")
        now = land(step, "mix-round")
        moved = now.agg(F.sum(F.abs(F.col("w") - F.col("was")))).first()[0]
        now = now.drop("was")
        if moved <= tolerance * total:
            break
    gap = 0.0
    for d in DIMENSIONS:
        sums = now.groupBy(d).agg(F.sum("w").alias("has")).join(present[d], d, "full")
        off = F.abs(F.coalesce("has", F.lit(0.0)) - F.coalesce("want", F.lit(0.0)))
        gap = max(gap, (sums.agg(F.max(off)).first()[0] or 0.0) / total)
    return now, gap


def cell_probabilities(rows: DataFrame, targets: Mapping[str, DataFrame | Mapping[str, float]] | None = None, share: float = 1.0,
                       most_gap: float | None = None) -> DataFrame:
    """(source, lang, topic, tokens, weight, probability, gap) of ``categorised`` rows: weight is the factor of a cell's tokens.

    A cell without tokens has weight 0 and the probability 0.  A gap above ``most_gap`` is an error.
    """
    cells = land(rows.groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("tokens")), "mix-counts")
    given = targets or {}
    wanted = {}
    for d in DIMENSIONS:
        t = given.get(d)
        if t is None:
            wanted[d] = default_targets(cells, d)
        elif isinstance(t, Mapping):
            wanted[d] = cells.sparkSession.createDataFrame([(k, float(v)) for k, v in t.items()], f"{d} string, want double")
        else:
            wanted[d] = t
    done, gap = raked(cells, wanted)
    if most_gap is not None and gap > most_gap:
        raise ValueError(f"no weights meet the targets: a marginal is {gap:.4f} of all tokens off, at most {most_gap} allowed")
    done = done.withColumn("weight", F.when(F.col("tokens") > 0, F.col("w") / F.col("tokens")).otherwise(0.0))
    most = done.agg(F.max("weight")).first()[0] or 1.0
    return land(done.select(*DIMENSIONS, "tokens", "weight", (F.col("weight") * (share / most)).alias("probability"), F.lit(gap).alias("gap")), "mix-probabilities")


def with_probability(rows: DataFrame, cells: DataFrame, seed: int = SEED) -> DataFrame:
    """``categorised`` rows with weight, probability, gap and sampled."""
    # 53 bits of a hash, as a fraction.
    u = F.shiftrightunsigned(F.xxhash64(F.col("row.doc_id"), F.lit(seed)), 11).cast("double") / float(1 << 53)
    return rows.join(cells.drop("tokens"), list(DIMENSIONS)).withColumn("sampled", u < F.col("probability"))


def mixed(docs: DataFrame, targets: Mapping[str, DataFrame | Mapping[str, float]] | None = None,
          topic: Callable[[Column], Column] = surface_topic, share: float = 1.0, seed: int = SEED, most_gap: float | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, lang, topic, n_tokens, weight, probability, sampled, gap.

    Null source or language is a category of its own (null here, '' in targets); null text counts as empty,
    with no tokens.  Repeated rows count each and are sampled alike, as are all null ids.  An empty table
    gives an empty result; other columns are not read.  Targets that no weights meet show as ``gap`` (0 if all are met).
    """
    # Landed without the text, so that texts are read once.
    rows = categorised(docs.select("doc_id", "text", "source", "lang"), topic)
    rows = land(rows.withColumn("row", F.col("row").dropFields("text")), "mix-rows")
    return with_probability(rows, cell_probabilities(rows, targets, share, most_gap), seed).select(
        F.col("row.doc_id").cast("long").alias("doc_id"), "row.source", "row.lang", "topic", F.col("tokens").alias("n_tokens"),
        "weight", "probability", "sampled", "gap")


def sampled_mix(docs: DataFrame, targets: Mapping[str, DataFrame | Mapping[str, float]] | None = None,
                topic: Callable[[Column], Column] = surface_topic, share: float = 1.0, seed: int = SEED, most_gap: float | None = None) -> DataFrame:
    """The sampled rows of ``docs``, all columns, with topic, probability and gap (in place of columns of these names, in any case).

    Texts are read twice, once for the cells and once for the sample, as a sample may be most of them.
    """
    rows = categorised(docs, topic)
    sample = with_probability(rows, cell_probabilities(rows, targets, share, most_gap), seed).filter("sampled")
    told = ("topic", "probability", "gap")
    own = [F.col(f"row.{quoted(c)}").alias(c) for c in docs.columns if c.lower() not in told]
    return sample.select(*own, *told)


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(read_table(spark, sf_dir, "documents"))
