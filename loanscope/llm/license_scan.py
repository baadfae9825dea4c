"""Licence scans: ordered signature rules over normalised words, natively.

Each rule (``license_rules``) is a regex with keywords, one of which any match contains.  A text that holds no keyword
costs one pass of substring searches; the others are reduced to lower-case words joined by one
space, the rules whose keyword occurs run over them, and matches become word intervals.  An interval
contained in another of the same or a stronger priority is suppressed, so "gpl" inside "gpl
version 3" or a title inside a notice is told once.  All in one map-only projection: no shuffle,
no group that could be hot, and a lost task repeats only its own split.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanscope.llm.common import match_spans, text_of
from loanscope.llm.license_rules import Rule, rules
from loanscope.sources.tables import read_table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PRIORITIES = 4


def lower_ascii(text: Column) -> Column:
    """Lower-cases A-Z alone.  ``lower`` does that for plain ASCII texts, at less cost."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def spaces(s: Column) -> Column:
    return F.length(s) - F.length(F.replace(s, F.lit(" ")))


def keyword_gate(text: Column, table: list[Rule]) -> Column:
    """Whether any rule's keyword occurs; keywords that contain another one are covered by it."""
    words = {k for r in table for k in r.keywords}
    least = sorted(w for w in words if not any(o != w and o in w for o in words))
    return reduce(lambda a, b: a | b, [text.contains(w) for w in least])


def _rule_array(table: list[Rule]) -> Column:
    return F.array(*[F.struct(F.lit(r.rule).alias("rule"), F.lit(r.label).alias("label"), F.lit(r.priority).alias("priority"),
                              F.lit(r.confidence).alias("confidence"), F.array(*map(F.lit, r.keywords)).alias("keywords"),
                              F.lit(f" (?:{r.regex})(?= )").alias("regex")) for r in table])


SPAN = "struct<first:int,neg_end:int,priority:int,rule:int,label:string,confidence:double>"


def _matches(words: Column, r: Column) -> Column:
    """Intervals of one rule's matches in ``words`` (" w0 w1 ... "), in words, end exclusive."""
    return F.transform(match_spans(words, r["regex"], spaces), lambda x: F.struct(
        x["s"].alias("first"), (-x["e"]).alias("neg_end"), r["priority"].alias("priority"), r["rule"].alias("rule"), r["label"].alias("label"),
        r["confidence"].alias("confidence")))


def _unsuppressed(spans: Column) -> Column:
    """Base spans, and spans contained in none of the same or a stronger priority.

    Sorted by (first, -end, priority, rule) a span's containers come before it, so one
    sweep with the largest end so far for each priority decides.
    """
    tops = [f"e{p}" for p in range(1, PRIORITIES + 1)]
    zero = F.struct(*[F.lit(-1).alias(e) for e in tops], F.expr(f"cast(array() as array<{SPAN}>)").alias("out"))

    def add(acc, s):
        end = -s["neg_end"]
        base = s["priority"] == 0
        covered = reduce(lambda a, b: a | b, [(s["priority"] == p) & (acc[e] >= end) for p, e in enumerate(tops, 1)])
        return F.struct(*[F.when(~base & (s["priority"] <= p), F.greatest(acc[e], end)).otherwise(acc[e]).alias(e)
                          for p, e in enumerate(tops, 1)],
                        F.when(covered, acc["out"]).otherwise(F.concat(acc["out"], F.array(s))).alias("out"))

    return F.aggregate(F.array_sort(spans), zero, add, lambda acc: acc["out"])


def license_scan(docs: DataFrame, table: list[Rule] | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, detections (array of first, neg_end, priority, rule,
    label, confidence), in order of first word; priority 0 marks the base phrases.

    Null text counts as empty: no words, no detections.  Repeated rows are scanned alike.  Other
    columns are not read.
    """
    table = rules() if table is None else table
    t = docs.select("doc_id", lower_ascii(text_of(docs)).alias("t"))
    t = t.select("doc_id", keyword_gate(F.col("t"), table).alias("gate"),
                 F.concat(F.lit(" "), F.trim(F.regexp_replace("t", NOT_WORD, " ")), F.lit(" ")).alias("w"))
    none = F.expr(f"cast(array() as array<{SPAN}>)")
    hits = F.filter(_rule_array(table), lambda r: F.exists(r["keywords"], lambda k: F.contains(F.col("w"), k)))
    spans = F.flatten(F.transform(hits, lambda r: _matches(F.col("w"), r)))
    n_words = F.when(F.col("w") == "  ", 0).otherwise(spaces(F.col("w")) - 1)
    return t.select("doc_id", n_words.cast("long").alias("n_words"),
                    F.when(F.col("gate"), spans).otherwise(none).alias("spans")
                    ).select("doc_id", "n_words", _unsuppressed(F.col("spans")).alias("detections"))


def _labels(spans: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")


def scan_digest(scanned: DataFrame) -> DataFrame:
    base = F.filter("detections", lambda s: s["priority"] == 0)
    starts = F.transform(base, lambda s: s["first"].cast("long"))
    # Noisy-or over the labels: each counts with its best detection, in a fixed order.
    by_label = F.transform(F.array_sort(F.array_distinct(F.transform("detections", lambda s: s["label"]))), lambda x: F.array_max(
        F.transform(F.filter("detections", lambda s: s["label"] == x), lambda s: s["confidence"])))
    missed = F.aggregate(by_label, F.lit(1.0).cast("double"), lambda acc, c: acc * (1 - c))
    return scanned.select("doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
                          F.array_max(starts).alias("last_word"), _labels(base).alias("base_labels"),
                          _labels(F.col("detections")).alias("labels"), F.round(1 - missed, 6).alias("score"),
                          F.size("detections").cast("long").alias("n_detections"))


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_digest(license_scan(read_table(spark, sf_dir, "documents")))


def op1_sql(table: list[Rule] | None = None) -> str:
    """The scan as DuckDB SQL: every rule over every text, without gates; words are parted by two spaces there,
    so that a match takes its own space on either side."""
    def doubled(regex: str) -> str:
        return regex.replace(" ?", "\0").replace(" ", "  ").replace("\0", "(?:  )?").replace("'", "''")

    values = ",\n  ".join(f"({r.rule}, '{r.label}', {r.priority}, {r.confidence}, ' (?:{doubled(r.regex)}) ')"
                          for r in (rules() if table is None else table))
    covered = " OR ".join(f"(priority = {p} AND coalesce(max(e) FILTER (priority BETWEEN 1 AND {p}) OVER before, -1) >= e)"
                          for p in range(1, PRIORITIES + 1))
    return f"""
WITH rules(rule, label, priority, confidence, regex) AS (VALUES
  {values}),
d AS (SELECT row_number() OVER () AS r, CAST(doc_id AS BIGINT) AS doc_id,
        trim(regexp_replace(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{NOT_WORD}', ' ', 'g'), ' ') AS t FROM documents),
w AS (SELECT r, doc_id, CASE WHEN t = '' THEN 0 ELSE length(t) - length(replace(t, ' ', '')) + 1 END AS n_words,
        ' ' || replace(t, ' ', '  ') || ' ' AS w FROM d),
found AS (SELECT r, rule, label, priority, confidence, regexp_extract_all(w, regex) AS m, string_split_regex(w, regex) AS g
          FROM w, rules WHERE regexp_matches(w, regex)),
each AS (SELECT r, rule, label, priority, confidence, i, length(m[i]) - length(replace(m[i], ' ', '')) AS n, length(g[i]) - length(replace(g[i], ' ', '')) AS gap
         FROM (SELECT *, unnest(generate_series(1, len(m))) AS i FROM found)),
spans AS (SELECT r, rule, label, priority, confidence, CAST((sum(gap + n) OVER o - n) / 2 AS BIGINT) AS s, CAST(sum(gap + n) OVER o / 2 AS BIGINT) AS e
          FROM each WINDOW o AS (PARTITION BY r, rule ORDER BY i)),
kept AS (SELECT r, rule, label, priority, confidence, s FROM spans
         WINDOW before AS (PARTITION BY r ORDER BY s, e DESC, priority, rule ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
         QUALIFY NOT ({covered})),
labels AS (SELECT r, label, max(confidence) AS c FROM kept GROUP BY r, label),
score AS (SELECT r, round(1 - product(1 - c), 6) AS score, string_agg(label, ',' ORDER BY label) AS labels FROM labels GROUP BY r),
base AS (SELECT r, count(*) AS n_base, min(s) AS first_word, max(s) AS last_word,
           array_to_string(list_sort(list(DISTINCT label)), ',') AS base_labels FROM kept WHERE priority = 0 GROUP BY r),
n AS (SELECT r, count(*) AS n_detections FROM kept GROUP BY r)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
       coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score, coalesce(n_detections, 0) AS n_detections
FROM w LEFT JOIN base USING (r) LEFT JOIN score USING (r) LEFT JOIN n USING (r)
"""
