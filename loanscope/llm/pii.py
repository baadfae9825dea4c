"""PII: base identifiers by pattern, and information-theoretic sanitisation, natively.

The base kinds (email, ip, card, phone) are leftmost non-overlapping regex matches that pass
their check.  What is said with an identifier can give it away too, so the corpus tells how strongly: an
identifier value c and a term t (a word outside identifiers, in lower case) are together in n(c, t) of the n(c) different texts
that hold c, and t is in n(t) of all N different texts (copies of a text are one in all four counts).  The pointwise information
PMI(c; t) = log2((n(c, t) / n(c)) / (n(t) / N)) is the part of the information content IC(c) = log2(N / n(c)) of c that t discloses.
In all texts that hold c, every occurrence of a term with PMI >= ``generalise`` * IC(c) is generalised (its shape stays); from
``remove`` * IC(c) on it is removed.
No number of co-occurrences is asked for: a pair counts unless chance would explain it.  Were c and t
independent, they would share m = n(c) * n(t) / N, and n(c, t) = m * 2^PMI or more of them with a probability of at most
exp(-n(c, t) * (ln 2 * PMI - 1) - m) (Chernoff), which must not exceed 1 - ``confidence``.  That bound is for one pair: a text that
tests thousands has words marked by chance, so a word seen once goes wherever an identifier seen once is.  ``all_pairs``
divides 1 - ``confidence`` by the number of pairs tested instead, which marks few words that are not repeated beside their identifier.

1. A map-only pass finds the base spans of every text, gated by substring tests.
2. n(t) is counted over all different texts, distinct terms of a text exploded and pre-aggregated.
3. Identifiers that the same texts hold have the same counts with every term, and so have terms of the same texts and
   n(t) with every identifier: both are collapsed into classes, and a text pairs its classes, not its identifiers and words (a page
   of 300 addresses and 2,000 words seen nowhere else is one pair).  Words too common to disclose any identifier drop out by
   n(t) before.  Pairs are counted by map-side aggregation, so a hot identifier is one row per task and class of terms.
4. Places of the terms past the threshold come back to the documents with identifiers; the others skip that join.

Regexes are written for bounded work on long texts: a match of a greedy class that failed at the
start of a run fails at its other places too, so a run is tried at its start (or where the previous match
ended) only; loops are possessive where what follows cannot match what they took.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanscope.llm.common import land, let, match_spans, text_of
from loanscope.sources.tables import read_table

KINDS = ("email", "ip", "card", "phone")
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?:\G|(?<![0-9]))[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

BLOCK = 4096  # characters; see in_blocks
PART = 1024  # classes of terms of a text that one task pairs with the text's identifiers
CONFIDENCE = 0.99
GENERALISE = 0.75
REMOVE = 0.95
WORD = r"[\p{L}\p{N}]++"

SPANS = "array<struct<s:int,k:int,e:int,m:string>>"
ACTIONS = "array<struct<s:int,k:int,e:int,action:string>>"


def _digits(m: Column) -> Column:
    return F.translate(m, " -().+", "")


def luhn_valid(digits: Column) -> Column:
    """Luhn over a digit string: from the right every second digit counts double, less 9 if over 9."""
    at = F.sequence(F.lit(1), F.length(digits))
    total = F.aggregate(at, F.lit(0), lambda acc, i: acc + F.pmod(
        F.substring(digits, -i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1), F.lit(10))
        + F.when((i % 2 == 0) & (F.substring(digits, -i, F.lit(1)).cast("int") > 4), 1).otherwise(0))
    return total % 10 == 0


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(m, r"\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.right(p, F.lit(3)).cast("int") <= 255))
    if kind == "card":
        n = F.length(_digits(m))
        return F.when(n.between(12, 19), luhn_valid(_digits(m))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(m)).between(9, 15)
    return F.lit(True)


def _gate(kind: str, text: Column) -> Column:
    """Lossless and cheap: what any match contains."""
    if kind == "email":
        return text.contains("@")
    if kind == "phone":
        return text.contains("+")
    return text.rlike(r"[0-9]\.[0-9]" if kind == "ip" else r"[0-9](?:[\x20-]?[0-9]){11}")


def kind_spans(kind: str, text: Column) -> Column:
    """Array of (s, k, e, m) of one base kind: offsets in code points, end exclusive."""
    pattern = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE}[kind]
    k = F.lit(KINDS.index(kind)).alias("k")
    valid = F.filter(match_spans(text, pattern), lambda x: _valid(kind, x["m"]))
    spans = F.transform(valid, lambda x: F.struct(x["s"].alias("s"), k, x["e"].alias("e"), x["m"].alias("m")))
    return F.when(_gate(kind, text), spans).otherwise(F.expr(f"cast(array() as {SPANS})"))


def base_spans(text: Column) -> Column:
    """All base spans, sorted by start, then kind as listed."""
    return F.array_sort(F.concat(*[kind_spans(k, text) for k in KINDS]))


def _value(k: Column, m: Column) -> Column:
    """The identifier a span names: kind and normal form."""
    return F.concat_ws(":", k.cast("string"), F.when(k == 0, F.lower(m)).otherwise(_digits(m)))


def in_blocks(text: Column) -> Column:
    """The text as an array of ``BLOCK`` characters each, for ``between``."""
    n = (F.length(text) / BLOCK).cast("int")
    return F.transform(F.sequence(F.lit(0), n), lambda i: F.substring(text, i * BLOCK + 1, F.lit(BLOCK)))


def between(blocks: Column, a: Column, b: Column) -> Column:
    """Characters a to b (exclusive) of a text in blocks: a position costs no search through the whole text."""
    i, j = (a / BLOCK).cast("int"), (b / BLOCK).cast("int")
    head = F.substring(F.get(blocks, i), a % BLOCK + 1, F.lit(BLOCK))
    tail = F.substring(F.get(blocks, j), F.lit(1), b % BLOCK)
    return F.when(i == j, F.substring(F.get(blocks, i), a % BLOCK + 1, b - a)).otherwise(
        F.concat(head, F.array_join(F.slice(blocks, i + 2, j - i - 1), ""), tail))


def gap_before(blocks: Column, spans: Column, i: Column, x: Column) -> Column:
    """The text between span i (x) and the one before."""
    return between(blocks, F.when(i == 0, 0).otherwise(F.get(spans, i - 1)["e"]), x["s"])


def rest_after(blocks: Column, spans: Column, text: Column) -> Column:
    """The text after the last span, all of it without any."""
    return between(blocks, F.when(F.size(spans) == 0, 0).otherwise(F.get(spans, F.size(spans) - 1)["e"]), F.length(text))


def apart(spans: Column, kind: str) -> Column:
    """Spans (sorted by s) without those that begin inside an earlier one; the earlier one is stretched to cover them."""
    zero = F.expr(f"cast(array() as {kind})")

    def step(acc, x):
        last = F.element_at(acc, -1)
        longer = last.withField("e", F.greatest(last["e"], x["e"]))
        return F.when((F.size(acc) > 0) & (F.get(acc, F.size(acc) - 1)["e"] > x["s"]),
                      F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(longer))).otherwise(F.concat(acc, F.array(x)))

    touching = F.zip_with(spans, F.slice(spans, 2, F.size(spans)), lambda x, y: F.coalesce(x["e"] > y["s"], F.lit(False)))
    return F.when(F.size(spans) == 0, spans).when(~F.exists(touching, lambda t: t), spans).otherwise(F.aggregate(spans, zero, step))


def outside(text: Column, spans: Column) -> Column:
    """The text with its base spans blanked: offsets stay, and words end where an identifier begins."""
    return F.when(F.size(spans) == 0, text).otherwise(let(apart(spans, SPANS), lambda sp: let(in_blocks(text), lambda blocks: F.concat(
        F.array_join(F.transform(sp, lambda x, i: F.concat(gap_before(blocks, sp, i, x), F.repeat(F.lit(" "), x["e"] - x["s"]))), ""),
        rest_after(blocks, sp, text)))))


def document_frequencies(texts: DataFrame) -> DataFrame:
    """(t, nt): in how many of ``texts`` (h, text, spans, each text once) a term occurs outside identifiers."""
    said = F.regexp_extract_all(outside(F.col("text"), F.col("spans")), F.lit(WORD), F.lit(0))
    # Aggregated before any join: what is shuffled is one count per term and task.
    return texts.select(F.explode(F.array_distinct(F.transform(said, F.lower))).alias("t")).groupBy("t").agg(F.count("*").alias("nt"))


def occurrences(texts: DataFrame) -> DataFrame:
    """(h, t, at): the terms of each text outside identifiers, ``at`` the offsets (s, e) of all their places."""
    words = match_spans(F.col("blank"), WORD)
    each = texts.select("h", outside(F.col("text"), F.col("spans")).alias("blank")).select("h", F.explode(words).alias("w"))
    return each.groupBy("h", F.lower("w.m").alias("t")).agg(F.collect_list(F.struct("w.s", "w.e")).alias("at"))


def set_classes(held: DataFrame, key: str, *with_: str) -> DataFrame:
    """(key, class): what is held by the same set of texts is one class: ``n`` texts, the set by 128 bits (XOR of two
    hashes of its members, so that a hot key is one row per task), and the columns ``with_`` that depend on the key."""
    members = [F.bit_xor(F.xxhash64(F.lit(seed), F.col("h"))).alias(f"set{seed}") for seed in (1, 2)]
    return held.groupBy(key, *with_).agg(F.struct(*with_, F.count("*").alias("n"), *members).alias("class"))


def class_pairs(ids: DataFrame, terms: DataFrame) -> DataFrame:
    """(h, cc, ids, tc, words): each class of identifiers of a text beside each class of its terms.
    ``ids`` is (h, cc, ids), ``terms`` (h, tc, words); a text's terms are dealt over parts of about ``PART`` classes."""
    parts = terms.groupBy("h").agg(((F.count("*") / PART).cast("int") + 1).alias("parts"))
    left = ids.join(parts, "h").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    right = terms.join(parts, "h").withColumn("part", F.pmod(F.xxhash64("tc"), F.col("parts")).cast("int"))
    return left.drop("parts").join(right.drop("parts"), ["h", "part"])


def disclosing_terms(found: DataFrame, texts: DataFrame, n_texts: int, confidence: float, generalise: float,
                     all_pairs: bool = False) -> DataFrame:
    """(h, s, e, share): all places of terms that disclose at least ``generalise`` of the information content
    of an identifier of their text, with the largest share.  With ``all_pairs`` the error that ``confidence`` leaves is
    shared among all pairs of an identifier and a term that are tested."""
    held = land(found.select("h", F.explode(F.array_distinct(F.transform("spans", lambda x: _value(x["k"], x["m"])))).alias("c")).distinct(), "pii-held")
    kinds = set_classes(held, "c").withColumnRenamed("class", "cc")
    ids = land(held.join(kinds, "c").groupBy("h", "cc").agg(F.count("*").alias("ids")), "pii-identifiers")
    n = F.lit(float(n_texts))
    # As n(c, t) <= n(c), a share of g needs n(t) <= N^(1 - g) n(c)^g: common words drop out before the pairs.
    most = lambda count: F.pow(n, F.lit(1 - generalise)) * F.pow(count, F.lit(generalise)) * (1 + 1e-9)
    top = ids.agg(F.max("cc.n")).first()[0] or 0
    rare = document_frequencies(texts).filter(F.col("nt") <= most(F.lit(float(top))))
    places = land(occurrences(found.dropDuplicates(["h"])).join(rare, "t"), "pii-terms")
    kinds = set_classes(places, "t", "nt").select("t", F.col("class").alias("tc"))
    places = land(places.join(kinds, "t").select("h", "tc", "at"), "pii-places")
    terms = land(places.groupBy("h", "tc").agg(F.count("*").alias("words")), "pii-term-classes")
    pairs = land(class_pairs(ids, terms).filter(F.col("tc.nt") <= most(F.col("cc.n"))), "pii-pairs")

    nc, nt = F.col("cc.n"), F.col("tc.nt")
    ic = F.log2(n / nc)
    pmi = F.log2((F.col("nct") / nc) * n / nt)
    joint = pairs.groupBy("cc", "tc", "ids", "words").agg(F.count("*").alias("nct"))
    tested = joint.agg(F.sum(F.col("ids") * F.col("words"))).first()[0] or 1 if all_pairs else 1
    sure = F.col("nct") * (pmi * math.log(2) - 1) + nc * nt / n >= -math.log((1 - confidence) / tested)
    joint = joint.withColumn("share", F.when(ic > 0, pmi / ic).otherwise(0.0))
    telling = joint.filter((F.col("share") >= generalise) & sure).select("cc", "tc", "share")
    told = pairs.select("h", "cc", "tc").join(telling, ["cc", "tc"]).groupBy("h", "tc").agg(F.max("share").alias("share"))
    return places.join(told, ["h", "tc"]).select("h", "share", F.inline("at"))


def pii_spans(docs: DataFrame, confidence: float = CONFIDENCE, generalise: float = GENERALISE, remove: float = REMOVE,
              all_pairs: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, text, spans (array of s, k, e, action), sorted by s, k.

    k is 0-3 for email, ip, card, phone and 4 for a disclosing term; action is 'mask' (base kinds), 'generalise' or
    'remove'.  Null text counts as empty, empty texts and tables have no spans.  Spans follow from the text, so
    rows of repeated and null ids have their own.  Other columns are not read.
    """
    rows = docs.select(F.col("doc_id"), text_of(docs).alias("text"))
    rows = rows.withColumn("h", F.struct(F.xxhash64("text").alias("a"), F.hash("text").alias("b")))
    spotted = rows.withColumn("spans", base_spans(F.col("text")))
    found = land(spotted.filter(F.size("spans") > 0), "pii-found")
    texts = rows.select("h", "text").dropDuplicates(["h"]).withColumn("spans", base_spans(F.col("text")))
    n_texts = rows.select("h").distinct().count()
    places = disclosing_terms(found, texts, n_texts, confidence, generalise, all_pairs)
    action = F.when(F.col("share") >= remove, "remove").otherwise("generalise")
    terms = places.groupBy("h").agg(F.collect_list(F.struct("s", F.lit(4).alias("k"), "e", action.alias("action"))).alias("terms"))
    base = F.transform("spans", lambda x: F.struct(x["s"].alias("s"), x["k"].alias("k"), x["e"].alias("e"), F.lit("mask").alias("action")))
    none = F.expr(f"cast(array() as {ACTIONS})")
    with_terms = found.join(land(terms, "pii-spans"), "h", "left").select(
        "doc_id", "text", F.array_sort(F.concat(base, F.coalesce("terms", none))).alias("spans"))
    return spotted.filter(F.size("spans") == 0).select("doc_id", "text", none.alias("spans")).unionByName(with_terms)


def sanitise(spotted: DataFrame) -> DataFrame:
    """``pii_spans`` with ``clean``: base spans masked by kind, disclosing terms generalised to their shape or removed.
    Of base spans that overlap, the first one's mark stands for all."""
    names = F.array(*[F.lit(f"<{k}>") for k in KINDS])
    parts = spotted.withColumn("__spans", apart(F.col("spans"), ACTIONS)).withColumn("__blocks", in_blocks(F.col("text")))
    blocks, spans = F.col("__blocks"), F.col("__spans")

    def put(x, i):
        said = between(blocks, x["s"], x["e"])
        shape = F.regexp_replace(F.regexp_replace(F.regexp_replace(said, r"\p{Lu}", "A"), r"\p{L}(?<!A)", "a"), r"\p{N}", "9")
        mark = F.when(x["k"] < 4, F.get(names, x["k"])).when(x["action"] == "generalise", shape).otherwise("")
        return F.concat(gap_before(blocks, spans, i, x), mark)

    clean = F.when(F.size("spans") == 0, F.col("text")).otherwise(
        F.concat(F.array_join(F.transform("__spans", put), ""), rest_after(blocks, spans, F.col("text"))))
    return parts.withColumn("clean", clean).drop("__spans", "__blocks")


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in (*KINDS, "term")])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def pii_digest(spotted: DataFrame) -> DataFrame:
    count = lambda k: F.size(F.filter("spans", lambda x: x["k"] == k)).cast("long")
    base = F.filter("spans", lambda x: x["k"] < 4)
    return sanitise(spotted).select(
        "doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
        F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"),
        count(4).alias("n_terms"), F.sha2(F.col("clean").cast("binary"), 256).alias("clean_sha256"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_digest(pii_spans(read_table(spark, sf_dir, "documents")))
