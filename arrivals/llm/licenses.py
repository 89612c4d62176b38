"""License scan by ordered signature rules, in DataFrame functions throughout.

Rules (`license_rules`) are regular expressions over normalised words, some three hundred, in order of priority. A text is normalised
once; the keywords of the rules are looked for in it, and only rules whose keyword it holds are matched.
Every match is a detection: a rule and an interval of words. Overlapping detections are resolved:

1. containment: a detection whose interval another one of the same or a better rank contains is suppressed;
   of equal intervals the first rule's stays;
2. priority: of the others, a detection that overlaps one of a better rank is suppressed.

Texts are read once and do not move. What is stored and shuffled is, for each matching rule of a text, the
numbers of words between and in its matches. Intervals are summed and suppressed by windows over the
detections of one document, sorted, in time of n log n; a text may hold any number of them.

Defined cases: null and empty texts, and texts without words, have no words and no detections; their labels are empty
and their score is 0. Rows with equal ids, repeated rows included, are scanned as documents of their own. An
empty table gives an empty result. Of other columns none is needed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from arrivals.llm.common import store, table, text_or_empty
from arrivals.llm.license_rules import Rule, rules

RANKS = (1, 2, 3, 4)
# Confidence in a detection, by its rank.
CONFIDENCE = {1: 1.0, 2: 0.95, 3: 0.8, 4: 0.4}

# ASCII characters that are no word characters; capitals are turned into small letters with them.
_OTHER = "".join(map(chr, (*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80))))
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _spaced(words: str) -> str:
    """Words, or a pattern, in the normal form: with a blank of its own on either side of each word."""
    return words.replace(" ", "  ")


def keyword_of(rule: Rule) -> str:
    """What a text in normal form holds if it holds the rule's keyword."""
    return " " + _spaced(rule.keyword.strip("*").replace("_", " ")) + ("" if rule.keyword.endswith("*") else " ")


def _any_of(keywords: list[str]) -> str:
    """A pattern that finds any keyword, in one pass; those with one first letter are tried together."""
    by_letter: dict[str, list[str]] = {}
    for k in keywords:
        by_letter.setdefault(k[1], []).append(k[2:])
    return " (?:" + "|".join(f"{letter}(?:{'|'.join(rest)})" for letter, rest in sorted(by_letter.items())) + ")"


def pattern_of(rule: Rule) -> str:
    """The rule's pattern for texts in normal form; a blank that may be absent is both blanks or none."""
    return f" (?:{_spaced(rule.pattern.replace(' ?', '(?: )?'))}) "


def normal_form(text: Column) -> Column:
    """Words in lower case, each between two blanks of its own: ` w0  w1  w2 `; empty without words."""
    plain = F.translate(text, _CAPITALS + _OTHER, _CAPITALS.lower() + " " * len(_OTHER))
    words = F.trim(F.regexp_replace(plain, "  +", " "))
    return F.when(words != "", F.concat(F.lit(" "), F.replace(words, F.lit(" "), F.lit("  ")), F.lit(" "))).otherwise("")


def _n_words(normal: Column) -> Column:
    """Words of a piece in normal form."""
    return F.floor((F.octet_length(normal) - F.octet_length(F.replace(normal, F.lit(" "), F.lit("")))) / 2).cast("int")


def matches(docs: DataFrame, scanned: list[Rule] | None = None) -> DataFrame:
    """doc_id, n_words, and found: for each rule that matches, the words before each match (since the last) and in it."""
    scanned = rules() if scanned is None else scanned
    keywords = sorted({keyword_of(r) for r in scanned})
    listed = F.array(*[F.struct(F.lit(r.number).alias("rule"), F.lit(keyword_of(r)).alias("keyword"), F.lit(pattern_of(r)).alias("pattern")) for r in scanned])
    normal = F.col("normal")
    held = F.when(F.rlike(normal, F.lit(_any_of(keywords))), F.filter(F.array(*map(F.lit, keywords)), lambda k: F.contains(normal, k)))
    candidates = F.filter(listed, lambda r: F.array_contains(F.col("held"), r["keyword"]))

    def tried(r: Column) -> Column:
        inside = F.transform(F.regexp_extract_all(normal, r["pattern"], F.lit(0)), _n_words)
        between = F.transform(F.split(normal, r["pattern"], -1), _n_words)
        return F.struct(r["rule"].alias("rule"), between.alias("between"), inside.alias("inside"))

    found = F.filter(F.transform(candidates, tried), lambda m: F.size(m["inside"]) > 0)
    return (
        docs.select("doc_id", normal_form(text_or_empty()).alias("normal"))
        .select("doc_id", "normal", _n_words(normal).cast("bigint").alias("n_words"), held.alias("held"))
        .select("doc_id", "n_words", F.when(F.size("held") > 0, found).alias("found"))
    )


def detections(found: DataFrame, scanned: list[Rule] | None = None) -> DataFrame:
    """One row for each match of the rows of `found` (row, and found as of `matches`): row, rule, rank, label, base, first, stop, kept."""
    scanned = rules() if scanned is None else scanned
    # At most a few hundred rows, fixed in the code.
    known = found.sparkSession.createDataFrame([(r.number, r.rank, r.label, r.base) for r in scanned], "rule int, rank int, label string, base boolean")
    each = found.select("row", F.explode("found").alias("m")).select("row", "m.rule", F.posexplode(F.arrays_zip("m.between", "m.inside")).alias("at", "of"))
    # Behind the last match come more words, but no match.
    each = each.filter(F.col("of.inside").isNotNull()).repartition("row")
    upto = Window.partitionBy("row", "rule").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    stop = F.sum(F.col("of.between").cast("bigint") + F.col("of.inside")).over(upto)
    spans = each.select("row", "rule", stop.alias("stop"), (stop - F.col("of.inside")).alias("first"))
    spans = spans.join(F.broadcast(known), "rule")
    before = Window.partitionBy("row").orderBy("first", F.col("stop").desc(), "rule").rowsBetween(Window.unboundedPreceding, -1)
    reach = {r: F.max(F.when(F.col("rank") <= r, F.col("stop"))).over(before).alias(f"reach{r}") for r in RANKS}
    contained = F.coalesce(_by_rank({r: F.col(f"reach{r}") for r in RANKS}) >= F.col("stop"), F.lit(False))
    spans = spans.select("*", *reach.values()).withColumn("contained", contained).drop(*(f"reach{r}" for r in RANKS))
    at = Window.partitionBy("row").orderBy("first")
    back, onward = at.rangeBetween(Window.unboundedPreceding, 0), at.rangeBetween(Window.currentRow, Window.unboundedFollowing)
    better = {r: F.when(~F.col("contained") & (F.col("rank") < r), F.struct("first", "stop")) for r in RANKS}
    ends = [F.max(better[r]["stop"]).over(back).alias(f"end{r}") for r in RANKS] + [F.min(better[r]["first"]).over(onward).alias(f"next{r}") for r in RANKS]
    overlaps = (_by_rank({r: F.col(f"end{r}") for r in RANKS}) > F.col("first")), (_by_rank({r: F.col(f"next{r}") for r in RANKS}) < F.col("stop"))
    outranked = reduce(Column.__or__, (F.coalesce(o, F.lit(False)) for o in overlaps))
    return spans.select("*", *ends).select("row", "rule", "rank", "label", "base", "first", "stop", (~F.col("contained") & ~outranked).alias("kept"))


def _by_rank(of: dict[int, Column]) -> Column:
    """The value for a row's own rank."""
    return reduce(lambda out, r: out.when(F.col("rank") == r, of[r]), RANKS[1:], F.when(F.col("rank") == RANKS[0], of[RANKS[0]]))


def scan(docs: DataFrame, scanned: list[Rule] | None = None) -> DataFrame:
    """One row for each document: doc_id, n_words, and what was detected.

    n_base, first_word, last_word and base_labels are of the base phrases, at all their places; labels also
    has those of the other detections that were kept; score is the confidence of the best one kept, 0 if
    there is none; spans are all detections kept: first, stop (exclusive), label, rule.
    """
    # Numbered once, in what is stored: a row is then the same row in every later read.
    found = store(matches(docs, scanned).withColumn("row", F.monotonically_increasing_id()))
    some = detections(found.filter(F.size("found") > 0), scanned)
    base, kept = F.col("base"), F.col("kept")
    confidence = reduce(lambda out, r: out.when(F.col("rank") == r, CONFIDENCE[r]), RANKS[1:], F.when(F.col("rank") == RANKS[0], CONFIDENCE[RANKS[0]]))
    by_row = some.groupBy("row").agg(
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("first"))).alias("first_word"),
        F.max(F.when(base, F.col("first"))).alias("last_word"),
        F.array_sort(F.collect_set(F.when(base, F.col("label")))).alias("base_labels"),
        F.array_sort(F.collect_set(F.when(base | kept, F.col("label")))).alias("labels"),
        F.max(F.when(kept, confidence)).alias("score"),
        F.array_sort(F.collect_list(F.when(kept, F.struct("first", "stop", "label", "rule")))).alias("spans"),
    )
    with_some = found.filter(F.size("found") > 0).drop("found").join(by_row, "row").drop("row")
    nothing = found.filter(F.coalesce(F.size("found") <= 0, F.lit(True))).select("doc_id", "n_words")
    return with_some.unionByName(nothing, allowMissingColumns=True).select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("bigint").alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.array().cast("array<string>")).alias("base_labels"),
        F.coalesce("labels", F.array().cast("array<string>")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
        F.coalesce("spans", F.array().cast("array<struct<first:bigint,stop:bigint,label:string,rule:int>>")).alias("spans"),
    )


def op13_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


def _sql() -> str:
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    values = ",\n".join(
        f"({r.number}, {r.rank}, {quoted(r.label)}, {r.base}, {quoted(keyword_of(r))}, {quoted(pattern_of(r))})" for r in rules()
    )
    confidence = " ".join(f"WHEN {r} THEN {c}::DOUBLE" for r, c in CONFIDENCE.items())
    return rf"""
        WITH rules(rule, rank, label, base, keyword, pattern) AS (VALUES {values}),
        docs AS (
            SELECT doc_id, row_number() OVER () AS row,
                   regexp_extract_all(translate(coalesce(text, ''), '{_CAPITALS}', '{_CAPITALS.lower()}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
            FROM documents
        ), normal AS (
            SELECT doc_id, row, len(words) AS n_words, CASE WHEN len(words) > 0 THEN ' ' || array_to_string(words, '  ') || ' ' ELSE '' END AS normal FROM docs
        ), hits AS (
            SELECT row, rule, rank, label, base, regexp_extract_all(normal, pattern) AS inside, string_split_regex(normal, pattern) AS between
            FROM normal JOIN rules ON contains(normal, keyword)
        ), each AS (
            SELECT row, rule, rank, label, base, i,
                   (strlen(inside[i]) - strlen(replace(inside[i], ' ', ''))) // 2 AS n,
                   (strlen(between[i]) - strlen(replace(between[i], ' ', ''))) // 2 AS skipped
            FROM hits, unnest(range(1, len(inside) + 1)) r(i)
        ), ends AS (
            SELECT *, sum(n + skipped) OVER (PARTITION BY row, rule ORDER BY i)::BIGINT AS stop FROM each
        ), spans AS (
            SELECT row, rule, rank, label, base, stop - n AS first, stop FROM ends
        ), outer_most AS (
            SELECT s.*, EXISTS (
                SELECT 1 FROM spans o WHERE o.row = s.row AND o.first <= s.first AND o.stop >= s.stop AND o.rank <= s.rank
                  AND (o.first, -o.stop, o.rule) < (s.first, -s.stop, s.rule)
            ) AS contained FROM spans s
        ), resolved AS (
            SELECT s.*, NOT contained AND NOT EXISTS (
                SELECT 1 FROM outer_most o WHERE o.row = s.row AND NOT o.contained AND o.rank < s.rank AND o.first < s.stop AND o.stop > s.first
            ) AS kept FROM outer_most s
        ), by_row AS (
            SELECT row, count(*) FILTER (base) AS n_base, min(first) FILTER (base) AS first_word, max(first) FILTER (base) AS last_word,
                   string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
                   string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base OR kept) AS labels,
                   max(CASE rank {confidence} END) FILTER (kept) AS score
            FROM resolved GROUP BY row
        )
        SELECT doc_id, n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
               coalesce(labels, '') AS labels, coalesce(score, 0::DOUBLE) AS score
        FROM normal LEFT JOIN by_row USING (row)
    """


QUERIES = {"op13_licenses": op13_licenses}
SQL = {"op13_licenses": _sql()}
