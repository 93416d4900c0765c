"""Quality rules as a short-circuit cascade.

Every rule is a condition under which a text fails, and a measure of the work
that it takes to decide. On a sample of the texts the cascade estimates, for
each rule, the share that it rejects and its mean work, and orders the rules
by rejection per work; the verdict is one CASE expression in that order, so
Spark stops at the first rule that a text fails. The order changes what a
verdict costs, never the verdict. DataFrame functions only.

The measures that every row returns are there whatever the order, so a rule on
them alone costs one unit. The other rules read the text inside the CASE; their
work is what they visit: its characters, once for each pass over them.

A repeated window of words is found by hashes: an array of a text's window
hashes, and only where it isn't free of repeats, its sort with positions. So
a text is decided within its row, without a shuffle.

Cases: a null text counts as empty, which has no words and fails the length
rule; rows may repeat and are judged each; an empty table keeps the rules'
given order; other columns are carried by ``apply`` and ignored by the query.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airshed.llm.common import WORD, whole_text

#: Texts that the sample aims at.
SAMPLE_TEXTS = 4000
_SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
SYMBOLS = "#*$%&|<>"
#: A line that is a list item, a line that breaks off, a letter
#: (any character outside ASCII counts as one).
BULLET = r"^[\x20\x09-\x0D]*[-*•]"
ELLIPSIS = r"(?:\.\.\.|…)[\x20\x09-\x0D]*\z"
LETTER = r"[A-Za-z]|[^\x00-\x7F]"


@dataclass(frozen=True)
class Rule:
    name: str
    fails: Column
    work: Column


def _lines_like(pattern: str) -> Column:
    """How many lines of the text match."""
    return F.size(F.filter(F.split("text", "\n", -1), lambda x: F.regexp_like(x, F.lit(pattern))))


def production_rules() -> list[Rule]:
    """The rules in production; a text at a threshold passes."""
    n, one = F.col("n_words"), F.lit(1.0)
    visited = F.length("text").cast("double") + 1
    capitals = F.length("text") - F.length(F.regexp_replace("text", "[A-Z]", ""))
    digits = F.length("text") - F.length(F.translate("text", "0123456789", ""))
    bare = F.size(F.filter(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), lambda w: ~F.regexp_like(w, F.lit(LETTER))))
    return [
        Rule("too_short", n < 50, one),
        Rule("repeated_words", 100 * F.col("n_repeat_words") > 50 * n, one),
        Rule("symbols", 10 * F.col("n_symbols") > 3 * n, one),
        Rule("repeated_lines", 2 * F.col("n_dup_lines") > F.col("n_lines"), one),
        Rule("word_length", (F.col("word_chars") < 2 * n) | (F.col("word_chars") > 15 * n), one),
        # More than half of the characters in words are A-Z, or 0-9.
        Rule("capitals", 2 * capitals > F.col("word_chars"), visited),
        Rule("digits", 2 * digits > F.col("word_chars"), visited),
        # Lists and teasers: a pass that splits, a pass over the lines.
        Rule("bullets", 10 * _lines_like(BULLET) > 9 * F.col("n_lines"), 2 * visited),
        Rule("ellipses", 10 * _lines_like(ELLIPSIS) > 3 * F.col("n_lines"), 2 * visited),
        # More than half of the words have no letter.
        Rule("no_letters", 2 * bare > n, 2 * visited),
    ]


def measures(docs: DataFrame) -> DataFrame:
    """``docs`` with text (null as empty), n_words, word_chars, n_symbols,
    n_lines, n_dup_lines, n_repeat_words."""
    carried = [F.col(f"`{c}`") for c in docs.columns if c not in ("text", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")]
    t = docs.select(*carried, whole_text().alias("text"))
    t = t.withColumn("_w", F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).withColumn("n_words", F.size("_w").cast("bigint"))
    lines = F.filter(F.split("text", "\n", -1), lambda x: F.translate(x, _SPACE, "") != "")
    t = t.withColumn("_l", lines)
    window = F.transform(F.slice("_w", 1, F.greatest(F.col("n_words").cast("int") - 2, F.lit(0))), lambda w, i: F.xxhash64(w, F.get("_w", i + 1), F.get("_w", i + 2)))
    t = t.withColumn("_h", window)
    placed = F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    t = t.withColumn("_s", F.when(F.size(F.array_distinct("_h")) < F.size("_h"), placed))
    twice = F.filter("_s", lambda x, j: (x["h"] == F.get("_s", j - 1)["h"]) | (x["h"] == F.get("_s", j + 1)["h"]))
    t = t.withColumn("_p", F.sort_array(F.transform(twice, lambda x: x["i"])))
    # A window at x covers the words x to x+2; count those that the last one didn't.
    start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("bigint").alias("n"))
    covered = F.aggregate("_p", start, lambda a, x: F.struct(x.alias("last"), (a["n"] + F.least(F.lit(3), x - a["last"])).alias("n")), lambda a: a["n"])
    chars = F.length(F.translate("text", _SPACE, "")).cast("bigint")
    symbols = (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("bigint")
    found = F.struct("n_words", chars.alias("word_chars"), symbols.alias("n_symbols"), F.size("_l").cast("bigint").alias("n_lines"),
                     (F.size("_l") - F.size(F.array_distinct("_l"))).cast("bigint").alias("n_dup_lines"), F.coalesce(covered, F.lit(0).cast("bigint")).alias("n_repeat_words"))
    # As a generator's output: a filter on a measure then can't be pushed into the arrays above, where it would be evaluated per element.
    return t.select(*carried, "text", F.explode(F.array(found)).alias("_m")).select(*carried, "text", "_m.*")


def order_rules(docs: DataFrame, rules: list[Rule], sample_texts: int = SAMPLE_TEXTS) -> list[tuple[Rule, float, float]]:
    """(rule, rejected share, mean work), by rejection per work, estimated on
    about ``sample_texts`` rows taken by a hash of the row's id and text."""
    n = max(1, docs.count())
    place = F.pmod(F.xxhash64("doc_id", F.col("text"), F.lit("cascade")), F.lit(1 << 30))
    sample = measures(docs.where(place < int(min(1.0, sample_texts / n) * (1 << 30)))).select(
        *[F.coalesce(r.fails, F.lit(False)).cast("double").alias(f"f{k}") for k, r in enumerate(rules)], *[r.work.alias(f"w{k}") for k, r in enumerate(rules)])
    seen = sample.agg(*[F.coalesce(F.avg(f"f{k}"), F.lit(0.0)) for k in range(len(rules))], *[F.coalesce(F.avg(f"w{k}"), F.lit(1.0)) for k in range(len(rules))]).first()
    known = [(r, float(seen[k]), max(1e-9, float(seen[len(rules) + k]))) for k, r in enumerate(rules)]
    return sorted(known, key=lambda x: -x[1] / x[2])


def verdict(rules: list[Rule]) -> Column:
    """The name of the first rule that fails, in the given order; null: kept."""
    case = F.when(rules[0].fails, rules[0].name)
    for r in rules[1:]:
        case = case.when(r.fails, r.name)
    return case


def mean_work(docs: DataFrame, rules: list[Rule]) -> float:
    """The mean work per text of ``rules`` in the given order: that of each
    rule up to the first that fails (0.0 for an empty table)."""
    done, reached = F.lit(0.0), F.lit(True)
    for r in rules:
        done = done + F.when(reached, r.work).otherwise(0.0)
        reached = reached & ~F.coalesce(r.fails, F.lit(False))
    return float(measures(docs).agg(F.coalesce(F.avg(done), F.lit(0.0))).first()[0])


def apply(docs: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """``docs`` with the measures and ``failed_rule`` (null where kept)."""
    order = [r for r, _, _ in order_rules(docs, production_rules() if rules is None else rules)]
    return measures(docs).withColumn("failed_rule", verdict(order))


def judged(docs: DataFrame) -> DataFrame:
    """doc_id, the base measures, base_failed and kept per document."""
    out = apply(docs.select("doc_id", "text"))
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"),
                      (~base & F.col("failed_rule").isNull()).alias("kept"))


SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM d WHERE len(w) >= 3),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n FROM p),
r AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM g, (VALUES (0), (1), (2)) AS o(k) WHERE n >= 2 GROUP BY doc_id),
l AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
m AS (SELECT d.doc_id, text, w, lines, len(w)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
        (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
      FROM d JOIN l USING (doc_id) LEFT JOIN r USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (10 * n_symbols > 3 * n_words OR 2 * n_dup_lines > n_lines OR word_chars < 2 * n_words OR word_chars > 15 * n_words
    OR 2 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > word_chars
    OR 2 * (length(text) - length(regexp_replace(text, '[0-9]', '', 'g'))) > word_chars
    OR 10 * len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•]'))) > 9 * n_lines
    OR 10 * len(list_filter(lines, lambda x: regexp_matches(x, '(?:\.\.\.|…)[\x20\x09-\x0D]*\z'))) > 3 * n_lines
    OR 2 * len(list_filter(w, lambda x: NOT regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]'))) > n_words) AS kept
FROM b
"""
