"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Each rule is a predicate that is true where it rejects a text. `plan_cascade` runs every rule on a
bounded sample: the share it rejects is its selectivity, the seconds it takes its cost. Rules are then
ordered by rejection per cost, and `first_rejection` puts them into one CASE expression in that order,
which Spark evaluates branch by branch: a text that a cheap rule rejects never reaches a costly one.
The order decides the time, and which rule is named; never whether a document is kept.

Work is per row, without shuffle, linear in the text but for one sort of a text's repeated windows.

Defined cases: a null text has no words, fails `too_few_words` and is rejected; so is an empty one.
Repeated rows get one verdict each; an empty table gives an empty result (and the rules' listed
order). Other columns pass through `keep_good` untouched, whatever their names.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riverdeck.llm.columns import WORD, let, text_or_empty
from riverdeck.session import pinned

#: Rows the sample has, about; the only thing estimated on it is the order of the rules.
SAMPLE_ROWS = 1000
WINDOW = 8
SYMBOLS = "#*$%&|<>"


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def word_chars(text: Column) -> Column:
    return F.length(F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")).cast("bigint")


def symbol_count(text: Column) -> Column:
    return F.length(F.regexp_replace(text, rf"[^{SYMBOLS}]+", "")).cast("bigint")


def line_counts(text: Column) -> Column:
    """struct(lines with a word, those equal to an earlier one)."""
    with_words = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))
    return let(with_words, lambda lines: F.struct(
        F.size(lines).cast("bigint").alias("lines"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint").alias("repeated")))


def repeated_words(words: Column) -> Column:
    """Words that lie in a window of `WINDOW` words found twice or more. Windows are compared by a
    64-bit hash; only texts where two agree are looked at further."""
    last = F.size(words) - WINDOW

    def hashes(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), last),
                           lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)]))

    def covered(h: Column) -> Column:
        in_order = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("at"))))
        return let(in_order, lambda s: let(
            F.array_sort(F.transform(
                F.filter(s, lambda x, i: (x["h"] == F.get(s, i - 1)["h"]) | (x["h"] == F.get(s, i + 1)["h"])),
                lambda x: x["at"])),
            lambda at: F.aggregate(
                F.transform(at, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(at, i + 1) - p, F.lit(WINDOW)))),
                F.lit(0), lambda total, n: total + n)))

    return F.when(last < 0, F.lit(0)).otherwise(let(hashes(words), lambda h: F.when(
        F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)))).cast("bigint")


@dataclass(frozen=True)
class Rule:
    """`rejects(text)` is a predicate on a non-null text."""

    name: str
    rejects: object


#: `too_few_words` and `repeated_windows` are the base rules; the bounds of the others follow published
#: filters for web text and leave ordinary prose alone.
RULES = (
    Rule("too_few_words", lambda t: F.regexp_count(t, F.lit(WORD)) < 20),
    Rule("word_length", lambda t: let(F.struct(word_chars(t).alias("c"), F.regexp_count(t, F.lit(WORD)).alias("w")),
                                      lambda m: (m["w"] == 0) | ~m["c"].between(2 * m["w"], 20 * m["w"]))),
    Rule("symbols", lambda t: 10 * symbol_count(t) > 2 * F.regexp_count(t, F.lit(WORD))),
    Rule("repeated_lines", lambda t: let(line_counts(t), lambda n: (n["repeated"] >= 3) & (10 * n["repeated"] > 3 * n["lines"]))),
    Rule("repeated_windows", lambda t: let(words_of(t), lambda w: 100 * repeated_words(w) > 30 * F.size(w))),
)


def measured(text: Column) -> Column:
    """All figures of a text in one struct, its words found once."""
    return let(text, lambda t: let(words_of(t), lambda w: let(line_counts(t), lambda n: F.struct(
        F.size(w).cast("bigint").alias("n_words"), word_chars(t).alias("word_chars"),
        symbol_count(t).alias("n_symbols"), n["repeated"].alias("n_dup_lines"), n["lines"].alias("n_lines"),
        repeated_words(w).alias("n_repeat_words")))))


def base_failed(m: Column) -> Column:
    return (m["n_words"] < 20) | (100 * m["n_repeat_words"] > 30 * m["n_words"])


#: The same rules over figures that are there already.
MEASURED_RULES = (
    Rule("too_few_words", lambda m: m["n_words"] < 20),
    Rule("word_length", lambda m: (m["n_words"] == 0) | ~m["word_chars"].between(2 * m["n_words"], 20 * m["n_words"])),
    Rule("symbols", lambda m: 10 * m["n_symbols"] > 2 * m["n_words"]),
    Rule("repeated_lines", lambda m: (m["n_dup_lines"] >= 3) & (10 * m["n_dup_lines"] > 3 * m["n_lines"])),
    Rule("repeated_windows", lambda m: 100 * m["n_repeat_words"] > 30 * m["n_words"]),
)


def plan_cascade(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> list[dict]:
    """Rules with their selectivity and cost on a sample, best first: rejection per second, then as listed."""
    rows = docs.count()
    texts = docs.select(text_or_empty().alias("text"))
    sample = pinned(texts.sample(fraction=min(1.0, SAMPLE_ROWS / max(rows, 1)), seed=7), "sample")
    seen = max(sample.count(), 1)
    found = []
    for rule in rules:
        begun = time.perf_counter()
        rejected = sample.filter(rule.rejects(F.col("text"))).count()
        seconds = time.perf_counter() - begun
        found.append({"rule": rule, "selectivity": rejected / seen, "seconds": seconds,
                      "worth": rejected / seen / max(seconds, 1e-6)})
    return sorted(found, key=lambda f: -f["worth"])


def first_rejection(value: Column, rules: list[Rule]) -> Column:
    """Name of the first rule, in the given order, that rejects; null if none does."""
    chain = F.when(rules[0].rejects(value), F.lit(rules[0].name))
    for rule in rules[1:]:
        chain = chain.when(rule.rejects(value), F.lit(rule.name))
    return chain


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that no rule rejects."""
    order = [f["rule"] for f in plan_cascade(docs)]
    return docs.filter(let(text_or_empty(), lambda t: first_rejection(t, order)).isNull())


def quality_report(docs: DataFrame) -> DataFrame:
    """Per document: the figures, base_failed, the rule that rejects it first, and kept."""
    by_name = {rule.name: rule for rule in MEASURED_RULES}
    order = [by_name[f["rule"].name] for f in plan_cascade(docs)]
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    rows = docs.select("doc_id", measured(text_or_empty()).alias("m"))
    rejection = first_rejection(F.col("m"), order)
    return rows.select("doc_id", *[F.col(f"m.{c}").alias(c) for c in columns],
                       base_failed(F.col("m")).alias("base_failed"),
                       (~base_failed(F.col("m")) & rejection.isNull()).alias("kept"))


QUALITY_SQL = f"""
with worded as (
  select doc_id, coalesce(text, '') as text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as words,
         [l for l in string_split(coalesce(text, ''), chr(10)) if regexp_matches(l, '[^\\x20\\x09-\\x0D]')] as lines
  from documents),
numbered as (select *, row_number() over () as row_id, len(words) as n_words from worded),
windows as (
  select row_id, place, array_to_string(words[place:place + {WINDOW - 1}], ' ') as words
  from (select row_id, words, unnest(range(1, n_words - {WINDOW - 2})) as place from numbered where n_words >= {WINDOW})),
repeated as (select row_id, place from windows qualify count(*) over (partition by row_id, words) > 1),
covered as (
  select row_id, sum(least({WINDOW}, coalesce(following - place, {WINDOW}))) as n
  from (select *, lead(place) over (partition by row_id order by place) as following from repeated) group by row_id),
figures as (
  select doc_id, n_words, len(regexp_replace(text, '[\\x20\\x09-\\x0D]+', '', 'g')) as word_chars,
         len(regexp_replace(text, '[^{SYMBOLS}]+', '', 'g')) as n_symbols,
         len(lines) as n_lines, len(lines) - len(list_distinct(lines)) as n_dup_lines,
         coalesce(c.n, 0) as n_repeat_words
  from numbered left join covered c using (row_id)),
judged as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from figures)
select doc_id, cast(n_words as bigint) as n_words, cast(word_chars as bigint) as word_chars,
       cast(n_symbols as bigint) as n_symbols, cast(n_dup_lines as bigint) as n_dup_lines,
       cast(n_repeat_words as bigint) as n_repeat_words, base_failed,
       not base_failed and word_chars between 2 * n_words and 20 * n_words and 10 * n_symbols <= 2 * n_words
         and not (n_dup_lines >= 3 and 10 * n_dup_lines > 3 * n_lines) as kept
from judged
"""
