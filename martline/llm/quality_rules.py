"""Quality rules as a short-circuit cascade (DataFrame functions only).

Method. Each rule is a cost (time to evaluate it over a sample) and a selectivity (share of the sample it
rejects). Rules run in descending order of rejections per second as one nested CASE, so a document stops at
its first failure. The order changes cost only: a document is kept if no rule rejects it.

The sample is bounded by ``sample_rows`` (documented parameter), drawn by row hash from the whole table, and
only sets the order of rules; every document is judged by every rule it reaches on its whole text.

Defined cases: NULL and empty texts have no words and fail ``few_words``; repeated rows are judged one by one;
an empty table gives an empty result and the declared order; other columns are untouched.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martline.llm.common import let, words
from martline.session import cut_lineage

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
WINDOW = 5


def removed_chars(text: Column, chars: str) -> Column:
    """Number of code points of ``text`` that are in ``chars``."""
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("bigint")


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that are equal to an earlier line."""
    with_word = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, SPACES, "")) > 0)
    return let(with_word, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint")


def repeated_words(w: Column) -> Column:
    """Words inside WINDOW-word windows found twice or more in the text, first occurrence included.

    Window hashes show in linear time that most texts have no repeat. Only a text with equal hashes has its
    windows sorted as strings, so the count is exact.
    """
    n = F.size(w)
    hashes = F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)]))

    def covered(p: Column) -> Column:
        last = F.size(p) - 1
        step = lambda acc, k: acc + F.when(k == last, F.lit(WINDOW)).otherwise(F.least(F.lit(WINDOW), F.get(p, k + 1) - F.get(p, k)))
        return F.when(F.size(p) == 0, F.lit(0)).otherwise(F.aggregate(F.sequence(F.lit(0), last), F.lit(0), step))

    def positions(s: Column) -> Column:
        same = lambda a, b: F.get(s, a)["s"] == F.get(s, b)["s"]
        dup = lambda k: F.coalesce(same(k, k - 1), F.lit(False)) | F.coalesce(same(k, k + 1), F.lit(False))
        return F.sort_array(F.transform(F.filter(F.sequence(F.lit(0), F.size(s) - 1), dup), lambda k: F.get(s, k)["i"]))

    def exact() -> Column:
        windows = F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.struct(F.array_join(F.slice(w, i + 1, WINDOW), " ").alias("s"), i.alias("i")))
        return let(let(F.sort_array(windows), positions), covered)

    repeats = let(hashes, lambda h: F.size(F.array_distinct(h)) < F.size(h))
    return F.when(n < WINDOW, F.lit(0)).when(~repeats, F.lit(0)).otherwise(exact()).cast("bigint")


@dataclass(frozen=True)
class Rule:
    """A named rejection. ``rejects`` builds its condition from the measures it names."""

    name: str
    rejects: Callable[[], Column]


def measures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Add the measures the rules read: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_upper, n_lines."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return (
        docs.withColumn("_w", words(F.col(text_col)))
        .withColumn("n_words", F.size("_w").cast("bigint"))
        .withColumn("word_chars", F.length(F.translate(text, SPACES, "")).cast("bigint"))
        .withColumn("n_symbols", removed_chars(text, SYMBOLS))
        .withColumn("n_dup_lines", duplicate_lines(text))
        .withColumn("n_repeat_words", repeated_words(F.col("_w")))
        .withColumn("n_upper", removed_chars(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
        .withColumn("n_lines", (removed_chars(text, "\n") + 1))
        .drop("_w")
    )


#: The production rules. Limits are wide: an ordinary text in any alphabetic language passes all of them.
RULES = (
    Rule("few_words", lambda: F.col("n_words") < 10),
    Rule("repeated_words", lambda: 100 * F.col("n_repeat_words") > 20 * F.col("n_words")),
    Rule("symbols", lambda: 5 * F.col("n_symbols") > F.col("n_words")),
    Rule("long_words", lambda: F.col("word_chars") > 25 * F.col("n_words")),
    Rule("duplicate_lines", lambda: 2 * F.col("n_dup_lines") > F.col("n_lines")),
    Rule("upper_case", lambda: 2 * F.col("n_upper") > F.col("word_chars")),
)


def rule_order(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text", sample_rows: int = 1000) -> list[dict]:
    """Cost and selectivity of each rule on a bounded sample, best rejection per cost first."""
    n = docs.count()
    share = min(1.0, sample_rows / n) if n else 1.0
    sample = cut_lineage(docs.select(F.col(text_col)).sample(False, share, seed=7).limit(2 * sample_rows))

    def timed(condition: Column) -> tuple[float, int, int]:
        best, row = float("inf"), None
        for _ in range(2):
            t = time.perf_counter()
            row = measures(sample, text_col).agg(F.count(F.lit(1)).alias("n"), F.count(F.when(condition, 1)).alias("r")).first()
            best = min(best, time.perf_counter() - t)
        return best, row["n"], row["r"]

    floor = timed(F.lit(False))[0]
    out = []
    for rule in rules:
        seconds, seen, rejected = timed(rule.rejects())
        cost = max(seconds - floor, 1e-4)
        out.append({"rule": rule.name, "cost": cost, "rejects": rejected / max(seen, 1), "gain": rejected / max(seen, 1) / cost})
    return sorted(out, key=lambda x: (-x["gain"], x["cost"]))


def cascade(rules: tuple[Rule, ...], order: list[dict]) -> Column:
    """The name of the first rule in ``order`` that rejects, NULL if none does."""
    by_name = {r.name: r for r in rules}
    first, *rest = [by_name[x["rule"]] for x in order]
    out = F.when(first.rejects(), F.lit(first.name))
    for r in rest:
        out = out.when(r.rejects(), F.lit(r.name))
    return out


def apply_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text") -> DataFrame:
    """``docs`` with the measures, ``failed_rule`` (first failure in cascade order) and ``kept``."""
    order = rule_order(docs, rules, text_col)
    return measures(docs, text_col).withColumn("failed_rule", cascade(rules, order)).withColumn("kept", F.col("failed_rule").isNull())


def quality_rules(docs: DataFrame) -> DataFrame:
    """The contract's rows: counts, base_failed and kept for every document."""
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    out = apply_rules(docs.select("doc_id", "text"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), (~base & F.col("kept")).alias("kept"))


ORACLE = r"""
with d as (select row_number() over () as r, doc_id, coalesce(text, '') as t from documents),
w as (select *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as w, string_split(t, chr(10)) as lines from d),
g as (select r, i, array_to_string(w[i + 1 : i + 5], ' ') as s from (select r, w, unnest(range(0, len(w) - 4)) as i from w where len(w) >= 5)),
p as (select r, i from (select r, i, count(*) over (partition by r, s) as n from g) where n > 1),
x as (select r, sum(least(5, coalesce(lead_i - i, 5)))::bigint as n from (select r, i, lead(i) over (partition by r order by i) as lead_i from p) group by r),
l as (select r, count(*) - count(distinct line) as n from (select r, unnest(lines) as line from w) where regexp_matches(line, '[^\x20\x09-\x0D]') group by r),
m as (select doc_id, len(w)::bigint as n_words, length(array_to_string(w, ''))::bigint as word_chars,
        (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
        coalesce(l.n, 0)::bigint as n_dup_lines, coalesce(x.n, 0)::bigint as n_repeat_words,
        length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) as n_upper, len(lines) as n_lines
      from w left join x using (r) left join l using (r)),
b as (select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not (base_failed or 5 * n_symbols > n_words or word_chars > 25 * n_words or 2 * n_dup_lines > n_lines or 2 * n_upper > word_chars) as kept
from b
"""
