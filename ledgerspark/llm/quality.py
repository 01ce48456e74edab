"""Quality rules as a short-circuit cascade: a sample tells what each rule costs and how much it
rejects, and the rules then run in order of rejections per cost.

Native Spark expressions only; counting needs no shuffle.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE, documents, durable, fresh

#: Rows of the sample that orders the rules; the order changes speed only, never a verdict.
SAMPLE_ROWS = 1_000


@dataclass(frozen=True)
class Rule:
    """A text fails when ``failed`` holds: SQL over the base counts and the ``text``."""
    name: str
    failed: str


# The method's rules beside the base ones.
RULES = (
    Rule("word_length", "word_chars < 2 * n_words or word_chars > 16 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("duplicate_lines", "10 * n_dup_lines > 3 * size(split({text}, '\\n'))"),
    Rule("capitals", "5 * length(regexp_replace({text}, '[^A-ZÀ-ÖØ-Þ]', '')) > 2 * word_chars"),
    Rule("exclamations", "5 * (length({text}) - length(replace({text}, '!', ''))) > n_words"),
    Rule("letters", "10 * length(regexp_replace({text}, '[^\\\\p{{L}}]', '')) < 6 * word_chars"),
)


def base_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long). Null and empty
    texts count zero. Columns of the input with these names are replaced."""
    t, words, grams, order = (fresh(docs, x) for x in ("t", "words", "grams", "order"))
    out = docs.withColumn(t, F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(f"[^{SPACE}]"))
    # The words of a text, split at runs of separators after the outer ones are cut off.
    cut = F.regexp_replace(t, f"^[{SPACE}]++", "")
    out = (out.withColumn(words, F.filter(F.split(cut, f"[{SPACE}]++"), lambda w: w != ""))
           .withColumn("n_words", F.size(words).cast("long"))
           .withColumn("word_chars", F.length(F.regexp_replace(t, f"[{SPACE}]++", "")).cast("long"))
           .withColumn("n_symbols", F.length(F.regexp_replace(t, r"[^#*$%&|<>]++", "")).cast("long")))
    out = out.withColumn("n_dup_lines", F.aggregate(
        F.array(lines), F.lit(0), lambda a, x: F.size(x) - F.size(F.array_distinct(x))).cast("long"))
    # Windows sorted by content put equal ones side by side; the positions they cover are united.
    window = lambda i: F.concat_ws(" ", F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))
    out = out.withColumn(grams, F.when(F.size(words) > 2, F.transform(
        F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.struct(window(i).alias("g"), i.alias("i")))))
    out = out.withColumn(order, F.sort_array(F.col(grams)))
    same = lambda x, j: F.get(F.col(order), j).getField("g") == x.g
    twice = F.filter(F.col(order), lambda x, i: F.coalesce(same(x, i - 1), F.lit(False)) | F.coalesce(same(x, i + 1), F.lit(False)))
    covered = F.array_distinct(F.flatten(F.transform(twice, lambda x: F.array(x.i, x.i + 1, x.i + 2))))
    out = out.withColumn("n_repeat_words", F.coalesce(F.size(covered), F.lit(0)).cast("long"))
    out = out.withColumn("n_repeat_words", F.greatest(F.col("n_repeat_words"), F.lit(0).cast("long")))
    return out.drop(t, words, grams, order)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _sql(rule: Rule, text: str) -> Column:
    return F.expr(rule.failed.format(text=f"coalesce(`{text}`, '')"))


def cascade_order(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES,
                  sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules by rejections per second on a random sample of about ``sample_rows`` rows. An
    empty table keeps the given order."""
    n = docs.count()
    if not n:
        return list(rules)
    sample = durable(base_counts(docs.sample(min(1.0, sample_rows / n), seed=7).select(text), text), "quality-sample")
    gain = {}
    for r in rules:
        measure = sample.agg(F.count_if(_sql(r, text)).alias("bad"), F.count(F.lit(1)).alias("n"))
        began = time.perf_counter()
        row = measure.first()
        gain[r.name] = (row["bad"] / max(1, row["n"])) / (time.perf_counter() - began)
    return sorted(rules, key=lambda r: (-gain[r.name], r.name))


def quality(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Add the base counts, ``base_failed`` and ``kept``. A row is kept if no base rule and no
    rule of the cascade fails; a later rule is evaluated only where the earlier ones passed."""
    verdict = F.when(base_failed(), False)
    for r in cascade_order(docs, text, rules):
        verdict = verdict.when(_sql(r, text), False)
    return (base_counts(docs, text).withColumn("base_failed", base_failed())
            .withColumn("kept", verdict.otherwise(True)))


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9: base counts and verdict of every whole text of ``documents``."""
    return quality(documents(spark, sf_dir).select("doc_id", "text")).select("doc_id", *COUNTS, "base_failed", "kept")


def oracle_sql() -> str:
    space = r"[ \t\n\x0B\f\r]"
    return rf"""with d as (select row_number() over () as r, doc_id, coalesce(text, '') as t from documents),
      w as (select r, i, words[i] as word, words[i] || ' ' || words[i+1] || ' ' || words[i+2] as g
            from (select r, list_filter(string_split_regex(t, '{space}+'), lambda x: x <> '') as words from d) x,
                 unnest(range(1, length(words) + 1)) as u(i)),
      g as (select r, i, g is not null and count(*) over (partition by r, g) > 1 as twice from w),
      v as (select r, i, twice or coalesce(lag(twice) over p, false) or coalesce(lag(twice, 2) over p, false) as hit
            from g window p as (partition by r order by i)),
      n as (select r, count(*) as n_words, count(*) filter (hit) as n_repeat_words from v group by r),
      l as (select d.r, count(*) - count(distinct line) as n_dup_lines from d, unnest(string_split(t, chr(10))) as u(line)
            where regexp_matches(line, '[^ \t\n\x0B\f\r]') group by d.r),
      b as (select doc_id, t, coalesce(n_words, 0) as n_words, length(regexp_replace(t, '{space}', '', 'g')) as word_chars,
              length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as n_symbols, coalesce(n_dup_lines, 0) as n_dup_lines,
              coalesce(n_repeat_words, 0) as n_repeat_words
            from d left join n using (r) left join l using (r)),
      f as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from b)
      select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
        not (base_failed or word_chars < 2 * n_words or word_chars > 16 * n_words or 10 * n_symbols > n_words
          or 10 * n_dup_lines > 3 * length(string_split(t, chr(10)))
          or 5 * length(regexp_replace(t, '[^A-ZÀ-ÖØ-Þ]', '', 'g')) > 2 * word_chars
          or 5 * (length(t) - length(replace(t, '!', ''))) > n_words
          or 10 * length(regexp_replace(t, '[^\pL]', '', 'g')) < 6 * word_chars) as kept
      from f"""
