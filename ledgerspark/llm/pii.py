"""Personal data: patterns propose spans, checksums confirm them, context adjusts the score.

Native Spark expressions only, and no shuffle: each row's spans come from its own text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, fresh

#: Separates pieces while a text is cut at its matches. No pattern matches it; a text's own
#: U+0001 is replaced by another character that no pattern matches before the cut.
MARK, STAND_IN = "\x01", "\x02"
#: Code points before and after a span in which context words count, up to the next match of the
#: same pattern.
WINDOW = 32
#: Spans of the added kinds are reported from this score on (percent).
THRESHOLD = 60
_BLOCK = 512


@dataclass(frozen=True)
class Kind:
    """``pattern``: what proposes a span. Java possessive forms of the contract's patterns: every
    part that is made possessive is followed by a character it cannot contain, so the matches are
    the same and the time is linear. ``plain``: the same language for engines without them.
    ``sieve``: a cheap condition that holds for every text with a match."""
    name: str
    pattern: str
    plain: str
    sieve: str
    score: int
    boost: int
    words: tuple[str, ...]
    base: bool = True


# Patterns of the contract, scores and context words of each kind.
KINDS = (
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "@", 90, 10,
         ("email", "mail", "contact", "write", "correo", "courriel", "kontakt")),
    Kind("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", r"[0-9]+(?:\.[0-9]+){3}", ".", 60, 30,
         ("ip", "host", "server", "login", "address", "client")),
    Kind("card", r"[0-9](?:[ -]?[0-9])++", r"[0-9](?:[ -]?[0-9])+", "", 80, 20,
         ("card", "visa", "mastercard", "credit", "carte", "karte", "tarjeta")),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", r"\+[0-9][ ().0-9-]+[0-9]", "+", 70, 20,
         ("phone", "call", "tel", "mobile", "fax", "telefon", "llamar")),
    Kind("iban", r"(?<![A-Za-z0-9_])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9_])",
         r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b", "", 85, 15,
         ("iban", "account", "bank", "konto", "cuenta", "compte"), False),
    Kind("account", r"[0-9]++", r"[0-9]+", "", 40, 30,
         ("account", "passport", "ssn", "taxid", "konto", "cuenta", "compte", "ausweis"), False),
)


def _confirmed(kind: Kind, value: Column) -> Column:
    """The checksum or range check of a kind on the matched text."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind.name == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
        return value.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind.name == "card":
        return F.length(digits).between(13, 19) & _luhn(digits)
    if kind.name == "phone":
        return F.length(digits).between(9, 15)
    if kind.name == "iban":
        return _mod97(value)
    if kind.name == "account":
        return F.length(value).between(6, 12)
    return F.lit(True)


def _luhn(digits: Column) -> Column:
    """Digits counted from the right; every second one doubled, nines cast out; a multiple of ten."""
    places = F.split(F.reverse(digits), "")
    doubled = F.transform(places, lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        F.when(d.cast("int") > 4, d.cast("int") * 2 - 9).otherwise(d.cast("int") * 2)))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + F.coalesce(d, F.lit(0))) % 10 == 0


def _mod97(value: Column) -> Column:
    """Country and check digits to the end, letters as 10 to 35, remainder 1 modulo 97."""
    bare = F.replace(value, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(bare, 5, 34), F.substring(bare, 1, 4))
    rest = F.aggregate(F.split(turned, ""), F.lit(0).cast("long"), lambda a, c: F.when(
        c == "", a).when(c.between("0", "9"), (a * 10 + c.cast("int")) % 97).otherwise(
        (a * 100 + F.ascii(c) - 55) % 97))
    return F.length(bare).between(15, 34) & (rest == 1)


def _running(lengths: Column) -> Column:
    """Start of every piece: sums of the lengths before it. Block by block, so that appending to
    an array stays cheap however many pieces a text has."""
    def sums(part: Column, start: Column) -> Column:
        step = F.aggregate(part, F.struct(start.alias("t"), F.array().cast("array<int>").alias("s")),
                           lambda a, n: F.struct((a.t + n).alias("t"), F.concat(a.s, F.array(a.t)).alias("s")))
        return step.getField("s")

    n = F.size(lengths)
    blocks = F.sequence(F.lit(0), F.floor((n - 1) / _BLOCK).cast("int"))
    totals = F.transform(blocks, lambda b: F.aggregate(
        F.slice(lengths, b * _BLOCK + 1, _BLOCK), F.lit(0), lambda a, x: a + x))
    starts = sums(totals, F.lit(0))
    return F.flatten(F.transform(starts, lambda s, b: sums(F.slice(lengths, b * _BLOCK + 1, _BLOCK), s)))


def _spans(kind: Kind, pieces: str, starts: str, window: int) -> Column:
    """The confirmed spans of one kind: pieces at odd places are its matches, those beside them
    the text around. Null where the text has no match."""
    context = "(?:^|[^a-z])(?:" + "|".join(kind.words) + ")(?:$|[^a-z])"

    def span(i: Column) -> Column:
        value, start = F.get(pieces, i), F.get(starts, i)
        around = F.lower(F.concat(F.right(F.get(pieces, i - 1), F.lit(window)), F.lit(" "),
                                  F.left(F.get(pieces, i + 1), F.lit(window))))
        score = F.least(F.lit(100), F.lit(kind.score) + F.when(around.rlike(context), kind.boost).otherwise(0))
        return F.struct(F.lit(kind.name).alias("kind"), start.alias("start"), (start + F.length(value)).alias("end"),
                        value.alias("value"), score.alias("score"))

    odd = F.when(F.size(pieces) > 1, F.sequence(F.lit(1), F.size(pieces) - 2, F.lit(2)))
    return F.transform(F.filter(odd, lambda i: _confirmed(kind, F.get(pieces, i))), span)


def find_pii(docs: DataFrame, text: str = "text", window: int = WINDOW, threshold: int = THRESHOLD) -> DataFrame:
    """Add ``pii``: an array of (kind, start, end, value, score) per row, ordered by kind as in
    ``KINDS``, then start. Positions are code points, end exclusive.

    Base kinds keep every confirmed span; added kinds need ``score >= threshold``. Null and empty
    texts have no spans; repeated rows are each answered alike; other columns pass through, and a
    column of the input named ``pii`` is replaced.
    """
    clean, out = fresh(docs, "clean"), docs
    out = out.withColumn(clean, F.translate(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")), MARK, STAND_IN))
    found, helpers = [], [clean]
    for kind in KINDS:
        pieces, starts, hits = (fresh(docs, f"{kind.name}_{x}") for x in ("pieces", "starts", "hits"))
        sieve = F.contains(clean, F.lit(kind.sieve)) if kind.sieve else F.col(clean).rlike("[0-9]")
        cut = F.split(F.regexp_replace(clean, F.lit(kind.pattern), F.lit(f"{MARK}$0{MARK}")), MARK)
        out = out.withColumn(pieces, F.when(sieve, cut).otherwise(F.array(F.lit(""))))
        out = out.withColumn(starts, F.when(F.size(pieces) > 1, _running(F.transform(F.col(pieces), F.length)))
                             .otherwise(F.array(F.lit(0))))
        spans = _spans(kind, pieces, starts, window)
        if not kind.base:
            spans = F.filter(spans, lambda x: x.score >= threshold)
        empty = F.array().cast("array<struct<kind:string,start:int,end:int,value:string,score:int>>")
        out = out.withColumn(hits, F.coalesce(spans, empty))
        found.append(hits)
        helpers += [pieces, starts, hits]
    return out.withColumn("pii", F.concat(*found)).drop(*helpers)


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x.kind, x.start.cast("string"), x.end.cast("string"))), ",")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op1: spans of every whole text of ``documents``, counts and digest of the base kinds."""
    pii = find_pii(documents(spark, sf_dir).select("doc_id", "text"))
    base = [k.name for k in KINDS if k.base]
    count = lambda name: F.size(F.filter("pii", lambda x: x.kind == name)).cast("long").alias(f"n_{name}")
    kept = F.filter("pii", lambda x: x.kind.isin(*base))
    return pii.select("doc_id", *[count(n) for n in base],
                      F.sha2(F.encode(_listed(kept), "UTF-8"), 256).alias("base_sha256"), _listed(F.col("pii")).alias("spans"),
                      F.array_join(F.transform("pii", lambda x: x.score.cast("string")), ",").alias("scores"))


def oracle_sql() -> str:
    """The same in DuckDB: split and extract by the plain patterns, positions by running sums."""
    parts = []
    for rank, k in enumerate(KINDS):
        digits = "regexp_replace(value, '[^0-9]', '', 'g')"
        ok = {"email": "true",
              "ip": "list_bool_and([try_cast(x as hugeint) <= 255 for x in string_split(value, '.')])",
              "card": f"length({digits}) between 13 and 19 and list_sum([case when (length({digits}) - i) % 2 = 0 then cast({digits}[i] as int) "
                      f"else (2 * cast({digits}[i] as int)) // 10 + (2 * cast({digits}[i] as int)) % 10 end for i in range(1, length({digits}) + 1)]) % 10 = 0",
              "phone": f"length({digits}) between 9 and 15",
              "iban": "length(replace(value, ' ', '')) between 15 and 34 and list_reduce(list_prepend(0::bigint, flatten([[cast(d as bigint) for d in "
                      "string_split(case when c between '0' and '9' then c else cast(ascii(c) - 55 as varchar) end, '')] for c in string_split("
                      "substr(replace(value, ' ', ''), 5) || substr(replace(value, ' ', ''), 1, 4), '')])), lambda a, b: (a * 10 + b) % 97) = 1",
              "account": "length(value) between 6 and 12"}[k.name]
        context = "(?:^|[^a-z])(?:" + "|".join(k.words) + ")(?:$|[^a-z])"
        parts.append(f"""select * from (select doc_id, row_id, {rank} as rank, '{k.name}' as kind, i,
            m[i] as value, length(array_to_string(g[1:i], '')) + coalesce(length(array_to_string(m[1:i-1], '')), 0) as start,
            least(100, {k.score} + case when regexp_matches(lower(right(g[i], {WINDOW}) || ' ' || left(g[i+1], {WINDOW})), '{context}')
              then {k.boost} else 0 end) as score
          from (select doc_id, row_id, regexp_extract_all(t, '{k.plain}') as m, string_split_regex(t, '{k.plain}') as g from d) x,
               unnest(range(1, length(m) + 1)) as u(i)) y
        where {ok}{'' if k.base else f' and score >= {THRESHOLD}'}""")
    spans = " union all ".join(parts)
    n_base = sum(k.base for k in KINDS)
    counts = ", ".join(f"count(*) filter (kind = '{k.name}') as n_{k.name}" for k in KINDS if k.base)
    one = "kind || ':' || start || ':' || (start + length(value))"
    return f"""with d as (select doc_id, row_number() over () as row_id, coalesce(text, '') as t from documents),
      s as ({spans}),
      a as (select row_id, {counts}, coalesce(string_agg({one}, ',' order by rank, start) filter (rank < {n_base}), '') as base,
              string_agg({one}, ',' order by rank, start) as spans, string_agg(score, ',' order by rank, start) as scores
            from s group by row_id)
      select d.doc_id, {', '.join(f'coalesce(n_{k.name}, 0) as n_{k.name}' for k in KINDS if k.base)},
        sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans, coalesce(scores, '') as scores
      from d left join a using (row_id)"""
