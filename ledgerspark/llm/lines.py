"""Line deduplication by a deletion-neighbourhood join, in native Spark expressions.

A line is its words. It goes if an earlier line of the corpus has the same words, or differs in
one word (replaced, left out or added) and the longer of the two has ``MIN_WORDS`` words or more.
Earlier: smaller doc_id (null ids last), or the same document and a smaller line number. Lines are
judged on the input, not on what is left of it, so no order of work changes the answer.

Both lines of such a pair keep their first or their last half unchanged. Lines that share a half
with no other line are done after one grouped pass over hashes. The others emit every variant
within the edit bound as a hashed key: each word deleted, and each gap where the other line may
have one word more. Lines that meet in a variant are within one edit. A group only passes on its
earliest line, so its size never matters, and the words of both are compared before a line goes.

``dedup_lines`` also takes lines that differ in up to a tenth of the longer one's words, from 20
words on (``wide``; op6 leaves it out, its SQL has one word). An edit touches ``SEED`` runs of as many
words at most. So of any order of all runs, such as that of their hashes, the first few distinct runs
of two such lines have some in common: of ``SEED`` for each edit and ``SHARED`` more, ``SHARED``. Lines
that share fewer of them with all others are done after one grouped pass over these. The others emit every run of ``GRAM``
words; two such lines share ``SHARED`` (fewer if their lengths leave fewer whole) among the rarest of
both, agree in all but a tenth of their different words, and their word edit distance is computed. A line
is compared with the earliest of each meeting first, and only what is left with every earlier one; lines
of a crowd that holds one passage by their rarest words, one more than edits: an edit touches one word, but
``GRAM`` runs, so words of its own set a line apart from the crowd soonest there.

Long texts: a line is one value, whatever its length, and its hashes are arrays of as many numbers as
it has words; nothing else grows with a text.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE, documents, durable, fresh, passing, ranked

#: Words that the longer of two lines needs for an edit: five words keep four fifths alike.
MIN_WORDS = 5
#: One word in so many may differ under ``wide``.
TENTH = 10
#: Words of a run: of those that tell whether a line can have a partner, and of those that find it.
SEED, GRAM = 4, 6
#: First runs that a line must share with others to go on, and parts in which they are dealt.
SHARED, ROUNDS = 5, 2
#: A run that more lines hold is a crowd's: its lines are told apart by short runs (single words), of which
#: an edit touches fewest, so that a passage they share does not bring together lines that differ elsewhere.
CROWD, SHORT = 64, 1
_BLOCK = 256


_BLANKS = " \t\n\x0b\f\r"


def _words(line: Column) -> Column:
    """The words of a line that has one."""
    return F.split(F.btrim(line, F.lit(_BLANKS)), f"[{SPACE}]++")


def _half(n: Column) -> Column:
    """The length of the half that lines of ``n`` words compare: the largest of 1, 2, 3, 4, 6, 8,
    12, 16, ... up to n / 2. Neighbouring lengths mostly share it."""
    q = F.floor(n / 2).cast("int")
    power = F.pow(F.lit(2), F.length(F.bin(q)) - 1).cast("int")
    wide = power + F.floor(power / 2).cast("int")
    return F.when((power > 1) & (wide <= q), wide).otherwise(power)


def _edits(n: Column) -> Column:
    """The most edits under ``wide``: those of a partner that is the longer line."""
    return F.floor(n / (TENTH - 1)).cast("int")


def _once(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value computed once: as the one element of an array, it is not pasted
    into every place that refers to it, loops included."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _runs(size: int) -> Column:
    """The hashes of every run of ``size`` of ``n`` words."""
    def runs(h: Column) -> Column:
        run = lambda x, i: F.xxhash64(x, *[F.get(h, i + j) for j in range(1, size)])
        return F.transform(F.slice(h, F.lit(1), F.greatest(F.col("n") - size + 1, F.lit(0))), run)

    return _once(F.transform("words", lambda w: F.xxhash64(w)), runs)


def _cut(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    """(id, th, line, words, n): every line with a word."""
    whole = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    # The text's hash and lines come first, so that no line carries the whole text.
    return (docs.select(F.col(f"`{id_column}`").alias("id"), F.xxhash64(whole).alias("th"), F.split(whole, "\n").alias("all"))
           .select("id", "th", F.posexplode("all").alias("line", "raw"))
           .filter(F.col("raw").rlike(f"[^{SPACE}]")).withColumn("words", _words(F.col("raw"))).withColumn("n", F.size("words")))


def _identity() -> list[Column]:
    """a and b, which together identify the words of a line."""
    return [F.xxhash64("words").alias("a"), F.shiftright(F.xxhash64(F.lit(17), "words"), 32).cast("int").alias("b")]


def _lines(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    """(id, th, line, n, a, b, halves): every line with a word; halves are the keys of its first and
    last half."""
    cut = _cut(docs, id_column, text).withColumn("h", F.when(F.col("n") >= MIN_WORDS - 1, _half(F.col("n")))).withColumn(
        "g", F.when(F.col("n") >= MIN_WORDS, _half(F.col("n") - 1)))
    key = lambda h: [F.xxhash64(F.lit(0), h, F.slice("words", F.lit(1), h)),
                     F.xxhash64(F.lit(1), h, F.slice("words", F.col("n") - h + 1, h))]
    halves = (F.when(F.col("h").isNull(), F.array().cast("array<long>"))
              .when(F.col("g").isNull() | (F.col("g") == F.col("h")), F.array(*key(F.col("h"))))
              .otherwise(F.array(*key(F.col("h")), *key(F.col("g")))))
    return cut.select("id", "th", "line", "n", *_identity(), halves.alias("halves"))


def _place() -> Column:
    """Where a line stands: its fields compare in the order of the corpus."""
    return F.struct(F.col("id").isNull().alias("last"), "id", "th", "line")


def _chain(words: Column) -> Column:
    """Hashes of the first 0, 1, ..., n words, block by block so that long lines stay cheap."""
    def steps(part: Column, start: Column) -> Column:
        run = F.aggregate(part, F.struct(start.alias("h"), F.array().cast("array<long>").alias("s")),
                          lambda x, w: F.struct(F.xxhash64(x.h, w).alias("h"), F.concat(x.s, F.array(F.xxhash64(x.h, w))).alias("s")))
        return run.getField("s")

    blocks = F.sequence(F.lit(0), F.floor((F.size(words) - 1) / _BLOCK).cast("int"))
    part = lambda k: F.slice(words, k * _BLOCK + 1, _BLOCK)
    ends = F.aggregate(blocks, F.array(F.lit(0).cast("long")),
                       lambda x, k: F.concat(x, F.array(F.aggregate(part(k), F.element_at(x, -1), lambda h, w: F.xxhash64(h, w)))))
    return F.concat(F.array(F.lit(0).cast("long")), F.flatten(F.transform(blocks, lambda k: steps(part(k), F.get(ends, k)))))


def _candidates(lines: DataFrame) -> DataFrame:
    """(a, b, at, ahead, behind) of the lines that share a half with another line: first place, and
    the shortest shared first and last half (null if it shares none). An edit lies behind a shared
    first half and before a shared last one."""
    keyed = lines.select("id", "th", "line", "n", "a", "b", F.posexplode("halves").alias("k", "key"))
    shared = keyed.groupBy("key").agg(F.min("a").alias("x"), F.max("a").alias("y")).filter("x <> y").select("key")
    n = F.col("n")
    h = F.when(F.col("k") < 2, _half(n)).otherwise(_half(n - 1))
    found = keyed.join(shared, "key", "left_semi").select("id", "th", "line", "a", "b", "k", h.alias("h"))
    return found.groupBy("a", "b").agg(F.min(_place()).alias("at"), F.min(F.when(F.col("k") % 2 == 0, F.col("h"))).alias("ahead"),
                                       F.min(F.when(F.col("k") % 2 == 1, F.col("h"))).alias("behind"))


def _with_words(firsts: DataFrame, docs: DataFrame, id_column: str, text: str, columns: list[str]) -> DataFrame:
    """``columns`` (``at`` among them) and the words of lines, from the documents that hold their
    first places; of several equal documents, one. The texts travel once, dealt by one key."""
    key = lambda i, t: F.xxhash64(i, t).alias("key")
    wanted = (firsts.groupBy(F.col("at.id").alias("__id"), F.col("at.th").alias("__th"))
              .agg(F.collect_list(F.struct(*columns)).alias("want")))
    wanted = wanted.select(key("__id", "__th"), "__id", "__th", "want")
    whole = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    source = docs.select(F.col(f"`{id_column}`").alias("id"), F.xxhash64(whole).alias("th"), whole.alias("text"))
    found = source.select(key("id", "th"), "id", "th", "text").join(wanted, "key")
    found = found.filter(F.col("id").eqNullSafe(F.col("__id")) & (F.col("th") == F.col("__th"))).dropDuplicates(["key", "id", "th"])
    found = found.select("want", F.split("text", "\n").alias("raw"))
    picked = F.transform("want", lambda w: F.struct(*[w[c].alias(c) for c in columns], F.get("raw", w["at"]["line"]).alias("raw")))
    return found.select(F.explode(picked).alias("w")).select("w.*").select(*columns, _words(F.col("raw")).alias("words"))


def _within(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """k of the (k, f) whose words differ in a tenth of the longer line's number at most. A line that
    has more words of its own than that is told by its set of word hashes. For the others words
    become characters, numbered within the pair, so that the distance counts words; it is computed
    within a band of the bound."""
    def joined(pairs: DataFrame, columns: list[str]) -> DataFrame:
        mine = found.select(F.col("k").alias("__k"), *columns)
        other = found.select(F.col("k").alias("__f"), *[F.col(c).alias(f"f{c}") for c in columns])
        return pairs.join(mine, F.col("k") == F.col("__k")).join(other, F.col("f") == F.col("__f")).drop("__k", "__f")

    bound = F.floor(F.greatest("n", "fn") / TENTH).cast("int")
    alike = joined(pairs, ["n", "bag"]).withColumn("bound", bound).filter(
        (F.size(F.array_except("bag", "fbag")) <= F.col("bound")) & (F.size(F.array_except("fbag", "bag")) <= F.col("bound")))
    alike = durable(alike.select("k", "f", "bound"), "lines-alike")

    def letter(every: Column) -> Callable[[Column], Column]:
        at = lambda w: F.array_position(every, w) + 255
        return lambda w: F.decode(F.unhex(F.lpad(F.hex(F.when(at(w) < 0xD800, at(w)).otherwise(at(w) + 0x800)), 8, "0")), "UTF-32")

    every = F.array_distinct(F.concat("words", "fwords"))
    spelt = _once(every, lambda x: F.struct(*[F.array_join(F.transform(c, letter(x)), "").alias(c) for c in ("words", "fwords")]))
    distance = _once(spelt, lambda z: F.call_function("levenshtein", z["words"], z["fwords"], F.col("bound")))
    return joined(alike, ["words"]).select("k", distance.alias("d")).filter("d >= 0").select("k").distinct()


def _with_partner(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    """a of the lines that share ``SHARED`` of their first runs with other lines. A line with too few
    distinct runs to tell (it repeats itself) stays. First runs: the first ``SEED`` distinct runs for
    each edit and ``SHARED`` more, in the order of their hashes. They are dealt by run, ``ROUNDS`` of them one after the other so that
    only a part lies on disk at a time; the count of a run's lines and the lines themselves are read
    from one exchange."""
    long = _cut(docs, id_column, text).filter(_edits(F.col("n")) > 1)
    wanted = _edits(F.col("n")) * SEED + SHARED
    ordered = long.select("n", _identity()[0], F.sort_array(F.array_distinct(_runs(SEED))).alias("runs"))
    firsts = ordered.select("a", F.slice("runs", F.lit(1), wanted).alias("runs"), (F.size("runs") < wanted).alias("few"))
    found = []
    for k in range(ROUNDS):
        with passing(docs.sparkSession):
            mine = F.filter("runs", lambda t: F.pmod(t, F.lit(ROUNDS)) == k)  # noqa: B023
            keys = firsts.select("a", F.explode(mine).alias("t"), "few").repartition("t")
            shared = keys.groupBy("t").agg(F.min("a").alias("x"), F.max("a").alias("y"), F.max("few").alias("any")).filter("x < y or any")
            some = keys.join(shared.select(F.col("t").alias("__t"), (F.col("x") < F.col("y")).alias("met")), F.col("t") == F.col("__t"))
            per = some.filter("met or few").groupBy("a").agg(F.count_if("met").alias("c"), F.max("few").alias("few"))
            found.append(durable(per, "lines-partner-counts", keep=True))
            del keys, shared, some, per  # (their exchange goes with them)
    every = reduce(DataFrame.union, found).groupBy("a").agg(F.sum("c").alias("c"), F.max("few").alias("few"))
    return durable(every.filter((F.col("c") >= SHARED) | F.col("few")).select("a"), "lines-with-partner", keep=True)


def _least(size: int) -> int:
    """How many of their rarest runs of ``size`` words two lines must share. In a crowd one: each more
    makes every line of it hand out one of the crowd's own runs more, and a pair meets in all of them."""
    return 1 if size == SHORT else SHARED


def _rare_runs(found: DataFrame, size: int) -> DataFrame:
    """(k, n, t, c): of each line's runs of ``size`` words that another line shares, those among its
    rarest; c: how often the run occurs. A line and its partner share ``_least`` of their rarest
    size * edits + ``_least`` runs, or all that their lengths leave whole; those a line shares with none
    come first. Runs are counted where their line is, then across lines in ``ROUNDS`` parts."""
    spark, n = found.sparkSession, F.col("n")
    with passing(spark):
        # A run that a line holds again counts as another.
        runs = found.select("k", "n", "words").repartition("k").select("k", "n", F.explode(_runs(size)).alias("r")).groupBy("k", "n", "r").agg(F.count(F.lit(1)).alias("c"))
        runs = runs.select("k", "n", "r", F.explode(F.sequence(F.lit(1), F.col("c").cast("int"))).alias("i")).select("k", "n", F.xxhash64("r", "i").alias("t"))
        runs = durable(runs, "lines-runs", keep=True)
    parts = []
    for part in range(ROUNDS):
        with passing(spark):
            mine = runs.filter(F.pmod("t", F.lit(ROUNDS)) == part)
            shared = mine.groupBy("t").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select(F.col("t").alias("__t"), "c")
            parts.append(durable(mine.join(shared, F.col("t") == F.col("__t")).select("k", "n", "t", "c"), "lines-shared-runs", keep=True))
            del mine, shared  # (their exchanges go with them)
    per = reduce(DataFrame.union, parts).groupBy("k", "n").agg(F.sort_array(F.collect_list(F.struct("c", "t"))).alias("r"))
    rarest = _edits(n) * size + _least(size) - (n - size + 1 - F.size("r"))
    return durable(per.filter(rarest > 0).select("k", "n", F.explode(F.slice("r", F.lit(1), rarest)).alias("r")).select("k", "n", "r.t", "r.c"), "lines-keys", keep=True)


def _wide(lines: DataFrame, docs: DataFrame, id_column: str, text: str) -> DataFrame:
    """(a, b) of the lines that differ from an earlier one in up to a tenth of the longer one's
    words, two words or more. The tables and exchanges of each step go before the next begins."""
    spark, n = docs.sparkSession, F.col("n")
    with passing(spark):
        partner = _with_partner(docs, id_column, text)
    with passing(spark):
        firsts = lines.filter(_edits(n) > 1).join(partner, "a", "left_semi").groupBy("a", "b", "n").agg(F.min(_place()).alias("at"))
        firsts = ranked(firsts.select("a", "b", "n", "at.*"), ["last", "id", "th", "line"], "k").withColumn("at", F.struct("id", "th", "line"))
        found = _with_words(firsts, docs, id_column, text, ["k", "a", "b", "n", "at"])
        found = found.select("k", "a", "b", "n", "words", F.array_distinct(F.transform("words", lambda w: F.xxhash64(w))).alias("bag"))
        found = durable(found, "lines-long", keep=True)
    with passing(spark):
        keys = _rare_runs(found, GRAM)
    longer = F.greatest("n", "m")

    def meetings(mine: DataFrame, theirs: DataFrame, size: int) -> DataFrame:
        whole = F.least(F.lit(_least(size)), longer - size + 1 - size * F.floor(longer / TENTH))
        met = mine.join(theirs, F.col("t") == F.col("__t")).filter((F.col("k") > F.col("f")) & (F.abs(n - F.col("m")) <= F.floor(longer / TENTH)))
        return met.groupBy("k", "f").agg(F.count(F.lit(1)).alias("c"), F.first("n").alias("n"), F.first("m").alias("m")).filter(F.col("c") >= whole).select("k", "f")

    def rest(keys: DataFrame, near: DataFrame, size: int) -> DataFrame:
        left = keys.join(near, "k", "left_anti")
        earlier = keys.select(F.col("t").alias("__t"), F.col("k").alias("f"), F.col("n").alias("m"))
        return durable(_within(meetings(left.select("k", "n", "t"), earlier, size), found), "lines-wide-rest")

    first = keys.groupBy(F.col("t").alias("__t")).agg(F.min(F.struct(F.col("k").alias("f"), F.col("n").alias("m"))).alias("z")).select("__t", "z.*")
    near = durable(_within(meetings(keys.select("k", "n", "t"), first, GRAM), found), "lines-wide-first")
    # Two lines that share a run of a crowd both hold one, and meet in short runs; all others share rare runs only.
    crowd = keys.filter(F.col("c") > CROWD).select("k").distinct()
    near = near.union(rest(keys.filter(F.col("c") <= CROWD), near, GRAM))
    with passing(spark):
        short = _rare_runs(found.join(crowd, "k", "left_semi"), SHORT)
    near = near.union(rest(short, near, SHORT))
    return found.join(near, "k", "left_semi").select("a", "b")


def _near(lines: DataFrame, docs: DataFrame, id_column: str, text: str) -> DataFrame:
    """(a, b) of the lines that differ in one word from a line before their own first place."""
    firsts = durable(_candidates(lines), "lines-candidates")
    found = _with_words(firsts, docs, id_column, text, ["a", "b", "at", "ahead", "behind"])
    # Numbered in the order of their places: one number stands for a line and for its place.
    found = ranked(found.select("*", "at.*").drop("at"), ["last", "id", "th", "line"], "k").select("k", "a", "b", "ahead", "behind", "words")
    # (dealt anew first: the numbered table has parts of many rows, and these hashes are the work)
    found = found.repartition("k")
    ready = (found.select("k", "ahead", "behind", "words", _chain(F.col("words")).alias("p"), F.reverse("words").alias("turned"))
             .select("k", "ahead", "behind", F.size("words").alias("n"), "p", F.reverse(_chain(F.col("turned"))).alias("s")))
    # Variants at the places where an edit can lie: a gap before word i, or word i left out.
    n = F.col("n")
    low = F.when(F.col("behind").isNotNull(), F.lit(0)).otherwise(F.col("ahead"))
    high = F.when(F.col("ahead").isNotNull(), n).otherwise(n - F.col("behind"))
    span = high - low + 1
    cut = F.arrays_zip(F.slice("p", low + 1, span).alias("p"), F.slice("s", low + 1, span).alias("s"), F.slice("s", low + 2, span).alias("t"))
    places = ready.select("k", "n", low.alias("low"), F.posexplode(cut).alias("j", "z")).withColumn("i", F.col("j") + F.col("low"))
    gap = F.struct(F.lit(0).alias("skip"), F.xxhash64("n", "i", "z.p", "z.s").alias("v"))
    left_out = F.struct(F.lit(1).alias("skip"), F.when(F.col("z.t").isNotNull() & (n >= MIN_WORDS), F.xxhash64(n - 1, "i", "z.p", "z.t")).alias("v"))
    variants = places.select("k", "i", F.inline(F.array(gap, left_out))).filter("v is not null")
    variants = durable(variants.select("k", "i", "skip", "v"), "lines-variants")
    first = variants.groupBy("v").agg(F.min("k").alias("f"), F.max("k").alias("l")).filter("f < l").select(F.col("v").alias("__v"), "f")
    met = variants.join(first, F.col("v") == F.col("__v")).filter("k > f").select("k", "i", "skip", "f")
    # Verify on the words themselves: equal before the place and after what is left out.
    mine = found.select(F.col("k").alias("__k"), "a", "b", "words")
    other = found.select(F.col("k").alias("__f"), F.col("words").alias("fwords"))
    both = met.join(mine, F.col("k") == F.col("__k")).join(other, F.col("f") == F.col("__f"))
    both = both.withColumn("fskip", F.size("fwords") - F.size("words") + F.col("skip")).filter("fskip in (0, 1)")
    head = lambda w: F.slice(w, F.lit(1), F.col("i"))
    tail = lambda w, skip: F.slice(w, F.col("i") + F.col(skip) + 1, F.size(w))
    same = (head("words") == head("fwords")) & (tail("words", "skip") == tail("fwords", "fskip"))
    return both.filter(same).select("a", "b").distinct()


def judged_lines(docs: DataFrame, id_column: str = "doc_id", text: str = "text", wide: bool = False) -> DataFrame:
    """(id, th, line, removed) of every line with a word; th is a hash of the whole text. Rows with
    equal id and text are one document listed several times: each copy is judged alike."""
    lines = durable(_lines(docs, id_column, text), "lines")
    spark = docs.sparkSession
    with passing(spark):
        near = durable(_near(lines, docs, id_column, text), "lines-near", keep=True)
    if wide:
        with passing(spark):
            near = durable(near.union(_wide(lines, docs, id_column, text)).distinct(), "lines-near", keep=True)
    near = near.withColumn("near", F.lit(True))
    again = lines.groupBy("a", "b").agg(F.min(_place()).alias("first"), F.max(_place()).alias("final")).filter(
        F.col("first") < F.col("final")).select("a", "b", "first")
    bad = again.join(near, ["a", "b"], "full").select(F.col("a").alias("__a"), F.col("b").alias("__b"), "first",
                                                      F.coalesce("near", F.lit(False)).alias("near"))
    joined = lines.join(bad, (F.col("a") == F.col("__a")) & (F.col("b") == F.col("__b")), "left")
    gone = F.coalesce(F.col("near"), F.lit(False)) | F.coalesce(_place() > F.col("first"), F.lit(False))
    return joined.select("id", "th", "line", gone.alias("removed"))


def removals(docs: DataFrame, id_column: str = "doc_id", text: str = "text", wide: bool = False) -> DataFrame:
    """(id, th, n_lines, gone) of every text with a line that has a word; gone: line numbers."""
    per = judged_lines(docs, id_column, text, wide).groupBy("id", "th").agg(
        F.max("line").alias("m"), F.collect_set(F.when(F.col("removed"), F.col("line"))).alias("gone"),
        F.count_distinct("line").alias("n_lines"))
    return per.select("id", "th", "n_lines", F.sort_array("gone").alias("gone"))


def dedup_lines(docs: DataFrame, id_column: str = "doc_id", text: str = "text", drop_emptied: bool = True, wide: bool = True) -> DataFrame:
    """The input with its removed lines cut out of ``text`` (and ``n_chars`` counted anew where
    there is such a column). Lines without a word stay. A text that loses its last line with a word
    goes with its row, unless ``drop_emptied`` is false; null, empty and blank texts stay as they are."""
    hashed, id_, th, n, gone = (fresh(docs, x) for x in ("hashed", "id", "th", "n", "gone"))
    whole = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    found = removals(docs, id_column, text, wide).filter(F.size("gone") > 0).select(
        F.col("id").alias(id_), F.col("th").alias(th), F.col("n_lines").alias(n), F.col("gone").alias(gone))
    same_row = F.col(f"`{id_column}`").eqNullSafe(F.col(id_)) & (F.col(hashed) == F.col(th))
    out = docs.withColumn(hashed, F.xxhash64(whole)).join(found, same_row, "left")
    if drop_emptied:
        out = out.filter(F.coalesce(F.size(gone) < F.col(n), F.lit(True)))
    # Numbers of the kept lines; array_except works by hash, so many removals stay cheap.
    pieces = F.split(whole, "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size(pieces) - 1), F.col(gone))
    left = F.array_join(F.transform(F.arrays_zip(F.array(pieces).alias("p"), F.array(kept).alias("k")),
                                    lambda z: F.array_join(F.transform(z.k, lambda i: F.get(z.p, i)), "\n")), "")
    out = out.withColumn(text, F.when(F.col(gone).isNotNull(), left).otherwise(F.col(f"`{text}`")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(gone).isNotNull(), F.length(F.col(f"`{text}`")))
                             .otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.select(*[f"`{c}`" for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6: for every row of ``documents``, the numbers of the lines that go."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    rows = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("__th"))
    found = removals(docs).withColumnRenamed("id", "__id")
    out = rows.join(found, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__th") == F.col("th")), "left")
    return out.select("doc_id", F.coalesce("n_lines", F.lit(0)).cast("long").alias("n_lines"),
                      F.coalesce(F.when(F.size("gone") > 0, F.size("gone")), F.lit(0)).cast("long").alias("n_removed"),
                      F.coalesce(F.array_join(F.transform("gone", lambda i: i.cast("string")), ","), F.lit("")).alias("removed_lines"))


def oracle_sql() -> str:
    """The same in DuckDB, with the variants as texts instead of hashes (ids must be distinct)."""
    space = r"[ \t\n\x0B\f\r]"
    return rf"""with raw as (select doc_id, line, ls[line + 1] as t from (select doc_id, string_split(coalesce(text, ''), chr(10)) as ls from documents) x,
        unnest(range(0, length(ls))) as u(line)),
      l as (select doc_id, line, list_filter(string_split_regex(t, '{space}+'), lambda w: w <> '') as words from raw),
      p as (select doc_id, line, words, length(words) as n, array_to_string(words, ' ') as s from l where length(words) > 0),
      f as (select s, n, any_value(words) as words, min((coalesce(doc_id, 9223372036854775807), line)) as place from p group by s, n),
      v as (select s, place, n as r, i, s as rest from f, unnest(range(1, n + 2)) as u(i) where n >= {MIN_WORDS - 1}
            union all select s, place, n - 1, i, array_to_string(list_concat(words[1:i - 1], words[i + 1:]), ' ')
            from f, unnest(range(1, n + 1)) as u(i) where n >= {MIN_WORDS}),
      m as (select s, place, min(place) over (partition by r, i, rest) as least from v),
      near as (select distinct s from m where least < place),
      j as (select p.doc_id, p.line, near.s is not null or (coalesce(p.doc_id, 9223372036854775807), p.line) > f.place as gone
            from p join f using (s, n) left join near on near.s = p.s),
      k as (select doc_id, count(*) as n_lines, count(*) filter (gone) as n_removed,
              coalesce(string_agg(line, ',' order by line) filter (gone), '') as removed_lines from j group by doc_id)
      select d.doc_id, coalesce(n_lines, 0) as n_lines, coalesce(n_removed, 0) as n_removed, coalesce(removed_lines, '') as removed_lines
      from documents d left join k on d.doc_id is not distinct from k.doc_id"""
