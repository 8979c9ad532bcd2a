"""Quality rules whose thresholds come from the corpus, DataFrame operations only.

Each text gives a few whole-number rates. Per language and source, every rate is summarised
in a mergeable quantile sketch: counts of logarithmic buckets (exact below 64, within 1/32
above), made by one grouped count with map-side combining, so a source that holds a third
of all rows costs its buckets only. The sketch of a language is the sum of its sources'
sketches, that of the corpus the sum of the languages'. A quartile of few documents says
little, so every quartile is drawn towards the next wider group's as if ``PRIOR`` documents
of that had been counted in: ``(n * own + PRIOR * wider) div (n + PRIOR)``, for a source
towards its language and for a language towards the corpus, by the one formula at every size.
The language also caps what a mostly spoilt source can make normal. A document fails a rule
if its rate lies beyond its group's upper (or lower) quartile by more than three quartile
ranges; a floor per rate says what spread is harmless anyway.

The texts are read once; thresholds are joined to the staged rates.

Defined results: a null or empty text has no words and fails the base rules; rows without
language or source form groups of their own; repeated rows count and are judged each;
an empty table gives an empty result.
"""

from __future__ import annotations



from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from histmill.llm.common import ensure_columns, stage

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
#: Documents that the wider group's quartiles count for beside a group's own.
PRIOR = 100
#: Quartile ranges beyond the quartile, and how much wider the language's cap is.
SPREAD, CAP = 3, 2
#: rate -> (upper limit?, spread that is harmless in any group); rates are per 10,000, but
#: mean_word is in hundredths of a character.
RATES: dict[str, tuple[bool, int]] = {
    "symbols": (True, 300), "dup_lines": (True, 4000), "repeats": (True, 3000), "capitals": (True, 1500),
    "calls": (True, 1000), "digits": (True, 1500), "mean_word": (True, 150), "short_word": (False, 150),
    "distinct": (False, 3000),
}


#: Columns that the operator adds; a table's own columns of these names are replaced.
RESULTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "failed_rules", "kept",
           "limits")


def _count_of(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def base_counts(docs: DataFrame) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed
    and the rates."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    own = [c for c in docs.columns if c not in RESULTS]
    step = docs.select(*own, words.alias("__w"), lines.alias("__l"), text.alias("__t"))
    step = step.select(*own, "__w", "__t", F.size("__w").alias("__n"),
                       F.size("__l").alias("__lines"),
                       (F.size("__l") - F.size(F.array_distinct("__l"))).alias("__dup"))
    # three-word windows with their positions, sorted by hash: equal ones are neighbours
    m = F.greatest(F.col("__n") - 2, F.lit(0))
    windows = F.arrays_zip(F.slice("__w", 1, m).alias("a"), F.slice("__w", 2, m).alias("b"),
                           F.slice("__w", 3, m).alias("c"))
    hashed = F.sort_array(F.transform(windows, lambda x, i: F.struct(
        F.xxhash64(x["a"], x["b"], x["c"]).alias("h"), i.alias("i"))))
    step = step.withColumn("__s", hashed)
    k = F.greatest(F.size("__s") - 1, F.lit(0))
    pairs = F.filter(F.arrays_zip(F.slice("__s", 1, k).alias("p"), F.slice("__s", 2, k).alias("q")),
                     lambda x: x["p"]["h"] == x["q"]["h"])
    covered = F.size(F.array_distinct(F.flatten(F.transform(pairs, lambda x: F.array(
        *[x[side]["i"] + d for side in ("p", "q") for d in (0, 1, 2)])))))
    step = step.select(
        *own, F.col("__n").cast("long").alias("n_words"),
        F.length(F.regexp_replace("__t", r"[\x20\x09-\x0D]+", "")).cast("long").alias("word_chars"),
        _count_of(F.col("__t"), SYMBOLS).cast("long").alias("n_symbols"),
        F.col("__dup").cast("long").alias("n_dup_lines"), covered.cast("long").alias("n_repeat_words"),
        F.col("__lines").alias("__lines"), F.size(F.array_distinct("__w")).alias("__distinct"),
        _count_of(F.col("__t"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ").alias("__capitals"),
        _count_of(F.col("__t"), "!?").alias("__calls"), _count_of(F.col("__t"), "0123456789").alias("__digits"))

    def per(part: str, whole: str, unit: int) -> Column:
        return F.expr(f"cast({unit} as bigint) * {part} div greatest({whole}, 1)")

    rates = {"symbols": per("n_symbols", "word_chars", 10000), "dup_lines": per("n_dup_lines", "__lines", 10000),
             "repeats": per("n_repeat_words", "n_words", 10000), "capitals": per("__capitals", "word_chars", 10000),
             "calls": per("__calls", "word_chars", 10000), "digits": per("__digits", "word_chars", 10000),
             "mean_word": per("word_chars", "n_words", 100), "short_word": per("word_chars", "n_words", 100),
             "distinct": per("__distinct", "n_words", 10000)}
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return step.select(*own, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       failed.alias("base_failed"), F.struct(*[rates[r].alias(r) for r in RATES]).alias("__rates"))


def bucket(v: Column) -> Column:
    """Sketch bucket of a whole number >= 0: itself below 64, then 32 buckets to a doubling."""
    shift = F.greatest(F.length(F.bin(v)) - 6, F.lit(0))
    return 32 * shift + F.floor(v / F.pow(F.lit(2.0), shift))


def bucket_top(b: str) -> str:
    """SQL for the largest number of a bucket."""
    shift = f"greatest({b} div 32 - 1, 0)"
    return f"shiftleft({b} - 32 * {shift} + 1, cast({shift} as int)) - 1"


def sketches(rated: DataFrame) -> DataFrame:
    """(lang, source, rate, bucket, n) of the documents that pass the base rules."""
    each = F.explode(F.array(*[F.struct(F.lit(r).alias("rate"), bucket(F.col(f"__rates.{r}")).alias("bucket"))
                               for r in RATES]))
    return (rated.filter(~F.col("base_failed")).select("lang", "source", each.alias("x"))
            .groupBy("lang", "source", "x.rate", "x.bucket").agg(F.count("*").alias("n")))


def quartiles(sketch: DataFrame, *group: str) -> DataFrame:
    """Per group and rate: total, q1 and q3 (tops of their buckets). A group's window holds
    its few hundred buckets."""
    upto = Window.partitionBy(*group, "rate").orderBy("bucket")
    whole = Window.partitionBy(*group, "rate")
    run = (sketch.withColumn("upto", F.sum("n").over(upto)).withColumn("total", F.sum("n").over(whole)))
    return (run.groupBy(*group, "rate").agg(
        F.max("total").alias("total"),
        F.min(F.when(4 * F.col("upto") >= F.col("total"), F.col("bucket"))).alias("b1"),
        F.min(F.when(4 * F.col("upto") >= 3 * F.col("total"), F.col("bucket"))).alias("b3"))
        .select(*group, "rate", "total", F.expr(bucket_top("b1")).alias("q1"), F.expr(bucket_top("b3")).alias("q3")))


def drawn(own: str, wider: str, total: str) -> Column:
    """A quartile of ``total`` documents drawn towards the wider group's."""
    return F.expr(f"({total} * {own} + {PRIOR} * {wider}) div ({total} + {PRIOR})")


def thresholds(sketch: DataFrame) -> DataFrame:
    """Per (lang, source) a map rate -> limit."""
    merged = sketch.groupBy("lang", "rate", "bucket").agg(F.sum("n").alias("n"))
    corpus = merged.groupBy("rate", "bucket").agg(F.sum("n").alias("n"))
    whole = quartiles(corpus).select(F.col("rate").alias("c_rate"), F.col("q1").alias("c_q1"), F.col("q3").alias("c_q3"))
    by_lang = (quartiles(merged, "lang").join(whole, F.col("rate") == F.col("c_rate"))
               .select(F.col("lang").alias("l_lang"), F.col("rate").alias("l_rate"),
                       drawn("q1", "c_q1", "total").alias("l_q1"), drawn("q3", "c_q3", "total").alias("l_q3")))
    floor = F.create_map(*[F.lit(x) for r, (_, f) in RATES.items() for x in (r, f)])
    upper = F.create_map(*[F.lit(x) for r, (u, _) in RATES.items() for x in (r, u)])
    both = (quartiles(sketch, "lang", "source")
            .join(by_lang, F.col("lang").eqNullSafe(F.col("l_lang")) & (F.col("rate") == F.col("l_rate")))
            .withColumn("q1", drawn("q1", "l_q1", "total")).withColumn("q3", drawn("q3", "l_q3", "total"))
            .withColumn("floor", floor[F.col("rate")]).withColumn("up", upper[F.col("rate")]))
    room = F.greatest(SPREAD * (F.col("q3") - F.col("q1")), F.col("floor"))
    l_room = F.greatest(SPREAD * (F.col("l_q3") - F.col("l_q1")), F.col("floor"))
    limit = (F.when(F.col("up"), F.least(F.col("q3") + room, F.col("l_q3") + CAP * l_room))
             .otherwise(F.greatest(F.col("q1") - room, F.col("l_q1") - CAP * l_room)))
    return (both.withColumn("limit", limit.cast("long"))
            .groupBy("lang", "source").agg(F.map_from_entries(F.collect_list(F.struct("rate", "limit"))).alias("limits")))


def judge(docs: DataFrame) -> DataFrame:
    """``docs`` (text, lang, source and anything else) with the counts, base_failed,
    failed_rules and kept."""
    ensure_columns(docs, "text", "lang", "source")
    rated = stage(base_counts(docs).drop("text"))
    limits = stage(thresholds(sketches(rated))).select(
        F.col("lang").alias("__lang"), F.col("source").alias("__source"), "limits")
    joined = rated.join(limits, F.col("lang").eqNullSafe(F.col("__lang"))
                        & F.col("source").eqNullSafe(F.col("__source")), "left")
    broken = [F.when(F.col(f"__rates.{r}") > F.col("limits")[r] if up else F.col(f"__rates.{r}") < F.col("limits")[r],
                     F.lit(r)) for r, (up, _) in RATES.items()]
    rules = F.array_compact(F.array(*broken))
    return (joined.withColumn("failed_rules", rules)
            .withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
            .drop("__lang", "__source", "limits", "__rates"))


def _oracle() -> str:
    """The same in DuckDB's SQL."""
    unit = {"symbols": "10000 * n_symbols // greatest(word_chars, 1)",
            "dup_lines": "10000 * n_dup_lines // greatest(lines, 1)",
            "repeats": "10000 * n_repeat_words // greatest(n_words, 1)",
            "capitals": "10000 * capitals // greatest(word_chars, 1)",
            "calls": "10000 * calls // greatest(word_chars, 1)", "digits": "10000 * digits // greatest(word_chars, 1)",
            "mean_word": "100 * word_chars // greatest(n_words, 1)",
            "short_word": "100 * word_chars // greatest(n_words, 1)",
            "distinct": "10000 * uniq // greatest(n_words, 1)"}
    rates = " union all ".join(
        f"select rid, lang, source, base_failed, '{r}' as rate, {unit[r]} as v, {str(up).lower()} as up, "
        f"{floor} as least_room from counted" for r, (up, floor) in RATES.items())
    top = ("((({b} - 32 * greatest({b} // 32 - 1, 0) + 1)::bigint << greatest({b} // 32 - 1, 0)::bigint) - 1)")
    return f"""
with doc as (
  select row_number() over () as rid, doc_id, lang, source, coalesce(text, '') as t from documents
), parts as (
  select *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') as w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as l from doc
), pos as (
  select rid, unnest(w) as a, unnest(range(len(w))) as i from parts
), win as (
  select *, lead(a, 1) over o as b, lead(a, 2) over o as c from pos window o as (partition by rid order by i)
), hit as (
  select rid, i, (c is not null and count(*) over (partition by rid, a, b, c) > 1) as dup from win
), cover as (
  select rid, dup or coalesce(lag(dup, 1) over o, false) or coalesce(lag(dup, 2) over o, false) as in_dup
  from hit window o as (partition by rid order by i)
), rep as (
  select rid, count(*) filter (in_dup) as n from cover group by rid
), counted as (
  select p.rid, doc_id, lang, source, len(w)::bigint as n_words,
         length(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g'))::bigint as word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
         (len(l) - len(list_distinct(l)))::bigint as n_dup_lines, coalesce(rep.n, 0)::bigint as n_repeat_words,
         len(l) as lines, len(list_distinct(w)) as uniq,
         length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) as capitals,
         length(t) - length(regexp_replace(t, '[!?]', '', 'g')) as calls,
         length(t) - length(regexp_replace(t, '[0-9]', '', 'g')) as digits,
         len(w) < {MIN_WORDS} or 100 * coalesce(rep.n, 0) > 50 * len(w) as base_failed
  from parts p left join rep on p.rid = rep.rid
), rated as ({rates}
), bucketed as (
  select lang, source, rate, up, least_room,
         (32 * greatest(length(bin(v)) - 6, 0) + (v >> greatest(length(bin(v)) - 6, 0)))::bigint as b
  from rated where not base_failed
), cum as (
  select lang, source, rate, up, least_room, b, count(*) as n from bucketed group by all
), src as (
  select lang, source, rate, up, least_room, sum(n) as total,
         min(b) filter (4 * upto >= whole) as b1, min(b) filter (4 * upto >= 3 * whole) as b3
  from (select *, sum(n) over (partition by lang, source, rate order by b) as upto,
               sum(n) over (partition by lang, source, rate) as whole from cum) group by all
), lng as (
  select lang, rate, max(whole) as total, min(b) filter (4 * upto >= whole) as b1, min(b) filter (4 * upto >= 3 * whole) as b3
  from (select lang, rate, b, sum(n) over (partition by lang, rate order by b) as upto,
               sum(n) over (partition by lang, rate) as whole
        from (select lang, rate, b, sum(n) as n from cum group by all)) group by all
), everything as (
  select rate, min(b) filter (4 * upto >= whole) as b1, min(b) filter (4 * upto >= 3 * whole) as b3
  from (select rate, b, sum(n) over (partition by rate order by b) as upto, sum(n) over (partition by rate) as whole
        from (select rate, b, sum(n) as n from cum group by all)) group by all
), lang_fence as (
  select lang, rate, (total * {top.format(b='g.b1')} + {PRIOR} * {top.format(b='c.b1')}) // (total + {PRIOR}) as g1,
         (total * {top.format(b='g.b3')} + {PRIOR} * {top.format(b='c.b3')}) // (total + {PRIOR}) as g3
  from lng g join everything c using (rate)
), fence as (
  select s.lang, s.source, s.rate, s.up, g1, g3, least_room,
         (total * {top.format(b='s.b1')} + {PRIOR} * g1) // (total + {PRIOR}) as q1,
         (total * {top.format(b='s.b3')} + {PRIOR} * g3) // (total + {PRIOR}) as q3
  from src s join lang_fence g on s.lang is not distinct from g.lang and s.rate = g.rate
), room as (
  select *, greatest({SPREAD} * (q3 - q1), least_room) as r, greatest({SPREAD} * (g3 - g1), least_room) as gr
  from fence
), lim as (
  select lang, source, rate,
         case when up then least(q3 + r, g3 + {CAP} * gr) else greatest(q1 - r, g1 - {CAP} * gr) end as bound
  from room
), broken as (
  select distinct t.rid from rated t join lim on t.lang is not distinct from lim.lang
    and t.source is not distinct from lim.source and t.rate = lim.rate
  where case when t.up then t.v > lim.bound else t.v < lim.bound end
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and b.rid is null as kept
from counted c left join broken b on c.rid = b.rid
"""


ORACLE = _oracle()
