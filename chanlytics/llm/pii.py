"""Personal data: base patterns, and bootstrapped contextual extraction.

Base spans come from four regular expressions with checks (Luhn, ranges,
digit counts).  They seed a bootstrap:
  - a candidate is a string of an identifier's loose shape that no base
    pattern accepts (a card number that fails its checksum, a phone number
    without its country prefix, an address without a dotted domain, ...);
  - a pattern is a lexical context of a string: the two words before it, or
    the two words after it, on its line, lower-cased;
  - patterns and distinct strings form a bipartite graph.  A pattern's
    confidence for a kind is the accepted share of the strings it extracts
    for that kind, where a string that is not accepted counts UNKNOWN: it
    speaks against the pattern, but less than an accepted one for it.  A
    string's score is 1 for seeds and else the noisy-or of its kept patterns.
    A pattern is kept from a confidence and a number of different accepted
    strings upwards.  Scores and patterns are computed in turn, in Spark,
    until no further string is accepted, or for a number of rounds.
  - occurrences of strings that end above the threshold are added, unless
    they overlap a base span.

All of it is DataFrame expressions.  Positions are code points, end
exclusive.  A match's position is the running sum of the lengths of what
stands between and in the matches, by a window over the document's matches,
so no step works on more than one match at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chanlytics.llm import common as C

KINDS = ("email", "ip", "card", "phone")

# The fixed patterns, with possessive quantifiers and starts only where a run
# begins (or a match has ended), which changes no match and keeps long runs linear.
_BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Further loose shapes, from which only candidates come.
_LOOSE = {
    "email": r"(?:\G|(?<![^\x00-\x20@]))[^\x00-\x20@]++@[^\x00-\x20@]++",
    "phone": r"(?:\G|(?<![0-9+]))\(?[0-9][\x20().0-9-]+[0-9]",
}
CONTEXT = 64  # characters before and after a string that a pattern may use
UNKNOWN = 0.25  # weight of a string that is not accepted in its patterns' confidence


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def value(i: Column) -> Column:  # i-th digit from the right, from 0
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return F.when(i % 2 == 1, twice).otherwise(d)

    total = F.aggregate(F.transform(F.sequence(F.lit(0), n - 1), value), F.lit(0), lambda a, x: a + x)
    return total % 10 == 0


def _accepted(kind: str, c: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        part = lambda x: F.regexp_replace(x, "^0+(?=[0-9])", "")
        small = lambda x: (F.length(part(x)) <= 3) & (F.coalesce(part(x).try_cast("int"), F.lit(999)) <= 255)
        return F.forall(F.split(c, "\\."), small)
    n = F.length(_digits(c))
    if kind == "card":
        return F.when((n >= 16) & (n <= 19), _luhn(_digits(c))).otherwise(F.lit(False))
    return (n >= 8) & (n <= 15)


def _loose(kind: str, c: Column) -> Column:
    """Whether a string that a base pattern does not accept still has the kind's shape."""
    n = F.length(_digits(c))
    return {"email": F.lit(True), "ip": F.lit(True), "card": (n >= 13) & (n <= 19),
            "phone": (n >= 7) & (n <= 15)}[kind]


#: A character without which a pattern has no match.
_NEEDS = {"email": "@", "ip": ".", "phone": "+"}


def _matches(rows: DataFrame) -> DataFrame:
    """doc_key, kind, base, start, end, item, before, after (the text next to it) of every match of every pattern.

    One pass over the texts; a text without a pattern's characters is not
    searched for it.
    """
    patterns = [(k, True, p) for k, p in _BASE.items()] + [(k, False, p) for k, p in _LOOSE.items()]
    digit = F.rlike("text", F.lit("[0-9]"))
    columns = []
    for n, (kind, base, pattern) in enumerate(patterns):
        need = F.contains("text", F.lit(_NEEDS[kind])) if kind in _NEEDS and (base or kind == "email") else digit
        columns += [F.when(need, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).alias(f"m{n}"),
                    F.when(need, F.split("text", pattern, -1)).alias(f"g{n}")]

    def entries(n: int) -> Column:  # one a match: the string, the length of the gap before it and its tail
        none = F.array().cast("array<struct<p:int,i:int,item:string,gap:int,before:string,after:string>>")
        return F.coalesce(F.transform(f"m{n}", lambda x, i: F.struct(
            F.lit(n).alias("p"), i.alias("i"), x.alias("item"), F.length(F.get(f"g{n}", i)).alias("gap"),
            F.right(F.get(f"g{n}", i), F.lit(CONTEXT)).alias("before"),
            F.left(F.get(f"g{n}", i + 1), F.lit(CONTEXT)).alias("after"))), none)

    # an outer explode, lest Spark derive a filter that evaluates the expressions once more
    every = F.concat(*[entries(n) for n in range(len(patterns))])
    each = (rows.select("doc_key", *columns).select("doc_key", F.explode_outer(every).alias("e"))
            .where("e is not null").select("doc_key", "e.*")
            .dropDuplicates(["doc_key", "p", "i"]))  # equal rows of documents
    upto = Window.partitionBy("doc_key", "p").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap") + F.length("item")).over(upto)
    which = lambda j: F.get(F.array(*[F.lit(x[j]) for x in patterns]), F.col("p"))
    return each.select("doc_key", which(0).alias("kind"), which(1).alias("base"),
                       (end - F.length("item")).alias("start"), end.alias("end"), "item", "before", "after")


def _patterns() -> Column:
    """The two words before and the two words after, on the string's own line; those that there are."""
    line = F.lower(F.element_at(F.split("before", "\n", -1), -1))
    left = F.regexp_extract(line, r"(\S+\s+\S+|\S+)\s*$", 1)
    line = F.lower(F.get(F.split("after", "\n", -1), 0))
    right = F.regexp_extract(line, r"^\s*(\S+\s+\S+)", 1)
    shown = lambda x, side: F.when(x != "", F.concat(F.lit(side), F.regexp_replace(x, r"\s+", " ")))
    return F.array_compact(F.array(shown(left, "before "), shown(right, "after ")))


def _ordered(spans: DataFrame) -> DataFrame:
    """doc_key and all spans, sorted by kind as listed and start."""
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    return spans.groupBy("doc_key").agg(F.array_sort(F.collect_set(
        F.struct(rank.alias("rank"), "start", "end", "kind"))).alias("spans"))


def bootstrap(strings: DataFrame, rounds: int = 6, confidence: float = 0.95, support: int = 5,
              unknown: float = UNKNOWN) -> DataFrame:
    """(kind, item) of candidates that patterns accept.

    strings: doc_key, kind, item, seed (boolean), patterns.  A string counts
    once for a pattern, however many documents repeat it.
    """
    edges = (strings.select("kind", "item", "seed", F.explode("patterns").alias("pattern"))
             .groupBy("pattern", "kind", "item").agg(F.max("seed").alias("seed")).checkpoint())
    scores = edges.groupBy("kind", "item").agg(F.max("seed").alias("seed")).withColumn("score", F.col("seed").cast("double"))
    accepted = 0
    for _ in range(rounds):
        yes = F.sum(F.when(F.col("score") >= confidence, 1).otherwise(0))
        judged = (edges.select("pattern", "kind", "item").join(scores, ["kind", "item"]).groupBy("pattern", "kind")
                  .agg(yes.alias("n"), F.count(F.lit(1)).alias("all"))
                  .withColumn("conf", F.col("n") / (F.col("n") + unknown * (F.col("all") - F.col("n"))))
                  .where((F.col("n") >= support) & (F.col("conf") >= confidence)))
        # a candidate's noisy-or over the kept patterns that extract it; seeds stay at 1
        doubt = F.sum(F.log(F.greatest(F.lit(1e-9), 1 - F.coalesce("conf", F.lit(0.0)))))
        scores = (edges.join(judged.select("pattern", "kind", "conf"), ["pattern", "kind"], "left")
                  .groupBy("kind", "item").agg(F.max("seed").alias("seed"), (1 - F.exp(doubt)).alias("p"))
                  .select("kind", "item", "seed", F.when(F.col("seed"), F.lit(1.0)).otherwise(F.col("p")).alias("score"))
                  .checkpoint())
        now = scores.where(~F.col("seed") & (F.col("score") >= confidence)).count()
        if now == accepted:
            break
        accepted = now
    return scores.where(~F.col("seed") & (F.col("score") >= confidence)).select("kind", "item")


def find(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = 6, confidence: float = 0.95,
         support: int = 5) -> DataFrame:
    """doc_key, doc_id, base and spans (arrays of rank, start, end, kind) for each row of df.

    Null and empty texts have no spans.  Equal rows get equal results; rows
    that share an id but not the text stay apart.  Other columns are ignored.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = df.select(F.xxhash64(F.col(id_col), text).alias("doc_key"), F.col(id_col).cast("long").alias("doc_id"),
                     text.alias("text"))
    item = F.col("item")
    accepted, loose = F.lit(False), F.lit(False)
    for kind in KINDS:
        accepted = F.when(F.col("kind") == kind, _accepted(kind, item)).otherwise(accepted)
        loose = F.when(F.col("kind") == kind, _loose(kind, item)).otherwise(loose)
    every = (_matches(rows).withColumn("seed", F.col("base") & accepted).where(F.col("seed") | loose)
             .withColumn("patterns", _patterns()).drop("before", "after", "base"))
    # candidates must not touch a base span of their document
    order = Window.partitionBy("doc_key").orderBy("start", "end")
    earlier = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    later = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    strings = (every.withColumn("reach", F.max(F.when(F.col("seed"), F.col("end"))).over(earlier))
               .withColumn("next", F.min(F.when(F.col("seed"), F.col("start"))).over(later))
               .where(F.col("seed") | ((F.coalesce("reach", F.lit(-1)) <= F.col("start"))
                                       & (F.coalesce("next", F.col("end")) >= F.col("end"))))
               .drop("reach", "next").checkpoint())
    learnt = bootstrap(strings, rounds, confidence, support)
    seeds = strings.where("seed")
    added = strings.where(~F.col("seed")).join(learnt, ["kind", "item"], "left_semi")
    columns = ("doc_key", "kind", "start", "end")
    # of candidates that overlap each other, all are kept: their union is what is personal
    base = _ordered(seeds.select(*columns)).withColumnRenamed("spans", "base")
    whole = _ordered(seeds.select(*columns).unionByName(added.select(*columns)))
    return (rows.select("doc_key", "doc_id").join(base.join(whole, "doc_key", "full"), "doc_key", "left")
            .withColumns({c: F.coalesce(c, F.array().cast("array<struct<rank:bigint,start:bigint,end:bigint,kind:string>>"))
                          for c in ("base", "spans")}))


def mask(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """df with every span of its texts replaced by the kind in angle brackets; overlapping spans by the first's kind.

    Null texts stay null; rows and other columns are kept as they are.
    """
    keyed = df.withColumn("__key", F.xxhash64(F.col(id_col), F.coalesce(F.col(text_col).cast("string"), F.lit(""))))
    spans = (find(df, id_col, text_col).where(F.size("spans") > 0).dropDuplicates(["doc_key"])
             .select(F.col("doc_key").alias("__key"), F.array_sort(F.transform("spans", lambda s: F.struct(
                 s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))).alias("__spans")))
    # pieces in order: the text since the span before, then the mark
    state = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))
    piece = lambda s, x: F.concat(F.substring(F.col(text_col), (s["at"] + 1).cast("int"),
                                              F.greatest(F.lit(0), x["start"] - s["at"]).cast("int")),
                                  F.when(x["start"] >= s["at"], F.concat(F.lit("<"), x["kind"], F.lit(">"))).otherwise(""))
    step = lambda s, x: F.struct(F.greatest(s["at"], x["end"]).alias("at"),
                                 F.concat(s["out"], F.array(piece(s, x))).alias("out"))
    last = lambda s: F.concat(F.array_join(s["out"], ""), F.substring(
        F.col(text_col), (s["at"] + 1).cast("int"), F.length(F.col(text_col))))
    masked = F.when(F.col("__spans").isNull() | F.col(text_col).isNull(), F.col(text_col)).otherwise(
        F.aggregate("__spans", state, step, last))
    return keyed.join(spans, "__key", "left").withColumn(text_col, masked).select(*df.columns)


def report(df: DataFrame) -> DataFrame:
    """Counts, digest of the base spans, and all spans as kind:start:end."""
    said = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    found = find(df)

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, KINDS), F.sha2(said("base"), 256).alias("base_sha256"), said("spans").alias("spans"))
