"""URL verdicts by pattern rules indexed by their rarest literal token (op12).

Rules, as a list or a table (rule, verdict):
* a site rule `host/path` fits the host and its subdomains if the path
  starts with the rule's; among those that fit the longest wins;
* a pattern rule holds `*` (any characters), `^` (one character that is no
  ASCII letter or digit, or the start or end), or begins with `|` (the
  start); the rest is literal.  It is searched in host and path, A-Z
  lower-cased on both sides; the longest that fits wins, and counts only
  where no site rule does.
No rule: the default verdict.

Both are regular expressions over `host + path`.  Of a rule's literal tokens
(runs of ASCII letters and digits that the rule itself bounds on both sides)
the one that is rarest in all URLs is its key.  A URL's own tokens fetch the
rules of these keys, and only those run their expressions.  A rule without
such a token cannot be indexed; it is refused.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chanlytics.llm import common as C

#: Characters of rules whose index is sent to every task; beyond, URLs and index are joined.
BROADCAST_CHARS = 8 << 20

# The site rules that the query is given.
SITE_RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"),
              ("com/fr/", "allow"), ("com/de/", "block")]

#: Pattern rules of unwanted sites: gambling, pharmacy, adult and spam words, trackers, login and cart pages.
PATTERN_RULES = [(p, "block") for p in (
    "^casino^", "^poker^", "^jackpot^", "^bets^", "^betting^", "^free^bets^", "^pills^", "^viagra^", "^cheap^pills^", "^pharmacy^",
    "^porn^", "^xxx^", "^adult^", "^escort^", "^spam^", "^link^farm^", "^warez^", "^torrent^", "^crack^download^",
    "^ads^", "^adserver^", "^track^", "^tracker^", "/wp-login^", "/cart/checkout^", "^payday^loan^")]
PATTERN_RULES += [("^adult^education^", "allow"), ("^spam^filter^", "allow"), ("^track^field^", "allow")]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TO_LOWER = str.maketrans(_UPPER, _LOWER)
_TOKEN = "[A-Za-z0-9]+"


def expression(rule: str, site: bool) -> str:
    """The rule as a regular expression, searched in host + path."""
    if site:
        return r"^(?:[^/]*\.)?" + re.escape(rule)
    parts = {"*": r"[\s\S]*", "^": r"(?:^|(?![\s\S])|[^A-Za-z0-9])"}
    start, rule = rule.startswith("|"), rule.translate(_TO_LOWER)
    return ("^" if start else "") + "".join(parts.get(c) or re.escape(c) for c in rule[start:])


def rule_tokens(rule: str, site: bool) -> list[str]:
    """The rule's literal tokens that are whole tokens of every URL it fits."""
    bounded = "." + rule if site else rule.translate(_TO_LOWER).removeprefix("|")
    out = []
    for m in re.finditer(_TOKEN, bounded):
        first = m.start() == 0
        if first and not rule.startswith("|") or m.end() == len(bounded):
            continue  # what comes before or after the rule may prolong it
        if "*" in (bounded[m.start() - 1] if not first else "", bounded[m.end()]):
            continue
        out.append(m.group())
    return list(dict.fromkeys(out))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What stands after the first `://`: up to / ? # (A-Z lower-cased), then up to ? #; else both empty."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return (F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit("")), F.coalesce(path, F.lit("")))


def _rule_rows(spark: SparkSession, rules, site: bool) -> DataFrame:
    kind = "rule string, verdict string"
    rows = spark.createDataFrame(rules, kind) if isinstance(rules, list) else rules.select("rule", "verdict")
    return (rows.where("rule is not null").groupBy("rule").agg(F.max("verdict").alias("verdict"))
            .withColumn("site", F.lit(site)))


def build_index(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(token, rule, verdict, site, pattern): each rule under its rarest token in `urls` (target, lowered).

    Counts run over all URLs, of the rules' tokens only, and are summed per
    task before they move.  Ties: the longer, then the smaller token.
    """
    def prepare(batches):
        for batch in batches:
            rows = batch.to_pylist()
            rows = [{**r, "pattern": expression(r["rule"], r["site"]), "tokens": rule_tokens(r["rule"], r["site"])} for r in rows]
            none = [r["rule"] for r in rows if not r["tokens"]]
            if none:
                raise ValueError(f"rules without a whole literal token: {none[:5]}")
            yield pa.RecordBatch.from_pylist(rows, pa.schema([
                ("rule", pa.string()), ("verdict", pa.string()), ("site", pa.bool_()), ("pattern", pa.string()),
                ("tokens", pa.list_(pa.string()))]))

    made = rules.mapInArrow(prepare, "rule string, verdict string, site boolean, pattern string, tokens array<string>")
    held = made.select("rule", "verdict", "site", "pattern", F.explode("tokens").alias("token"))
    wanted = held.select("token").distinct()
    counts = (urls.select(F.explode(_tokens("target", "lowered")).alias("token"))
              .groupBy("token").agg(F.count(F.lit(1)).alias("n")).join(wanted, "token", "left_semi"))
    order = F.struct(F.coalesce("n", F.lit(0)).alias("n"), (-F.length("token")).alias("l"), F.col("token").alias("token"))
    return (held.join(counts, "token", "left").groupBy("rule", "site")
            .agg(F.min(order)["token"].alias("token"), F.first("verdict").alias("verdict"), F.first("pattern").alias("pattern")))


def _tokens(target: str, lowered: str) -> Column:
    """A URL's distinct tokens: of the path as it stands, for site rules, and lower-cased, for patterns."""
    return F.array_distinct(F.concat(F.regexp_extract_all(F.col(target), F.lit(f"({_TOKEN})")),
                                     F.regexp_extract_all(F.col(lowered), F.lit(f"({_TOKEN})"))))


def _best(rows: list[tuple], target: str, lowered: str) -> tuple:
    """(site rule, pattern rule, verdict) of candidates (rule, verdict, site, compiled pattern)."""
    fit = sorted((r for r in rows if r[3].search(target if r[2] else lowered)), key=lambda r: (-len(r[0]), r[0]))
    site = next((r for r in fit if r[2]), None)
    pattern = next((r for r in fit if not r[2]), None)
    return site and site[0], pattern and pattern[0], (site or pattern or (None, None))[1]


_FOUND = "rule string, pattern string, verdict string"


def _by_broadcast(urls: DataFrame, index: list, default: str) -> DataFrame:
    by_token: dict[str, list] = {}
    for r in index:
        by_token.setdefault(r.token, []).append((r.rule, r.verdict, r.site, r.pattern))
    sent = urls.sparkSession.sparkContext.broadcast(by_token)

    def judge(batches):
        token = re.compile(_TOKEN)
        rules = {t: [(*r[:3], re.compile(r[3])) for r in own] for t, own in sent.value.items()}
        for batch in batches:
            at = batch.schema.get_field_index
            out = []
            for target, lowered in zip(batch.column(at("target")).to_pylist(), batch.column(at("lowered")).to_pylist()):
                own = {*token.findall(target), *token.findall(lowered)} & rules.keys()
                out.append(_best([r for t in own for r in rules[t]], target, lowered) if own else (None, None, None))
            columns = [[r[i] for r in out] for i in range(3)]
            columns[2] = [v or default for v in columns[2]]
            keep = [n for n in batch.schema.names if n not in ("target", "lowered")]
            yield pa.RecordBatch.from_arrays([*(batch.column(at(n)) for n in keep), *(pa.array(c, pa.string()) for c in columns)],
                                             [*keep, "rule", "pattern", "verdict"])

    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in urls.schema.fields if f.name not in ("target", "lowered")]
    return urls.mapInArrow(judge, ", ".join([*kept, _FOUND]))


def _by_join(urls: DataFrame, index: DataFrame, default: str) -> DataFrame:
    """Each URL text once: its tokens meet the index in a plain join, which AQE splits where a token is frequent."""
    texts = urls.select("target", "lowered").distinct()
    asked = texts.select("target", "lowered", F.explode(_tokens("target", "lowered")).alias("token"))
    fit = asked.join(index, "token").where(
        F.rlike(F.when(F.col("site"), F.col("target")).otherwise(F.col("lowered")), F.col("pattern")))
    order = F.struct((-F.length("rule")).alias("l"), F.col("rule").alias("rule"), F.col("verdict").alias("verdict"))
    best = fit.groupBy(F.col("target").alias("__t"), F.col("lowered").alias("__l")).agg(
        F.min(F.when(F.col("site"), order)).alias("s"), F.min(F.when(~F.col("site"), order)).alias("p"))
    joined = urls.join(best, (F.col("target") == F.col("__t")) & (F.col("lowered") == F.col("__l")), "left")
    return joined.select(*[c for c in urls.columns if c not in ("target", "lowered")], F.col("s.rule").alias("rule"),
                         F.col("p.rule").alias("pattern"),
                         F.coalesce("s.verdict", "p.verdict", F.lit(default)).alias("verdict"))


def judge(df: DataFrame, keep: tuple[str, ...] = ("page_id",), url_col: str = "url", site_rules=SITE_RULES,
          pattern_rules=PATTERN_RULES, default: str = "allow", broadcast_chars: int = BROADCAST_CHARS) -> DataFrame:
    """The kept columns, host, path, rule (site rule or null), pattern (pattern rule or null) and verdict of each row.

    A null URL, or one without `://`, has an empty host and path, no rule and
    the default verdict.  Repeated rows are judged alike; an empty table
    gives none; columns that are not kept are not read, so they cannot
    clash.  Equal rules count once, with the greater verdict.  An index of at most broadcast_chars
    characters is broadcast; a larger one is joined, with the same result.
    """
    spark = df.sparkSession
    host, path = host_and_path(F.col(url_col).cast("string"))
    urls = df.select(*keep, host.alias("host"), path.alias("path"))
    urls = urls.select("*", F.concat("host", "path").alias("target"))
    urls = urls.select("*", F.translate("target", _UPPER, _LOWER).alias("lowered"))
    rules = _rule_rows(spark, site_rules, True).unionByName(_rule_rows(spark, pattern_rules, False))
    index = build_index(urls, rules)
    size = rules.agg(F.sum(F.length("rule"))).first()[0] or 0
    if size > broadcast_chars:
        return _by_join(urls, index, default)
    return _by_broadcast(urls, index.collect(), default)


def report(pages: DataFrame) -> DataFrame:
    return judge(pages.select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict", "pattern")


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _cases(rules, column: str, site: bool) -> str:
    """CASE over the rules in order of length: the first that fits; written without the operator's expressions."""
    lines = []
    for rule, _ in sorted(rules, key=lambda r: (-len(r[0]), r[0])):
        if site:
            host, path = rule.split("/", 1)
            fits = (f"(host = {_text(host)} OR ends_with(host, {_text('.' + host)})) "
                    f"AND starts_with(path, {_text('/' + path)})")
        else:
            body = rule.replace("^", "\x00")
            fits = (f"regexp_matches(lowered, {_text(re.escape(body).replace(chr(0), '(^|$|[^A-Za-z0-9])'))})")
        lines.append(f"WHEN {fits} THEN {_text(rule)}")
    return f"CASE {' '.join(lines)} END AS {column}"


def oracle(site_rules=SITE_RULES, pattern_rules=PATTERN_RULES) -> str:
    verdict = lambda column, rules: (
        f"CASE WHEN {column} IN ({', '.join(_text(r) for r, v in rules if v == 'block')}) THEN 'block' ELSE 'allow' END")
    return f"""
WITH rest AS (
  SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS r FROM pages
), split AS (
  SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host,
         regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rest
), marked AS (
  SELECT page_id, host, path, translate(host || path, '{_UPPER}', '{_LOWER}') AS lowered FROM split
), fit AS (
  SELECT page_id, host, path, {_cases(site_rules, 'rule', True)}, {_cases(pattern_rules, 'pattern', False)} FROM marked
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IS NOT NULL THEN {verdict('rule', site_rules)} ELSE {verdict('pattern', pattern_rules)} END AS verdict, pattern
FROM fit"""


ORACLE = oracle()
