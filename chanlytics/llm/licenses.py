"""License notices in texts: MinHash bands over overlapping windows, then exact containment.

Words are runs of a-z and 0-9 after lower-casing, shingles two consecutive
words.  For a template of k shingles, windows of k + k//2 - 1 shingles start
at every (k//2)-th shingle, so each place where the template can stand lies
whole in one of them.  Window and template then have a Jaccard similarity
of 2/3 or more (one that keeps `containment` of the shingles, 0.5 or more),
and with 16 bands of one minimum each they meet with probability
1 - 0.34^16 (1 - 2e-5).  A window that meets is verified: the share of the
template's shingles that it holds.

A band can only match in a window that holds the template's own minimum of
that band, so windows are made around those shingles alone; documents
without any are passed over.  Everything is one projection: no shuffle, and
every row is answered where it is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BANDS = 16
CONTAINMENT = 0.8

#: Notices that name a license (name, text).
TEMPLATES = (
    ("all-rights-reserved", "All rights reserved."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
)


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), "[^a-z0-9]+"), "")


def _shingles(words: Column) -> Column:
    pair = lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1))
    return F.when(F.size(words) >= 2, F.transform(F.sequence(F.lit(0), F.size(words) - 2), pair)).otherwise(
        F.array().cast("array<bigint>"))


def _rank(shingle: Column, band: int) -> Column:
    """The shingle's place in a band's order."""
    return F.xxhash64(shingle, F.lit(band))


def _profile(spark: SparkSession, templates, bands: int) -> list[tuple]:
    """(name, distinct shingles, minimum of each band, the shingle that has it) of each template."""
    rows = spark.range(1).select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("name"), F.lit(t).alias("text")) for n, t in templates])).alias("t")).select("t.*")
    own = F.array_distinct(_shingles(_words(F.col("text"))))

    def best(b: int) -> Column:
        return F.array_min(F.transform(F.col("s"), lambda x: F.struct(_rank(x, b).alias("r"), x.alias("s"))))

    found = rows.select("name", own.alias("s")).select("name", "s", F.array(*map(best, range(bands))).alias("m"))
    out = [(r["name"], list(r["s"]), [m["r"] for m in r["m"]], sorted({m["s"] for m in r["m"]}))
           for r in found.collect() if r["s"]]  # one row a template
    return out


def scan(df: DataFrame, templates=TEMPLATES, containment: float = CONTAINMENT, bands: int = BANDS,
         text_col: str = "text", out: str = "licenses") -> DataFrame:
    """df with a column `out`: array of (license, containment), by name, of the templates found.

    One entry for each template, with the best containment of its windows.
    Null and empty texts, and texts of one word, have none.  Templates of
    fewer than two words are ignored.  All rows and other columns stay; a
    column named `out` is replaced.
    """
    profile = _profile(df.sparkSession, templates, bands)
    keys = F.array(*[F.lit(x) for x in sorted({k for _, _, _, own in profile for k in own})]).cast("array<bigint>")
    s = F.col("__s")

    def one(name: str, shingles: list[int], minima: list[int], own: list[int]) -> Column:
        k = len(shingles)
        step = max(1, k // 2)
        width = k + step - 1
        mine = F.array(*[F.lit(x) for x in shingles])
        places = F.filter(F.transform(s, lambda x, i: F.when(x.isin(own), i)), lambda i: i.isNotNull())
        # windows start at 0, step, 2 step, ...: those that hold place i
        first = lambda i: F.greatest(F.lit(0), F.ceil((i - F.lit(width - 1)) / F.lit(step)).cast("int"))
        starts = F.array_distinct(F.flatten(F.transform(places, lambda i: F.transform(
            F.sequence(first(i), F.floor(i / F.lit(step)).cast("int")), lambda j: j * step))))
        window = lambda a: F.slice(s, a + 1, width)

        def band(a: Column, b: int) -> Column:
            return F.array_min(F.transform(window(a), lambda x: _rank(x, b))) == F.lit(minima[b])

        def met(a: Column) -> Column:
            hit = band(a, 0)
            for b in range(1, bands):
                hit = hit | band(a, b)
            return hit

        held = F.transform(F.filter(starts, met), lambda a: F.size(F.array_intersect(mine, window(a))) / F.lit(float(k)))
        return F.struct(F.lit(name).alias("license"), F.array_max(held).alias("containment"))

    every = F.array(*[one(*p) for p in profile]) if profile else None
    kind = "array<struct<license:string,containment:double>>"
    none = F.array().cast(kind)
    found = none if every is None else F.when(
        F.arrays_overlap(s, keys),
        F.array_sort(F.filter(every, lambda x: x["containment"] >= containment))).otherwise(none).cast(kind)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    columns = [c for c in df.columns if c != out]
    return (df.select(*columns, _words(text).alias("__w")).select(*columns, _shingles(F.col("__w")).alias("__s"))
            .select(*columns, found.alias(out)))


def report(df: DataFrame) -> DataFrame:
    """doc_id, n_licenses and the names found, comma-joined."""
    return scan(df.select("doc_id", "text")).select(
        "doc_id", F.size("licenses").cast("long").alias("n_licenses"),
        F.array_join("licenses.license", ",").alias("licenses"))


def _oracle() -> str:
    values = ", ".join("('{}', '{}')".format(n, t.replace("'", "''")) for n, t in TEMPLATES)
    return f"""
WITH t AS (SELECT n, regexp_extract_all(lower(x), '[a-z0-9]+') AS w FROM (VALUES {values}) AS v(n, x)),
ts AS (SELECT n, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS s FROM t),
d AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9]+') AS w FROM documents),
ds AS (SELECT doc_id, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) AS s FROM d),
near AS (SELECT doc_id, ds.s, n, ts.s AS own, len(ts.s) AS k, greatest(1, len(ts.s) // 2) AS step
         FROM ds JOIN ts ON list_has_any(ds.s, ts.s)),
hit AS (SELECT DISTINCT doc_id, n FROM near, unnest(range(0, len(s), step)) AS r(a)
        WHERE len(list_intersect(own, s[a + 1:a + k + step - 1])) >= {CONTAINMENT} * k)
SELECT d.doc_id, count(n) AS n_licenses, coalesce(string_agg(n, ',' ORDER BY n), '') AS licenses
FROM d LEFT JOIN hit USING (doc_id) GROUP BY d.doc_id
"""


ORACLE = _oracle()
