"""Inputs that the operators' tests share."""

from pyspark.sql import types as T

#: Names that operators use inside, as further columns of the input.
CLASH = ("block", "doc_key", "node", "root", "band", "shard", "slot", "part", "ids", "spans", "window", "score",
         "licenses_", "start", "payload", "flag", "__key")

LONG = " ".join(f"w{i % 997}x{i // 7}" for i in range(30_000))
RUN = "q" * 50_000
BASE = ("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon "
        "phi chi psi omega one two three four five six seven eight nine ten")
ROWS = [
    (1, None), (2, ""), (3, "   \n\t "), (4, "a"), (5, "Alpha beta"), (6, BASE), (6, BASE), (7, BASE), (None, BASE),
    (None, None), (8, BASE.upper()), (9, BASE + " " + BASE), (10, "x " + BASE + " y"), (11, LONG), (12, RUN), (13, LONG),
    (14, "é è ▁ 日本語 🙂 naïve café"), (6, "other text of a repeated id"), (15, "a a a a a a a a a a a a a a a a a a a a a a a"),
    (16, "ends with newline\n"), (17, "tab\tand\x0bvertical\x0cform\rfeed"), (18, "\x00\x1f control"), (19, BASE[:120]),
]


def documents(spark, rows=ROWS, clash=True):
    fields = [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
              T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
              T.StructField("n_chars", T.LongType())]
    more = CLASH if clash else ()
    data = [(i, t, None if k % 3 else "en", None if k % 4 else "src0", None if k % 5 else len(t or ""),
             *("c" for _ in more)) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(data, T.StructType(fields + [T.StructField(c, T.StringType()) for c in more]))


def empty(spark):
    return documents(spark, [])
