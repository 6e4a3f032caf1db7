"""Search through trigram postings: the same rows as a scan, from fewer files."""

import os

import pytest

from chanlytics import model
from chanlytics.functions.text import like_runs
from chanlytics.operators import search_index as X
from chanlytics.plans import reports as R

TEXTS = ["Paracetamol 500", "C:\\dir d", "c:dir", "50% off", "50 off", "a_b c", "axb c", "back\\slash", "ends with %", None, "", "ab",
         "ÀÉÎ ÖÜ été", "line\nbreak here", "😀😁😂 smile", "x" * (X.PIECE - 2) + "needle" + "y" * 9, "İstanbul", "NEEDLE", "aaa", "aaaa"]
QUERIES = ["paracetamol", "c:\\dir", "c:\\\\dir", "50\\% off", "a\\_b c", "a_b c", "with \\", "ra%mol", "ab", "%%", "__", "éî öü", "été",
           "e\nb", "😀😁😂", "needle", "aaaa", "k\\\\sl", "istanbul", "no such text", "n_e%dle"]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("search index"))
    made = []
    base = spark.createDataFrame(list(enumerate(TEXTS)), "i int, t string")
    for name in model.FCT_MESSAGES_COLUMNS:
        made.append("t as message_text" if name == "message_text" else "cast(i as string) as message_sk" if name == "message_sk"
                    else f"i as {name}" if name.endswith("date_sk") else f"0 as {name}")
    base.selectExpr(*made).repartitionByRange(len(TEXTS), "message_date_sk").write.parquet(f"{folder}/fct")
    assert sum(f.endswith(".parquet") for f in os.listdir(f"{folder}/fct")) > 15
    return f"{folder}/fct", X.write_postings(spark, f"{folder}/fct", f"{folder}/postings")


@pytest.mark.parametrize("literal", [False, True])
def test_same_rows_as_a_scan(spark, stored, literal):
    path, postings = stored
    fct = spark.read.parquet(path)
    for q in QUERIES:
        want = R.search_messages(fct, q, literal).collect()
        assert R.search_messages(fct, q, literal, postings=postings).collect() == want, q


def test_rare_terms_read_few_files(spark, stored):
    path, postings = stored
    fct = spark.read.parquet(path)
    every = len(fct.inputFiles())
    assert len(X.candidate_files(fct, postings, "paracetamol")) == 1
    assert len(X.candidate_files(fct, postings, "needle")) == 2
    assert X.candidate_files(fct, postings, "no such text") == []
    assert len(X.candidate_files(fct, postings, "ab")) == every      # nothing to look up
    plan = R.search_messages(fct, "paracetamol", postings=postings)
    assert len(plan.inputFiles()) * 10 < every


def test_files_without_postings_are_read(spark, stored, tmp_dir):
    path, _ = stored
    fct = spark.read.parquet(path)
    early = fct.where("message_date_sk < 5")
    early.write.parquet(f"{tmp_dir}/fct")
    postings = X.write_postings(spark, f"{tmp_dir}/fct", f"{tmp_dir}/postings")
    fct.where("message_date_sk = 17").write.mode("append").parquet(f"{tmp_dir}/fct")
    grown = spark.read.parquet(f"{tmp_dir}/fct")
    assert [r.message_text for r in R.search_messages(grown, "needle", postings=postings).collect()] == ["NEEDLE"]


def test_an_empty_table_has_no_postings(spark, stored, tmp_dir):
    fct = spark.read.parquet(stored[0])
    fct.where("false").write.parquet(f"{tmp_dir}/fct")
    postings = X.write_postings(spark, f"{tmp_dir}/fct", f"{tmp_dir}/postings")
    assert postings.count() == 0
    assert R.search_messages(spark.read.parquet(f"{tmp_dir}/fct"), "needle", postings=postings).collect() == []


def test_plain_runs_of_a_query():
    assert like_runs("a_b%cd") == ["a", "b", "cd"]
    assert like_runs("50\\%\\\\x") == ["50%\\x"]
    assert like_runs("with \\") == ["with %"]
    assert like_runs("A%b", literal=True) == ["a%b"]
    assert X.query_trigrams("abcd_bcd") == ["abc", "bcd"]
