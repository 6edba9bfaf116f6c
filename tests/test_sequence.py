import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from readloom.functions import sequence as S


def one(spark, made, **columns):
    return spark.createDataFrame([tuple(columns.values())], ", ".join(f"{c} string" for c in columns)).select(made).first()[0]


def test_header(spark):
    for name, want in (("@a:b 1:N", "@a:b:ACG 1:N"), ("@a:b", "@a:b:ACG "), ("@a b c", "@a:ACG bc")):
        assert one(spark, S.tagged_name(F.col("n"), F.lit("ACG")), n=name) == want


def test_trim_and_revcomp(spark):
    assert one(spark, S.trim(F.col("s"), 3, 2), s="ACGTACGT") == "TAC"
    assert one(spark, S.trim(F.col("s"), 2, 3), s="ACGTACGT") == "GTA"
    assert one(spark, S.trim(F.col("s"), 3, 2), s="ACGT") == ""
    assert one(spark, S.revcomp(F.col("s")), s="ACGTNa") == "aNACGT"
    assert one(spark, S.revcomp_head(F.col("s"), 3), s="ACGTNa") == "aNA"


def test_scores(spark):
    assert one(spark, S.phred_sum(F.col("q")), q="!+5?I") == 100
    assert one(spark, S.phred_sum(F.col("q")), q="") == 0
    with pytest.raises(Exception, match="quality signs"):
        one(spark, S.phred_sum(F.col("q")), q="AZ")


def test_hamming(spark):
    for size in (None, 4):
        assert one(spark, S.hamming(F.col("a"), F.col("b"), size), a="ACGT", b="AGGA") == 2
    with pytest.raises(Exception, match="unequal length"):
        one(spark, S.hamming(F.col("a"), F.col("b")), a="ACGT", b="AC")


def test_cigar_and_umi(spark):
    assert one(spark, S.reference_span(F.col("c")), c="5S30M2I4D3H10N1=1X") == 46
    assert one(spark, S.umi_of_header(F.col("n")), n="@a:b:c:d:e:f:g:ACGT x:y") == "ACGT"
    assert one(spark, S.umi_of_header(F.col("n")), n="@a:b") is None
    assert one(spark, S.umi_of_name(F.col("n")), n="a:b:ACG 1:N:0") == "ACG"


@settings(max_examples=1, deadline=None)
@given(st.lists(st.text("ACGTN", max_size=30), min_size=40, max_size=40))
def test_revcomp_is_an_involution(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    assert df.filter(S.revcomp(S.revcomp(F.col("s"))) != F.col("s")).count() == 0
