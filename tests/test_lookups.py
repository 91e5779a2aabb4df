"""Lookups on small cases: errors, ties, nulls and empty tables."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from strandforge.plans import lookups


def test_gene_class_term(spark):
    rows = spark.createDataFrame([("RNA, ribosomal", ["12S RNA", "5S ribosomal RNAs"]), ("RNA, ribosomal", None), ("RNA, Y", ["12S RNA"])], "t string, g array<string>")
    term = lookups.gene_class_term(F.col("t"), F.col("g")).alias("x")
    assert [r.x for r in rows.select(term).collect()] == ["SO:0000652", "SO:0000252", "SO:0000405"]
    for bad in ("protein", None):
        with pytest.raises(Exception, match="unknown class"):
            spark.createDataFrame([(bad, [])], "t string, g array<string>").select(term).collect()


def test_remove_array_element(spark):
    rows = spark.createDataFrame([(["a", "b", None],), (["a"],), (["b"],), ([],), (None,)], "v array<string>")
    cut = lookups.remove_array_element(F.col("v"), F.lit("b")).alias("x")
    assert [r.x for r in rows.select(cut).collect()] == [["a", None], None, [], None, None]
    with pytest.raises(Exception, match="more than one"):
        spark.createDataFrame([(["b", "b"],)], "v array<string>").select(cut).collect()


def test_longest_by_alias(spark):
    rows = spark.createDataFrame([("u2", 9, "x", "x"), ("u1", 9, "y", "x"), ("u3", 4, "y", None), ("u4", 1, None, None)], "upi string, len int, a string, b string")
    assert sorted(tuple(r) for r in lookups.longest_by_alias(rows, ["a", "b"]).collect()) == [("x", "u1"), ("y", "u1")]
    assert lookups.longest_by_alias(rows.limit(0), ["a", "b"]).count() == 0


def test_mirtron_relations(spark):
    rows = spark.createDataFrame([("m1", "precursor", "AACGTT"), ("m1-5p", "mature", "ACG"), ("m1-3p", "mature", "GGG"), ("m2-3p", "mature", "A")], "accession string, kind string, sequence string")
    got = {(r.accession, r.related): (r.relationship, r.start, r.stop) for r in lookups.mirtron_relations(rows).collect()}
    assert got == {
        ("m1", "m1-5p"): ("mature_product", 1, 4), ("m1-5p", "m1"): ("precursor", None, None), ("m1", "m1-3p"): ("mature_product", None, None),
        ("m1-3p", "m1"): ("precursor", None, None), ("m2-3p", "m2"): (None, None, None),
    }
    with pytest.raises(Exception, match="duplicate accession: m1"):
        lookups.mirtron_relations(rows.union(rows.where("accession = 'm1'"))).collect()


def test_weekly_report(spark):
    rows = [(1, "N", datetime(2024, 1, 2), 9), (1, "N", datetime(2024, 1, 1), 9), (1, "Y", datetime(2024, 1, 5), 9), (2, "N", datetime(2024, 1, 5), None)]
    xref = spark.createDataFrame(rows, "dbid int, deleted string, timestamp timestamp, taxid int")
    names = spark.createDataFrame([(1, "B"), (2, "A")], "id int, display_name string")
    assert [tuple(r) for r in lookups.weekly_report(xref, names, datetime(2024, 1, 8)).collect()] == [("A", 0), ("B", 1)]


def test_merge_and_copy(spark, tmp_path):
    a = spark.createDataFrame([("b", 'x "y", z'), ("a", None), ("a", "")], "k string, v string")
    b = spark.createDataFrame([("a", ""), ("c", " s ")], "k string, v string")
    merged = lookups.merge_sorted(a, b)
    assert [tuple(r) for r in merged.collect()] == [("a", None), ("a", ""), ("b", 'x "y", z'), ("c", " s ")]
    lookups.write_copy(merged.coalesce(1), str(tmp_path / "out"))
    lines = next((tmp_path / "out").glob("part*")).read_text().splitlines()
    assert lines[0] == "k,v" and sorted(lines[1:]) == ["a,", 'a,""', 'b,"x ""y"", z"', "c, s "]


def test_hgnc_fix(spark):
    rows = [(1, "hgnc", "a", "x"), (1, "RefSeq", "b", None), (2, "hgnc", "a", "x"), (2, "refseq", "b", "y"), (2, "refseq", "c", "z"), (3, "hgnc", "a", "x")]
    df = spark.createDataFrame(rows, "upi int, database string, feature_name string, ncrna_class string")
    want = [(1, "hgnc", "b", None) if r == rows[0] else r for r in rows]
    assert sorted(map(str, (tuple(r) for r in lookups.hgnc_fix(df, ["upi"]).collect()))) == sorted(map(str, want))
