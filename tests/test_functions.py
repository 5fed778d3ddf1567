from pyspark.sql import functions as F

from taxarium.functions import ids, names
from taxarium.operators import lineage


def one(spark, text, expr):
    return spark.createDataFrame([(text,)], "x string").select(expr(F.col("x"))).first()[0]


def test_canonical_ids(spark):
    for text in ("G005435135", "GCF_005435135.1", "GCF_005435135.1_ASM543513v1_genomic", "RS_GCF_005435135.1", "GB_GCA_005435135.1"):
        assert one(spark, text, ids.canonical_id) == "G005435135"
    assert one(spark, "U_1234.5", ids.canonical_id) == "U_1234.5"


def test_names(spark):
    assert one(spark, "[Eubacterium] siraeum 70/3", ids.without_brackets) == "Eubacterium siraeum 70/3"
    assert one(spark, "Holospora (ex Hafkine 1890) Gromov and Ossipov 1981", names.priority_year) == 1981
    assert one(spark, "s__Bacillus subtilis", names.species_validity) is None
    assert one(spark, "s__Bacillus sp. 1", names.species_validity) is not None
    assert one(spark, "albus", lambda c: names.same_epithet(c, F.lit("alba")))
    assert not one(spark, "albus", lambda c: names.same_epithet(c, F.lit("nigra")))


def test_lineage(spark):
    fill = lambda c: F.concat_ws(";", lineage.fill_missing(lineage.parse(c)))
    assert one(spark, "d__A; g__B;", fill) == "d__A;p__;c__;o__;f__;g__B;s__"
    rows = spark.createDataFrame([("p__A",), ("d__Bacteria;f__B",)], "line string").withColumn("t", lineage.parse(F.col("line")))
    assert [r["t"] for r in lineage.standardise(rows, "t").collect()] == [["d__Bacteria", "p__", "c__", "o__", "f__B", "g__", "s__"]]
