"""Report parsers on small files."""

from taxarium.sources import reports, sinks


def put(tmp_path, name, text):
    (tmp_path / name).write_text(text)
    return f"file://{tmp_path / name}"


def one(df):
    rows = [r.asDict() for r in df.drop("file", "pos").collect()]
    return rows


def test_assembly_report(spark, tmp_path):
    text = "# Assembly Statistics Report\n# Organism name:  Aa bb (bacteria)\n# Taxid: 7\n# Other: x\n## Statistic Types:\n# total-length\tall\nSequence-type Description\nall\tall\tall\tall\ttotal-length\t99\nall\tall\tx\ty\ttotal-length\t1\n"
    got = one(reports.assembly_report(reports.numbered_lines(spark, put(tmp_path, "a", text)), ["Organism name", "Taxid", "Date"], ["total-length", "gaps"]))
    assert got == [{"Organism name": "Aa bb", "Taxid": "7", "Date": "", "total-length": "99", "gaps": ""}]


def test_nucleotide_hits(spark, tmp_path):
    block = "# x\n>> s1  whole\n head\n ---\n 1 ! 9 1e-9 a b c 50 10 x\n 2 ! 9 1.0 a b c 5 10 x\n\n 3 ! 9 1e-9 a b c 1 2 x\n>> s2\n h\n -\n 1 ! 9 1e-6 a b c 3 8 x\n"
    got = one(reports.nucleotide_hits(reports.numbered_lines(spark, put(tmp_path, "n", block)), "bac").orderBy("seq_id"))
    assert got == [
        {"seq_id": "s1", "domain": "bac", "evalue": "1e-9", "start": 10, "end": 50, "length": 41, "reverse": True},
        {"seq_id": "s2", "domain": "bac", "evalue": "1e-6", "start": 3, "end": 8, "length": 6, "reverse": False},
    ]


def test_transfer_rna_and_table(spark, tmp_path):
    text = "Ala   : 9\ntRNAs decoding Standard 20 AA:  40\nSelenocysteine tRNAs (TCA):  1\nIsotype / Anticodon Counts:\nAla   : 2\t AGC: 1\nGly   : 0\t\nSelCys : 1\n  /transl_table=11\n /transl_table=4\n"
    lines = reports.numbered_lines(spark, put(tmp_path, "t", text))
    assert one(reports.transfer_rna_counts(lines)) == [{"trna_count": 41, "trna_aa_count": 1, "trna_selenocysteine_count": 1}]
    assert one(reports.translation_table(lines)) == [{"translation_table": "11"}]


def test_categories(spark):
    rows = [(1, "x single cell"), (1, "/metagenome_source=a"), (2, "a metagenome"), (3, "/environmental_sample"), (4, None)]
    got = reports.line_categories(spark.createDataFrame(rows, "gid long, line string"), "gid").collect()
    assert sorted(map(tuple, got)) == [(1, "derived from metagenome"), (3, "derived from environmental sample")]


def test_tree(spark, tmp_path):
    tree = "((a_1:0.1,'b x':2)'0.9:g__G; s__s':1,(c:1)0.5:2,d)d__D__p__P;"
    got = {r.leaf: r.taxa for r in reports.tree_lineages(spark, put(tmp_path, "w", tree)).collect()}
    assert got["d"] == ["d__D", "p__P", "c__", "o__", "f__", "g__", "s__"] == got["c"]
    assert got["a_1"] == got["b x"] and got["a_1"][:4] == ["d__D", "p__P", "g__G", "s__s"]


def test_folders_and_json(spark, tmp_path):
    folder = tmp_path / "GCA" / "000" / "001" / "002" / "GCA_000001002.1_ASM"
    folder.mkdir(parents=True)
    (folder / "x_genomic.fna").write_text("A")
    (folder / "x_cds_from_genomic.fna").write_text("A")
    got = reports.genome_folders(spark, f"file://{tmp_path}").collect()
    assert [r.accession for r in got] == ["GCA_000001002.1"]
    assert {r.kind for r in reports.file_hashes(spark, f"file://{tmp_path}").collect()} == {"fasta", "extra_fasta"}
    path = put(tmp_path, "j.json", '[{"b": ["x", "y"], "label": "l"}, {"a": 1}]')
    df = reports.json_rows(spark, path)
    assert df.columns == ["label", "a", "b"] and df.first().asDict() == {"label": "l", "a": None, "b": "x||y"}
    page = put(tmp_path, "p.json", '{"next": null, "results": [{"g": "A"}, {"g": "B"}]}')
    assert [r.g for r in reports.json_pages(spark, page).collect()] == ["A", "B"]


def test_tables(spark):
    df = spark.createDataFrame([(2, "b"), (1, None)], "n int, t string")
    assert sinks.text_table(df, 5, ["n"]).split("\n")[3] == "| 1 | None |"
    assert sinks.schema_description(df, {"n": "number"}) == [("n", "number", "INT"), ("t", "", "STR")]
    assert "<td>b</td>" in sinks.html_table(df, 5)
