"""Operators without SQL, errors that must be raised, readers, and the streaming merge."""

import pytest

from taxarium.operators import catalog, compare, lineage, sequence, strains, taxonomy
from taxarium.sources import ncbi, readers
from taxarium.streaming import merge

MODELS = ("ar", "bac", "euk")


def test_deep_trees_and_cycles(spark):
    chain = spark.createDataFrame([(i, max(i - 1, 0), "species" if i == 7 else "none") for i in range(200)], "node long, parent long, rank string")
    far = {(r["ancestor"], r["depth"]) for r in lineage.walk(chain, "node", "parent").filter("node = 199").collect()}
    assert far == {(199 - d, d) for d in range(200)}
    got = {r["node"]: r["ancestor"] for r in lineage.nearest(chain, "node", "parent", "rank", "species").collect()}
    assert got == dict.fromkeys(range(7, 200), 7)
    ring = spark.createDataFrame([(1, 2, ""), (2, 3, ""), (3, 1, "")], "node long, parent long, rank string")
    for walk in (lambda: lineage.walk(ring, "node", "parent"), lambda: lineage.nearest(ring, "node", "parent", "rank", "species")):
        with pytest.raises(ValueError):
            walk()
    assert lineage.walk(chain.limit(0), "node", "parent").count() == 0


def plain_joined(rows, near):
    """Hits of one sequence by their names, merged as a running dictionary of ``seq``, ``seq-#2``, …"""
    hits = {}
    for start, end, reverse in rows:
        name = lambda i: "s" if i == 1 else f"s-#{i}"
        if "s" not in hits:
            hits["s"] = (start, end, reverse)
            continue
        at, home, joined = 1, 1, False
        while True:
            a, b, r = hits[name(at)]
            if r == reverse and abs(a - end) < near:
                end, joined = b, True
                del hits[name(at)]
                hits[name(home)] = (start, end, reverse)
            elif r == reverse and abs(start - b) < near:
                start, joined = a, True
                del hits[name(at)]
                hits[name(home)] = (start, end, reverse)
            at += 1
            if name(at) in hits:
                home = home if joined else at
            else:
                if not joined:
                    hits[name(at)] = (start, end, reverse)
                break
    return hits


def plain_best(by_model, least, near):
    best = {}
    name = lambda i: "s" if i == 1 else f"s-#{i}"
    for model in MODELS:
        for start, end, _ in plain_joined(by_model.get(model, []), near).values():
            new, at, home, over = (start, end, model), 1, 1, False
            if "s" not in best:
                best["s"] = new
                continue
            while True:
                a, b, m = best[name(at)]
                if (start <= a and end >= a) or (a <= start and b >= start):
                    over = True
                    best[name(home)] = new if end - start > b - a else (a, b, m)
                    if home != at:
                        del best[name(at)]
                at += 1
                if name(at) not in best:
                    break
                home = home if over else at
            if not over:
                best[name(at)] = new
    return {(n, m, a, b) for n, (a, b, m) in best.items() if b - a + 1 >= least}


def test_hits_of_three_models(spark):
    import random

    rng = random.Random(6)
    rows, plain = [], {}
    for seq in range(150):
        for order in range(rng.randint(1, 14)):
            model, start = rng.choice(MODELS), rng.randrange(4000)
            hit = (start, start + rng.randrange(40, 900), rng.random() < 0.5)
            rows.append((seq, model, order, *hit))
            plain.setdefault(seq, {}).setdefault(model, []).append(hit)
    hits = spark.createDataFrame(rows, "seq long, model string, ord long, start long, end long, reverse boolean")
    got = {}
    for r in sequence.best_hits(hits, MODELS, 80).collect():
        got.setdefault(r["seq"], set()).add((r["name"].replace(str(r["seq"]), "s", 1), r["model"], r["start"], r["end"]))
    assert got == {s: w for s, m in plain.items() if (w := plain_best(m, 80, 300))}
    one = sequence.concatenate_hits(hits.filter("model = 'ar'")).collect()
    joined = {s: plain_joined(m["ar"], 300) for s, m in plain.items() if "ar" in m}
    assert sorted((r["seq"], r["slot"], r["start"], r["end"]) for r in one) == sorted((s, int(n.partition("-#")[2] or 1), a, b) for s, h in joined.items() for n, (a, b, _) in h.items())


def test_type_summary(spark):
    genomes = spark.createDataFrame(
        [("a", "d__A;s__Aa albus", 1, ["DSM1"], "none"), ("b", "d__A;s__Aa albus;sb__Aa albus subsp. minor", 1, ["X9"], "none"), ("c", "d__A;s__Cc other", 2, ["DSM2"], "none"), ("d", "d__A;s__Dd none", 3, ["DSM3"], "none"), ("e", "d__A;s__", 3, [], "none"), ("f", "d__A;s__Cc alba", 2, ["DSM2"], "none")],
        "gid string, lineage string, taxid long, ids array<string>, given string",
    )
    classes = spark.createDataFrame([(2, "synonym", "Bb alba"), (3, "misspelling", "Dd nine")], "taxid long, class string, name string")
    repository = spark.createDataFrame([("Aa albus", ["DSM1"], []), ("Aa albus subsp. minor", ["X9"], []), ("Bb alba", ["DSM2"], []), ("Dd none", ["ZZ1"], ["DSM3"])], "name string, strains array<string>, neotypes array<string>")
    types = spark.createDataFrame([("Aa", "Aa albus")], "genus string, species string")
    years = spark.createDataFrame([("Aa albus", 1990)], "name string, year int")
    got = {r["gid"]: (r["designation"], r["sources"], r["is_type_species"], r["priority_year"]) for r in strains.type_table(genomes, classes, {"LPSN": repository, "DSMZ": repository.limit(0)}, years, {"LPSN": types}).collect()}
    assert got == {
        "a": ("type strain of species", "LPSN", True, 1990), "b": ("type strain of subspecies", "LPSN", False, None), "c": ("type strain of heterotypic synonym", "LPSN", False, None),
        "d": ("type strain of neotype", "LPSN", False, None), "f": ("type strain of species", "LPSN", False, None),
    }


def test_errors(spark):
    release = lambda label: spark.createDataFrame([("RS_GCF_1.1", label)], "gid string, label string")
    clusters = spark.createDataFrame([("G1", "G1, G2")], "rep string, members string")
    genomes = spark.createDataFrame([("RS_GCF_1.1",)], "accession string")
    nodes = spark.createDataFrame([("9", "1", "species"), ("1", "1", "no rank")], "tax_id string, parent string, rank string")
    names = spark.createDataFrame([("9", "x"), ("1", "root")], "tax_id string, name string")
    classes = spark.createDataFrame([(1, "synonym", "x"), (1, "scientific name", "x")], "taxid long, class string, name string")
    for wrong in (
        compare.propagate(release("a"), release("b"), "gid", "label"), ncbi.unique_or_error(release("a").union(release("a")), "gid"), catalog.cluster_members(clusters, genomes, "rep", "members"),
        taxonomy.tree_lineages(nodes.filter("tax_id = '9'").select("tax_id"), "tax_id", nodes, names), strains.disjoint_classes(classes),
    ):
        with pytest.raises(Exception, match="USER_RAISED_EXCEPTION|RAISE"):
            wrong.collect()
    with pytest.raises(ValueError):
        ncbi.summary_table(spark, "/root/repo/README.md")


def test_readers(spark, tmp_path):
    (tmp_path / "ids").write_text("# x\na\tb,c\nd,e\nf\n\nd,z\n")
    assert {r["id"] for r in readers.id_list(spark, str(tmp_path / "ids")).collect()} == {"a", "d", "f"}
    (tmp_path / "fa").write_text(">s1 first > second\nAC\nGT\n>s2\nA\n")
    assert {tuple(r) for r in readers.fasta(spark, str(tmp_path / "fa")).collect()} == {("s1", "ACGT"), ("s2", "A")}
    (tmp_path / "paths").write_text("a\t/x\tG1\nb\t/y\n")
    assert {tuple(r) for r in readers.genome_paths(spark, str(tmp_path / "paths")).collect()} == {("a", "/x", "G1"), ("b", "/y", None)}
    for n, head in (("one", ""), ("two", "# a comment\n")):
        (tmp_path / n).write_text(head + "# assembly_accession\ttaxid\nGCF_1.1\t7\n")
        assert [tuple(r) for r in ncbi.tax_ids([ncbi.summary_table(spark, str(tmp_path / n))]).collect()] == [("GCF_1.1", "7")]
    (tmp_path / "names.dmp").write_text("1\t|\told\t|\t\t|\tscientific name\t|\n1\t|\tnew\t|\t\t|\tscientific name\t|\n1\t|\tsyn\t|\t\t|\tsynonym\t|\n")
    assert [tuple(r) for r in ncbi.scientific_names(spark, str(tmp_path / "names.dmp")).collect()] == [("1", "new")]
    folder = tmp_path / "GCF" / "000" / "GCF_000000001.1_ASM1"
    folder.mkdir(parents=True)
    (folder / "GCF_000000001.1_ASM1_assembly_report.txt").write_text("x")
    assert [(r["accession"], r["formatted_id"]) for r in readers.folders(spark, str(tmp_path / "GCF")).collect()] == [("GCF_000000001.1", "G000000001")]


def test_streaming_merge(spark, tmp_path):
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL("gid string, v long, ord long")
    source, target, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    run = lambda: merge.merge_files(spark, source, schema, target, "gid", "ord", check).awaitTermination()
    spark.createDataFrame([("a", 1, 0), ("a", 2, 1), ("b", 3, 0)], schema).write.mode("append").parquet(source)
    run()
    spark.createDataFrame([("b", 9, 5), ("c", 4, 0)], schema).write.mode("append").parquet(source)
    run()
    assert {(r["gid"], r["v"]) for r in merge.current(spark, target).collect()} == {("a", 2), ("b", 9), ("c", 4)}


def test_overview_and_columns(spark):
    old = spark.createDataFrame([("a", "na", "none"), ("U_1", "x", "1")], "gid string, note string, ncbi_cds_count string")
    new = spark.createDataFrame([("a", "n/a", "0"), ("U_1", "y", "2")], "gid string, note string, ncbi_cds_count string")
    assert {tuple(r) for r in compare.release_overview(old, new, "gid").collect()} == {("note", 0.0, 1), ("ncbi_cds_count", 0.0, 1)}
    assert [r["taxon"] for r in taxonomy.sort_taxa(spark.createDataFrame([("p__B",), ("d__Z",), ("p__A",)], "taxon string"), "taxon", reverse=True).collect()] == ["p__B", "p__A", "d__Z"]
    empty = spark.createDataFrame([], "id string")
    rows = spark.createDataFrame([("a",)], "gid string")
    assert (catalog.listed(rows, "gid", empty).count(), catalog.listed(rows, "gid", empty, empty_is_all=False).count(), catalog.listed(rows, "gid", None).count()) == (1, 0, 1)
