"""Readers, names, filters, reshaping, search and annotation on small exact inputs."""

import random

import pytest
from pyspark.sql import functions as F

from plexlake.functions import scalars as s
from plexlake.operators import annotate, checks, clean, meta, normalize, qc, reshape, search
from plexlake.plans.sizing import Extent
from plexlake.sources import columns, tables
from plexlake.sources.fasta import read_fasta


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


@pytest.mark.parametrize("name,expected", [
    ("Intensity plex1 : TMT10-127N", "intensity_plex1_tmt10_127n"), ("Intensity TMTset1 126", "intensity_tm_tset1_126"),
    ("Phospho (STY) Probabilities", "phospho_sty_probabilities"), ("Majority protein IDs", "majority_protein_i_ds"),
    ("PEP", "pep"), ("% share", "percent_share"), ("16 channel", "x16_channel"),
])
def test_snake_case(name, expected):
    assert columns.snake_case(name) == expected


def test_reporter_rename_is_plex_major_and_strict(spark):
    names = [f"Reporter intensity corrected {i}" for i in range(20)]
    df = spark.createDataFrame([tuple(float(i) for i in range(20))], names)
    renamed = columns.rename_reporters(df, "tmt10", 2).columns
    assert renamed[0] == "Intensity plex1 : TMT10-126" and renamed[9] == "Intensity plex1 : TMT10-131N"
    assert renamed[10] == "Intensity plex2 : TMT10-126"
    with pytest.raises(ValueError, match="needs 30"):
        columns.rename_reporters(df, "tmt10", 3)


def test_clean_columns_numbers_duplicates_and_drops_combined(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], ["Intensity TMTset1 126", "intensity tmtset3 126", "a;b", "Intensity (x)"])
    df = columns.drop_combined(df)
    assert columns.clean_columns(df).columns == ["plex1_126", "tmtset3_126"]
    twice = spark.createDataFrame([(1, 2)], ["Gene names", "Gene  names"])
    assert columns.clean_columns(twice).columns == ["gene_names", "gene_names_2"]


def test_csv_reader_casts_only_numbers(spark, tmp_path):
    path = tmp_path / "proteins.csv"
    path.write_text('Protein Group,Accession,Intensity a.b,Description\n1,"P1|X_MOUSE",12.5,"a, ""b"""\n2,P2,n/a,c\n')
    got = rows(tables.read_csv(spark, str(path)), "Protein Group")
    assert got == [("1", "P1|X_MOUSE", 12.5, 'a, "b"'), ("2", "P2", None, "c")]


def test_unquoted_tsv(spark, tmp_path):
    path = tmp_path / "sites.txt"
    path.write_text('Protein\tIntensity\tName\nP1\t0\t5"-end\nP2\t3\t"x\n')
    assert rows(tables.read_tsv(spark, str(path), quote="")) == [("P1", 0.0, '5"-end'), ("P2", 3.0, '"x')]


def test_fasta_records(spark, tmp_path):
    path = tmp_path / "db.fasta"
    path.write_bytes(
        b">sp|P12345|ALBU_MOUSE Serum albumin OS=Mus musculus GN=Alb PE=1\r\nMKWV\r\nTFIS\r\n"
        b">sp|P1234|NOGN_MOUSE No gene OS=Mus musculus PE=1\nAAAA\n>sp|Q9|LAST_MOUSE Last>one OS=Mus GN=Lst\nCCC"
    )
    got = rows(read_fasta(spark, str(path)).select("accession", "gene_name", "description", "sequence", "fasta_ord"), "fasta_ord")
    assert [g[0] for g in got] == ["P12345", "P1234", "Q9"]
    assert got[0][1:4] == ("Alb", "Serum albumin", "MKWVTFIS")
    assert got[1][1].startswith(">sp|P1234") and got[1][2:4] == ("No gene", "AAAA")
    assert got[2][2:4] == ("Last>one", "CCC")


def test_scalar_functions(spark):
    df = spark.createDataFrame([("P1|A_MOUSE|x", "AAK (+79.97)LR(+15.99)", "plex12_tmt16_134n", "Group1", None)],
                               "a string, p string, n string, g string, z string")
    got = df.select(
        s.accession_head(F.col("a")), s.accession_tail(F.col("a")), s.before_last(F.col("a")), s.before_last(F.lit("one")),
        s.strip_modifications(F.col("p")), s.tag_count(F.col("p")), s.plex_of(F.col("n")), s.channel_of(F.col("n")),
        s.sample_or_pool(F.col("g")), s.sample_or_pool(F.lit("group1"), strict=True), s.sample_or_pool(F.col("z")),
        s.is_flagged(F.col("z")), s.sheet_sample_number(F.lit(3)), s.sheet_sample_number(F.lit("POOL2")),
        s.readable_label(F.lit("Ct"), F.lit("sample_12")), s.readable_label(F.lit("Ct"), F.lit("POOL1"), "."),
    ).first()
    assert tuple(got) == ("P1", "A_MOUSE|x", "A_MOUSE", None, "AAKLR", 1, "plex12", "134n", "sample", None, None,
                          False, "sample_3", "POOL2", "Ct_12", "Ct.POOL1")


def test_flags_and_contaminants(spark):
    df = spark.createDataFrame([("P1;P2", "+", None), ("P3|X", "", ""), ("P4", None, "+"), ("P5:Q", None, None)],
                               "accession string, reverse string, potential_contaminant string")
    kept = clean.drop_flagged(df, ["reverse", "potential_contaminant"])
    assert kept.columns == ["accession"] and rows(kept) == [("P3|X",), ("P5:Q",)]
    listed = spark.createDataFrame([("X",), ("P",)], ["accession"])
    assert rows(clean.remove_contaminants(kept, listed)) == [("P5:Q",)]


def test_all_missing_and_localisation(spark):
    wide = spark.createDataFrame([("a", None, 1.0, 0.5), ("b", None, None, 0.9), ("c", 2.0, None, None), ("d", 1.0, 1.0, 0.49)],
                                 "f string, x double, y double, localization_prob double")
    assert [r[0] for r in rows(clean.drop_all_missing(wide, ["x", "y"]))] == ["a", "c", "d"]
    assert [r[0] for r in rows(clean.confident_sites(wide))] == ["a", "b"]


def test_channel_map_and_sheet(spark, tmp_path):
    (tmp_path / "map.csv").write_text(",126,127N\nplex1,1,POOL1\nplex2,2,\n")
    (tmp_path / "sheet.csv").write_text("Sample name,Group name,Experimental group\n1,group1,Control lung\nPOOL1,POOL,POOL\n3,group1,x\n")
    channels = meta.channel_rows(tables.read_channel_map(spark, str(tmp_path / "map.csv")), "tmt16")
    assert rows(channels) == [("POOL1", "plex1_tmt16_127n"), ("sample_1", "plex1_tmt16_126"), ("sample_2", "plex2_tmt16_126")]
    sheet = meta.sample_sheet(tables.read_sample_sheet(spark, str(tmp_path / "sheet.csv")))
    assert rows(meta.sample_metadata(channels, sheet)) == [
        ("POOL1", "plex1_tmt16_127n", "POOL", "POOL"), ("sample_1", "plex1_tmt16_126", "group1", "Control lung")]


def test_multiplicity_and_densify(spark):
    wide = spark.createDataFrame([("P", 1.0, None, 3.0)], "protein string, reporter_intensity_corrected_10_plex1_1 double, "
                                 "reporter_intensity_corrected_10_plex1_2 double, reporter_intensity_corrected_2_plex12_3 double")
    assert rows(reshape.multiplicity_rows(wide)) == [
        ("P", "reporter_intensity_corrected_10_plex1", "___1", 1.0), ("P", "reporter_intensity_corrected_10_plex1", "___2", None),
        ("P", "reporter_intensity_corrected_2_plex12", "___3", 3.0)]
    cells = spark.createDataFrame([("f", "a", 1.0), ("f", "c", None), ("g", "b", 2.0)], "protein_group string, sample_name string, v double")
    grid = rows(reshape.densify(cells, ["a", "b", "c"], "v"))
    assert grid == [("f", "a", 1.0), ("f", "b", None), ("f", "c", None), ("g", "a", None), ("g", "b", 2.0), ("g", "c", None)]


def test_null_rules_of_flags(spark):
    long = spark.createDataFrame([("f", "a", 1.0), ("g", "a", 3.0), ("h", "a", 3.0), ("i", "a", None), ("f", "b", None), ("g", "b", None)],
                                 "protein_group string, sample_name string, intens double")
    size = Extent(2, 4)
    flags = {(r[0], r[1]): r["is_max"] for r in qc.flag_maximum(long, extent=size).select("protein_group", "sample_name", "is_max").collect()}
    assert flags == {("f", "a"): "NO", ("g", "a"): "YES", ("h", "a"): "YES", ("i", "a"): None, ("f", "b"): None, ("g", "b"): None}
    medians = qc.sample_medians(long, extent=size)
    assert rows(medians) == [("a", 3.0), ("b", None)]
    assert {r["high"] for r in qc.flag_high_medians(medians).collect()} == {None}
    known = spark.createDataFrame([("a", 1.0), ("b", 4.0), ("c", 1.0)], "sample_name string, MED double")
    assert [r[2] for r in rows(qc.flag_high_medians(known))] == ["NO", "YES", "NO"]


def test_median_normalisation_invariant_and_imputation(spark):
    rng = random.Random(1)
    data = [(f"f{i}", sm, g, None if rng.random() < 0.2 else rng.gauss(10 + 3 * k, 1))
            for i in range(31) for k, (sm, g) in enumerate([("a", "x"), ("b", "x"), ("c", "y")])]
    long = spark.createDataFrame(data, "protein_group string, sample_name string, exp_group string, intens double")
    out = normalize.median_normalise(long)
    common = qc.global_median(long).first()[0]
    for r in qc.sample_medians(out, "normalized_intensity").collect():
        assert r["MED"] == pytest.approx(common)
    filled = normalize.impute(long, "intens", "sample_floor", quantile=0.0)
    lowest = {r[0]: r[1] for r in long.groupBy("sample_name").agg(F.min("intens")).collect()}
    before = {(r[0], r[1]): r["intens"] for r in long.collect()}
    for r in filled.collect():
        was = before[r["protein_group"], r["sample_name"]]
        assert r["intens"] == (lowest[r["sample_name"]] if was is None else was)
    with pytest.raises(ValueError):
        normalize.impute(long, "intens", "guess")


@pytest.mark.parametrize("limit", [10_000, 0])
def test_sequence_search_equals_brute_force(spark, limit):
    rng = random.Random(7)
    letters = "ACDEFGHIKLMNPQRSTVWY"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 400))) for _ in range(60)]
    texts += ["AAAAAAAAAAAAAAAA" * 4] * 20 + ["ünïcødé \U0001f600 text " * 3, ""]  # a third of hot copies
    queries = ["A", "AC", "AAAAAA", "AAAAAAAAAAAAA", "ünïc", "\U0001f600 t", "nothing like this", ""]
    for t in texts[:40]:
        if len(t) > 50:
            start, size = rng.randrange(len(t) - 50), rng.choice([3, 5, 7, 12, 13, 31, 32, 50])
            queries.append(t[start : start + size])
    q = spark.createDataFrame([(x,) for x in queries], "q string")
    t = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    got = {tuple(r) for r in search.contains_pairs(q, "q", t, "t", "id", limit).collect()}
    want = {(x, i) for x in set(queries) if x for i, text in enumerate(texts) if x in text}
    assert got == want
    first = {r["q"]: (r["id"], r["n_matches"]) for r in search.first_match(search.contains_pairs(q, "q", t, "t", "id", limit), "q", "id").collect()}
    assert first == {x: (min(i for y, i in want if y == x), sum(y == x for y, _ in want)) for x in {y for y, _ in want}}


def test_fill_and_lookup_accessions(spark):
    fasta = spark.createDataFrame([("P12345", "MKAAKLRW", "G1", "one", 0), ("P1234", "AAKLRAAKLR", "G2", "two", 1)],
                                  "accession string, sequence string, gene_name string, description string, fasta_ord long")
    peptides = spark.createDataFrame([("AAKLR", ""), ("AAKLRA", None), ("ZZZ", ""), ("AAKLR", "Q1|X")], "peptide_seq string, accession string")
    assert sorted(rows(search.fill_accessions(peptides, fasta)), key=str) == sorted(
        [("AAKLR", "P12345"), ("AAKLRA", "P1234"), ("ZZZ", None), ("AAKLR", "Q1|X")], key=str)
    keys = spark.createDataFrame([("P1234",), ("P1234",), ("P9",)], ["good_accession"])
    assert rows(search.lookup_accessions(keys, fasta)) == [("P1234", "G2", "two"), ("P9", None, None)]
    assert rows(search.lookup_accessions(keys, fasta, mode="contains")) == [("P1234", "G1", "one"), ("P9", None, None)]


def test_concatenation_keeps_order_and_duplicates(spark):
    data = [(1 if i % 3 else 2, i * 997, f"t{i % 5}" if i % 7 else None) for i in range(200)]
    random.Random(3).shuffle(data)
    df = spark.createDataFrame(data, "k int, ord long, x string")
    got = {r["k"]: r["x"] for r in annotate.concat_annotation(df, "k", ["x"], "ord").collect()}
    for k in (1, 2):
        assert got[k] == ";".join(x or "NA" for kk, _, x in sorted(data, key=lambda r: r[1]) if kk == k)


def test_group_join_is_m_by_n_and_reported(spark):
    df = spark.createDataFrame([("g", "a", 1.0), ("g", "b", 1.0), ("g", "c", 2.0), ("h", "d", 3.0)], "f string, x string, v double")
    values = annotate.collapse_redundant(df, "f", ["v"])
    joined = annotate.join_groups(df.select("f", "x"), values, "f")
    assert joined.where("f = 'g'").count() == 6
    assert rows(checks.ambiguous_groups(df.select("f", "x"), values, "f")) == [("g", 3, 2)]
    assert rows(checks.key_is_unique(df, "f")) == [(4, 2, False)]
    assert rows(checks.duplicate_keys(df, ["f"])) == [("g", 3)]


def test_rows_of_the_wrong_width_end_a_strict_read(spark, tmp_path):
    (tmp_path / "t.tsv").write_text("a\tb\tIntensity x\n1\t2\t3\n4\t5\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        tables.read_tsv(spark, str(tmp_path / "t.tsv")).collect()
    assert tables.read_tsv(spark, str(tmp_path / "t.tsv"), strict=False).count() == 2
    (tmp_path / "t.csv").write_text('a,b\n"x\ny",2\n')
    assert [r["a"] for r in tables.read_csv(spark, str(tmp_path / "t.csv"), multi_line=True).collect()] == ["x\ny"]


def test_records_are_ordered_by_file_whatever_their_sizes(spark, tmp_path):
    (tmp_path / "a.fasta").write_text(">sp|A|X d OS=Mus\nAA\n")
    (tmp_path / "b.fasta").write_text("".join(f">sp|B{i}|X d OS=Mus\nCC\n" for i in range(2000)))
    first = read_fasta(spark, str(tmp_path)).orderBy("fasta_ord").select("accession").head(3)
    assert [r["accession"].split("|")[0] for r in first] == ["A", "B0", "B1"]


def test_one_anchor_in_every_text(spark):
    """All texts and queries share one stretch: both ways of meeting find what brute force finds."""
    shared = "ACDEFGHIKLMNPQRSTVWY"
    texts = [(i, f"{shared}{'K' * (i % 3)}W{i}") for i in range(60)]
    queries = [(shared,), (shared + "KW",), (shared + "KKW",), ("WWWWWW",)]
    t, q = spark.createDataFrame(texts, "id long, t string"), spark.createDataFrame(queries, "q string")
    want = {x: min((i for i, b in texts if x in b), default=None) for (x,) in queries}
    for limit in (100, 0):
        got = {r["q"]: r["id"] for r in search.first_containing(q, "q", t, "t", "id", limit).collect()}
        assert got == {x: i for x, i in want.items() if i is not None}
        assert search.contains_pairs(q, "q", t, "t", "id", limit).count() == sum(x in b for (x,) in queries for _, b in texts)
