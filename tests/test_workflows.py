"""The three entries end to end on generated export files with planted effects."""

import math
import random

import pytest
from pyspark.sql import functions as F

from plexlake.operators import batch, meta, model
from plexlake.plans import workflows as w
from plexlake.sources.columns import CHANNELS
from plexlake.sources.fasta import read_fasta

LETTERS = "ACDEFGHIKLMNPQRSTVWY"
KIT = "tmt6"


def value(rng, base, plex, channel, effect):
    """log-normal intensity: group by channel, plex 2 is shifted."""
    group_shift = effect if channel in (0, 1) else 0.0
    return round(2 ** (base + rng.gauss(0, 0.2) + group_shift + (1.0 if plex == 2 else 0.0)), 3)


def write_metadata(folder):
    """Channels 0-1 group one, 2-3 group two, 4 group three, 5 pool; two plexes."""
    number, cells, sheet = 0, {1: [], 2: []}, ["Sample name,Group name,Experimental group"]
    groups = ["Ct old", "Ct old", "KO old", "KO old", "WT"]
    for plex in (1, 2):
        for c in range(5):
            number += 1
            cells[plex].append(str(number))
            sheet.append(f"{number},group{c // 2 + 1},{groups[c]}")
        cells[plex].append(f"POOL{plex}")
        sheet.append(f"POOL{plex},POOL,POOL")
    header = "," + ",".join(CHANNELS[KIT])
    (folder / "map.csv").write_text("\n".join([header, *[f"plex{p}," + ",".join(cells[p]) for p in (1, 2)]]) + "\n")
    (folder / "sheet.csv").write_text("\n".join(sheet) + "\n")


def check_results(out, planted, n_features):
    overall = {r["protein_group"]: r for r in out["overall"].collect()}
    assert len(overall) == n_features
    best = sorted(overall, key=lambda f: overall[f]["p_value"])[: len(planted)]
    assert set(best) == set(planted)
    names = [r["contrast"] for r in out["contrasts"].select("contrast").distinct().collect()]
    per = out["by_contrast"].groupBy("contrast").count().collect()
    assert {r["contrast"] for r in per} == set(names) and {r["count"] for r in per} == {n_features}
    boxes = [r["median"] for r in out["boxes_normalised"].collect()]
    assert max(boxes) - min(boxes) < 0.5
    components = {r["component"]: r for r in out["pca_components"].collect()}
    assert sum(r["eigenvalue"] for r in components.values()) == pytest.approx(components[1]["n_features"])
    assert out["neighbours"].where("neighbour = 1 AND sample_a = sample_b").count() == out["neighbours"].where("neighbour = 1").count()
    assert out["heat_map"].select("protein_group").distinct().count() >= len(planted)


def test_protein_groups_tsv(spark, tmp_path):
    rng = random.Random(1)
    write_metadata(tmp_path)
    reporters = [f"Reporter intensity corrected {i} p{p}" for p in (1, 2) for i in range(1, 7)]
    lines = ["\t".join(["Protein IDs", "Majority protein IDs", "Protein names", "Gene names", *reporters, "Reverse", "Potential contaminant", "Only identified by site"])]
    for f in range(60):
        base = rng.uniform(15, 25)
        effect = 3.0 if f < 4 else 0.0
        values = [value(rng, base, p, c, effect) for p in (1, 2) for c in range(6)]
        if f == 50:
            values[3] = 0
        if f == 51:
            values = [0] * 12
        flags = ["+" if f == 52 else "", "+" if f == 53 else "", "+" if f == 54 else ""]
        lines.append("\t".join([f"all{f}", f"P{f};Q{f}", f"name {f}", f"G{f}", *map(str, values), *flags]))
    path = tmp_path / "proteinGroups.txt"
    path.write_text("\n".join(lines) + "\n")

    features = w.protein_groups_tsv(spark, str(path), KIT, 2)
    assert features.samples[0] == "plex1_tmt6_126" and features.wide.count() == 57
    meta = w.sample_metadata(spark, str(tmp_path / "map.csv"), str(tmp_path / "sheet.csv"), KIT)
    contrasts = {**model.versus_rest("Ct_old", ["Ct_old", "KO_old", "WT", "POOL"]), "KO vs. WT": {"KO_old": 1.0, "WT": -1.0}}
    out = w.quantify(features, meta, w.Settings(max_missing=0.0, batch="pool", renormalise=True, contrasts=contrasts))
    # 57 left after flags; one incomplete and one empty feature fail the share of 0
    check_results(out, [f"P{f};Q{f}" for f in range(4)], 55)
    missing = {r["n_missing"]: r["n_features"] for r in out["missing_histogram"].collect()}
    assert missing == {0: 55, 1: 1, 12: 1}
    assert out["overall"].columns[:3] == ["protein_group", "protein_names", "gene_names"]
    completeness = {r["sample_name"]: r["completeness"] for r in out["completeness"].collect()}
    assert completeness["plex1_tmt6_126"] == pytest.approx(100 * 56 / 57)
    assert completeness["plex1_tmt6_129n"] == pytest.approx(100 * 55 / 57)
    assert len(out["expression_matrix"].columns) == 13
    w.write_results(out, str(tmp_path / "results"))
    read = spark.read.option("sep", "\t").option("header", True)
    assert read.csv(str(tmp_path / "results/readable_matrix")).count() == 55
    assert read.csv(str(tmp_path / "results/check_samples_on_one_side")).count() == out["check_samples_on_one_side"].count()
    valued = spark.read.parquet(str(tmp_path / "results/by_contrast_with_values"))
    assert valued.count() == 2 * 55 and {"b", "adj_p_value", *out["readable_matrix"].columns} <= set(valued.columns)
    back = spark.read.parquet(str(tmp_path / "results/by_contrast"))
    assert back.groupBy("contrast").count().count() == 2
    assert spark.read.option("sep", "\t").option("header", True).csv(str(tmp_path / "results/overall")).count() == 55


def test_protein_groups_csv(spark, tmp_path):
    rng = random.Random(2)
    write_metadata(tmp_path)
    names = [f"Intensity plex{p} {KIT}-{c.upper()}" for p in (1, 2) for c in CHANNELS[KIT]]
    lines = [",".join(["Protein Group", "Protein ID", "Accession", *names, "Intensity plex1;plex2", "Intensity (all)", "Description"])]
    rows = {}
    for f in range(40):
        base = rng.uniform(15, 25)
        rows[f] = [str(value(rng, base, p, c, 3.0 if f < 3 else 0.0)) for p in (1, 2) for c in range(6)]
        lines.append(",".join([str(f), "1", f"A{f}|N{f}_MOUSE", *rows[f], "5", "6", f"protein {f}"]))
        if f % 10 == 0:  # the same group again, same intensities
            lines.append(",".join([str(f), "2", f"B{f}|M{f}_MOUSE", *rows[f], "5", "6", f"again {f}"]))
    lines.append(",".join(["99", "1", "CONT1|X_MOUSE", *rows[1], "5", "6", "keratin"]))
    path = tmp_path / "proteins.csv"
    path.write_text("\n".join(lines) + "\n")
    contaminants = spark.createDataFrame([("CONT1",)], ["accession"])
    features = w.protein_groups_csv(spark, str(path), contaminants)
    ten = features.annotation.where("protein_group = '10'").first()
    assert (ten["accession"], ten["description"]) == ("A10;B10", "protein 10;again 10")
    meta = w.sample_metadata(spark, str(tmp_path / "map.csv"), str(tmp_path / "sheet.csv"), KIT)
    out = w.quantify(features, meta, w.Settings(keep_pools=False, reversed_contrasts=["KO_old_vs_WT"]))
    check_results(out, ["0", "1", "2"], 40)
    names = {r["contrast"] for r in out["contrasts"].collect()}
    assert names == {"Ct_old_vs_KO_old", "Ct_old_vs_WT", "WT_vs_KO_old"}


def test_modified_peptides(spark, tmp_path):
    rng = random.Random(3)
    write_metadata(tmp_path)
    proteins = ["".join(rng.choice(LETTERS) for _ in range(120)) for _ in range(12)]
    fasta = "".join(f">sp|S{i}|N{i}_MOUSE Protein {i} OS=Mus musculus GN=Gn{i} PE=1\n{p[:60]}\n{p[60:]}\n" for i, p in enumerate(proteins))
    (tmp_path / "db.fasta").write_text(fasta)
    (tmp_path / "cont.fasta").write_text(">sp|S11|X_MOUSE Keratin OS=Mus\nAAA\n")
    names = [f"Intensity TMTset{p} {KIT}-{c.upper()}" for p in (1, 2) for c in CHANNELS[KIT]]
    lines = [",".join(["Peptide", "Accession", *names])]
    planted = []
    for i, protein in enumerate(proteins):
        for start in (0, 20, 55, 90):
            seq = protein[start : start + 12]
            peptide = seq[:4] + "(+79.97)" + seq[4:]
            if i == 0:
                planted.append(peptide)
            accession = "" if start == 55 else f"S{i}|N{i}_MOUSE"
            base = rng.uniform(15, 25)
            values = [value(rng, base, p, c, 3.0 if i == 0 else 0.0) for p in (1, 2) for c in range(6)]
            lines.append(",".join([peptide, accession, *map(str, values)]))
    path = tmp_path / "peptides.csv"
    path.write_text("\n".join(lines) + "\n")
    contaminants = read_fasta(spark, str(tmp_path / "cont.fasta"))
    features = w.modified_peptides_csv(spark, str(path), str(tmp_path / "db.fasta"), contaminants)
    assert features.wide.count() == 44
    notes = {r["protein_group"]: r for r in features.annotation.collect()}
    found = notes[proteins[3][55:59] + "(+79.97)" + proteins[3][59:67]]
    assert (found["good_accession"], found["gene_name"], found["description"]) == ("S3", "Gn3", "Protein 3")
    meta = w.sample_metadata(spark, str(tmp_path / "map.csv"), str(tmp_path / "sheet.csv"), KIT)
    out = w.quantify(features, meta, w.Settings(max_missing=0.7, batch="combat", median_scope="all"))
    check_results(out, planted, 44)
    plex_means = out["processed"].groupBy(F.substring("sample_name", 1, 5).alias("p")).agg(F.avg("unbatched_intensity").alias("m")).collect()
    assert abs(plex_means[0]["m"] - plex_means[1]["m"]) < 0.1


def test_modification_sites(spark, tmp_path):
    rng = random.Random(4)
    write_metadata(tmp_path)
    columns = [f"Reporter intensity corrected {c} plex{p}___{m}" for p in (1, 2) for c in range(1, 7) for m in (1, 2, 3)]
    lines = ["\t".join(["Protein", "Positions within proteins", "Gene names", "Localization prob", *columns, "Reverse", "Potential contaminant", "Only identified by site"])]
    for f in range(40):
        base = {m: rng.uniform(15, 25) for m in (1, 2, 3)}
        values = [0 if m == 3 or (m == 2 and f % 2) else value(rng, base[m], p, c, 3.0 if f < 2 else 0.0)
                  for p in (1, 2) for c in range(6) for m in (1, 2, 3)]
        prob = {30: "0.49", 31: "0.5", 32: ""}.get(f, "0.99")
        lines.append("\t".join([f"P{f}", str(10 + f), f"G{f}", prob, *map(str, values), "", "+" if f == 33 else "", ""]))
    path = tmp_path / "sites.txt"
    path.write_text("\n".join(lines) + "\n")
    features = w.clean_sites(spark, str(path), KIT, 2)
    keys = {r["protein_group"] for r in features.wide.select("protein_group").collect()}
    kept = [f for f in range(40) if f not in (30, 32, 33)]
    assert keys == {f"P{f}_{10 + f}___{m}" for f in kept for m in (1, 2) if not (m == 2 and f % 2)}
    assert features.samples[0] == "plex1_tmt6_126" and features.samples[-1] == "plex2_tmt6_131"
    one = features.wide.where("protein_group = 'P0_10___1'").first()
    first_row = lines[1].split("\t")
    assert one["plex2_tmt6_126"] == pytest.approx(float(first_row[4 + 6 * 3]))
    meta = w.sample_metadata(spark, str(tmp_path / "map.csv"), str(tmp_path / "sheet.csv"), KIT)
    out = w.quantify(features, meta, w.Settings())
    check_results(out, ["P0_10___1", "P0_10___2", "P1_11___1"], len(keys))
    assert math.isfinite(out["by_contrast"].agg(F.max("b")).first()[0])


def test_site_rows_with_equal_ids_stay_apart(spark, tmp_path):
    columns = [f"Reporter intensity corrected {c} plex1___{m}" for c in range(1, 7) for m in (1, 2, 3)]
    flags = ["Reverse", "Potential contaminant", "Only identified by site"]
    head = ["Protein", "Positions within proteins", "Gene names", "Fasta headers", "Localization prob", "PEP", *columns, *flags]
    rows = [["P1", "10", "G1", "h", "0.99", "0.1", *[str(100 * k + i + 1) for i in range(18)], "", "", ""] for k in (1, 2)]
    path = tmp_path / "sites.txt"
    path.write_text("\n".join("\t".join(r) for r in [head, *rows]) + "\n")
    features = w.clean_sites(spark, str(path), KIT, 1)
    assert features.wide.count() == 6
    assert {(r["protein_group"], r["n_rows"]) for r in features.checks["repeated_sites"].collect()} == {(f"P1_10___{m}", 2) for m in (1, 2, 3)}
    assert {"fasta_headers", "pep"} <= set(features.annotation.columns)
    w.write_sites(features, str(tmp_path / "cleaned"))
    back = w.cleaned_sites_tsv(spark, str(tmp_path / "cleaned"))
    assert back.samples == features.samples
    key = lambda f: sorted(tuple(r[s] for s in f.samples) for r in f.wide.collect())
    assert key(back) == key(features)


def test_peptides_without_a_record_stay_and_are_reported(spark, tmp_path):
    (tmp_path / "db.fasta").write_text(">sp|S1|N1_MOUSE Protein 1 OS=Mus musculus GN=Gn1 PE=1\nAAAAACCCCCDDDDD\n")
    (tmp_path / "cont.fasta").write_text(">sp|S9|X_MOUSE Keratin OS=Mus\nAAA\n")
    names = [f"Intensity TMTset1 {KIT}-{c.upper()}" for c in CHANNELS[KIT]]
    values = [["1"] * 6, ["2"] * 6, ["3"] * 6, ["3"] * 6]
    peptides = [("AAAAAC", "S1|N1_MOUSE"), ("WWWWWW", ""), ("CCCDD", "S1|N1_MOUSE"), ("CCCDD", "S1|N1_MOUSE")]
    lines = [",".join(["Peptide", "Accession", *names]), *[",".join([p, a, *v]) for (p, a), v in zip(peptides, values)]]
    (tmp_path / "peptides.csv").write_text("\n".join(lines) + "\n")
    contaminants = read_fasta(spark, str(tmp_path / "cont.fasta"))
    features = w.modified_peptides_csv(spark, str(tmp_path / "peptides.csv"), str(tmp_path / "db.fasta"), contaminants)
    assert sorted(r["protein_group"] for r in features.wide.collect()) == ["AAAAAC", "CCCDD", "WWWWWW"]
    assert [r["protein_group"] for r in features.checks["unmatched_peptides"].collect()] == ["WWWWWW"]
    twice = features.annotation.where("protein_group = 'CCCDD'").collect()
    assert [(r["accession"], r["peptide"], r["gene_name"], r["description"]) for r in twice] == [("S1;S1", "CCCDD;CCCDD", "Gn1", "Protein 1")]


def test_batch_sizes_count_measured_samples(spark):
    rng = random.Random(8)
    rows = [(f"f{i}", f"s{k}", rng.gauss(10 + (k > 2), 1)) for i in range(30) for k in range(6)]
    long = spark.createDataFrame(rows, "protein_group string, sample_name string, normalized_intensity double")
    batches = [(f"s{k}", "one" if k <= 2 else "two") for k in range(6)]
    extra = [(f"absent{k}", "one") for k in range(4)]
    out = []
    for table in (batches, batches + extra):
        done = batch.combat(long, spark.createDataFrame(table, "sample_name string, batch string"))
        out.append({(r["protein_group"], r["sample_name"]): r["unbatched_intensity"] for r in done.collect()})
    assert out[0] == pytest.approx(out[1])


def test_readable_names(spark):
    table = spark.createDataFrame([("a", "g1", "Control old", "s_1"), ("b", "g1", "Control old", "s_7"), ("c", "g2", "KO", "s_2")],
                                  "sample_name string, group_number string, exp_group string, sample_number string")
    label = lambda **k: [r["label"] for r in meta.readable_names(table, {"Control": "Ct"}, **k).orderBy("sample_name").collect()]
    assert label() == ["Ct old_1", "Ct old_7", "KO_2"] and label(ending="running") == ["Ct old_1", "Ct old_2", "KO_1"]


def test_many_contrasts_plan_and_run(spark):
    """100 groups, all pairs: the weights are a table, not an expression each."""
    groups = [f"g{i}" for i in range(100)]
    contrasts = model.pairwise_contrasts(groups)
    rows = [(f"f{k}", g, float(hash((k, i, g)) % 97)) for k in range(3) for g in groups for i in range(2)]
    long = spark.createDataFrame(rows, "protein_group string, exp_group string, v double")
    coefs = model.apply_contrasts(model.fit_groups(long, "v"), contrasts)
    assert coefs.count() == 3 * 4950
    one = coefs.where("protein_group = 'f1' AND contrast = 'g3_vs_g50'").first()
    mean = lambda g: sum(v for f, h, v in rows if f == "f1" and h == g) / 2
    assert one["log_fc"] == pytest.approx(mean("g3") - mean("g50")) and one["unscaled"] == pytest.approx(1.0)
