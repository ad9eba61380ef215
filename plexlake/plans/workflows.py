"""The end-to-end workflows: from export files to ranked tables.

Each entry turns its own file layout into the long table; everything after that is the
shared :func:`quantify`, which keeps one row per feature and writes each stage once to shared storage.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from plexlake.functions import scalars
from plexlake.operators import annotate, arrays, batch, checks, clean, meta, model, normalize, project, qc, reshape, results, search
from plexlake.plans.session import materialise
from plexlake.plans.sizing import Extent, broadcast_if
from plexlake.sources import columns, tables
from plexlake.sources.fasta import read_fasta

FEATURE = "protein_group"
# What a site table says of a site besides its intensities.
SITE_IDS = (
    "Protein", "Positions within proteins", "Gene names", "Fasta headers", "Localization prob", "Amino acid",
    "Position in peptide", "PEP", "Score", "Sequence window", "Phospho (STY) Probabilities",
)


@dataclass(frozen=True)
class Features:
    """What an entry hands to the shared pipeline."""

    wide: DataFrame  # feature id, annotation columns, one column per sample
    samples: list[str]
    annotation: DataFrame
    checks: Mapping[str, DataFrame] = field(default_factory=dict)  # rows in breach, by name


@dataclass(frozen=True)
class Settings:
    """Run parameters of the shared pipeline."""

    max_missing: float = 0.5
    batch: str = "none"  # none, pool or combat
    batches: DataFrame | None = None  # (sample_name, batch) for combat; plex by default
    renormalise: bool = False
    removed_samples: Sequence[str] = ()
    imputation: str = "no"
    median_scope: str = "mapped"  # mapped or all samples
    contrasts: model.Contrasts | None = None  # all pairs by default
    reversed_contrasts: Sequence[str] = ()
    neighbours: int = 3
    components: int = project.COMPONENTS  # principal components, at most
    significance: float = 0.01
    effect_columns: int = 1_000  # with more contrasts the overall table leaves fold changes to by_contrast
    keep_pools: bool = True
    words: Mapping[str, str] = field(default_factory=dict)  # replaced in the names of groups and samples
    label: str = "number"  # readable sample names end in the sample's number, or in a "running" one per group


# --- entries ----------------------------------------------------------------------------


def sample_metadata(spark: SparkSession, channel_map: str, sheet: str, kit: str) -> DataFrame:
    rows = meta.channel_rows(tables.read_channel_map(spark, channel_map), kit)
    return meta.sample_metadata(rows, meta.sample_sheet(tables.read_sample_sheet(spark, sheet)))


def protein_groups_tsv(
    spark: SparkSession, path: str, kit: str, n_plex: int,
    ids: Sequence[str] = ("Majority protein IDs", "Protein names", "Gene names"),
) -> Features:
    """Protein groups with numbered reporter columns and flag columns."""
    flags = ("Reverse", "Potential contaminant", "Only identified by site")
    df = columns.rename_reporters(tables.read_tsv(spark, path), kit, n_plex)
    df = columns.clean_columns(columns.select_columns(df, ids, r"^Intensity plex[0-9]+ : TMT", flags))
    df = df.withColumnRenamed(df.columns[0], FEATURE)
    samples = columns.plex_columns(df)
    df = clean.drop_flagged(columns.zero_to_null_columns(df, samples))
    extra = [c for c in df.columns if c not in samples]
    notes = annotate.annotation_dimension(df, extra)
    return Features(df, samples, notes, {"repeated_annotation": checks.duplicate_keys(notes, [FEATURE])})


def _grouped(df: DataFrame, samples: list[str], texts: Sequence[str], order: str) -> Features:
    """Collapse repeated intensity rows and concatenate what describes them."""
    described = annotate.concat_annotation(df, FEATURE, texts, order)
    values = annotate.collapse_redundant(df, FEATURE, samples)
    found = {"repeated_values": checks.duplicate_keys(values, [FEATURE])}
    return Features(annotate.join_groups(described, values, FEATURE), samples, described, found)


def protein_groups_csv(spark: SparkSession, path: str, contaminants: DataFrame) -> Features:
    """Protein rows of groups, with combined columns and pipe-separated accessions."""
    df = tables.read_csv(spark, path)
    df = columns.select_columns(df, ["Protein Group", "Accession", "Description"], r"^Intensity")
    df = tables.in_input_order(columns.clean_columns(columns.drop_combined(df)), "_ord")
    samples = columns.plex_columns(df)
    df = columns.zero_to_null_columns(df.withColumn(FEATURE, F.col(FEATURE).cast("string")), samples)
    df = clean.remove_contaminants(df, contaminants)
    df = df.withColumn("accession", F.coalesce(scalars.before_last(F.col("accession")), F.col("accession")))
    return _grouped(materialise(df, "proteins"), samples, ["accession", "description"], "_ord")


def modified_peptides_csv(
    spark: SparkSession, path: str, fasta: str, contaminants: DataFrame, species_token: str = "MOUSE", lookup: str = "exact"
) -> Features:
    """Modified peptides; missing accessions are found by sequence, then annotated from the FASTA records."""
    df = columns.select_columns(tables.read_csv(spark, path), ["Peptide", "Accession"], r"^Intensity")
    df = tables.in_input_order(columns.clean_columns(columns.drop_combined(df)), "_ord")
    samples = columns.plex_columns(df)
    df = columns.zero_to_null_columns(df, samples)
    df = materialise(df.withColumn("peptide_seq", scalars.strip_modifications(F.col("peptide"))), "peptides")
    records = materialise(read_fasta(spark, fasta, species_token), "fasta")
    df = search.fill_accessions(df, records)
    df = df.withColumn("good_accession", scalars.accession_head(F.col("accession"))).withColumn(
        "uniprot_id", scalars.accession_tail(F.col("accession"))
    )
    df = search.with_records(df, records, mode=lookup)
    df = clean.remove_contaminants(df.withColumn(FEATURE, F.col("peptide")), contaminants, "good_accession")
    df = materialise(df, "annotated")
    described = peptide_annotation(df, "_ord")
    unmatched = df.where("gene_name IS NULL AND description IS NULL").select(FEATURE, "good_accession").distinct()
    found = {"unmatched_peptides": unmatched, "repeated_annotation": checks.duplicate_keys(described, [FEATURE])}
    values = annotate.collapse_redundant(df, FEATURE, samples)
    return Features(annotate.join_groups(described, values, FEATURE), samples, described, found)


def peptide_annotation(df: DataFrame, order: str) -> DataFrame:
    """Accessions and peptides of a group joined in order, the other columns as they are: distinct rows."""
    names = df.withColumn("accession", F.col("good_accession"))
    others = ["peptide_seq", "good_accession", "gene_name", "description", "uniprot_id"]
    return annotate.concat_beside(names, FEATURE, ["accession", "peptide"], others, order)


def clean_sites(
    spark: SparkSession, path: str, kit: str, n_plex: int, minimum: float = 0.5, ids: Sequence[str] = SITE_IDS,
) -> Features:
    """Modification sites: multiplicity columns become rows, weak and empty sites go.

    Id columns that the file lacks are left out, except the three that name a site and rate it.
    """
    flags = ("Reverse", "Potential contaminant", "Only identified by site")
    df = tables.read_tsv(spark, path, quote="")
    needed = ("Protein", "Positions within proteins", "Localization prob")
    present = [c for c in ids if c in df.columns or c in needed]
    df = columns.clean_columns(columns.select_columns(df, present, columns.REPORTER_PATTERN, flags), strip="")
    df = df.withColumn("localization_prob", F.col("localization_prob").try_cast("double"))
    df = clean.confident_sites(clean.drop_flagged(df), minimum=minimum)
    values = [c for c in df.columns if c.startswith("reporter_intensity_corrected")]
    labels = [columns.snake_case(n).replace("intensity_", "") for n in columns.reporter_names(kit, n_plex)]
    found = {tuple(map(int, re.findall(r"_(\d+)_plex(\d+)_", c)[0])) for c in values}
    order = sorted(found, key=lambda channel_plex: channel_plex[::-1])
    if len(order) != len(labels):
        raise ValueError(f"{len(order)} reporter columns found, {kit} x {n_plex} plexes needs {len(labels)}")
    names = {f"reporter_intensity_corrected_{c}_plex{p}": label for (c, p), label in zip(order, labels, strict=True)}
    wide = reshape.multiplicity_wide(columns.zero_to_null_columns(df, values)).withColumnsRenamed(names)
    key = scalars.site_key(F.col("protein"), F.col("positions_within_proteins"), F.col("multiplicity"))
    wide = clean.drop_all_missing(wide, labels).withColumn(FEATURE, key)
    return site_features(wide, labels)


def site_features(wide: DataFrame, samples: Sequence[str]) -> Features:
    """Features of a cleaned site table, as it comes from :func:`clean_sites` or was read back."""
    described = [FEATURE, *[c for c in wide.columns if c not in samples and c != FEATURE]]
    annotation = annotate.annotation_dimension(wide, described)
    found = {"repeated_sites": checks.duplicate_keys(wide, [FEATURE]), "repeated_annotation": checks.duplicate_keys(annotation, [FEATURE])}
    return Features(wide, list(samples), annotation, found)


def write_sites(features: Features, path: str) -> None:
    """The cleaned site table as a TSV file set."""
    tables.write_tsv(features.wide, path)


def cleaned_sites_tsv(spark: SparkSession, path: str) -> Features:
    """The entry for a site table that :func:`write_sites` wrote."""
    df = tables.read_tsv(spark, path, numeric=r"^plex[0-9]", quote="")
    return site_features(df, columns.plex_columns(df))


# --- shared pipeline --------------------------------------------------------------------


def quantify(features: Features, metadata: DataFrame, settings: Settings = Settings()) -> dict[str, DataFrame]:
    """All result tables of a run, by name.

    Values stay one row per feature, in arrays, from the input to the fit: a table without repeated features is
    never shuffled by feature, any other once. Features with very many rows go through the operators on long
    tables instead, with the same medians and priors. Long tables in the result are views of the arrays.
    """
    spark = features.wide.sparkSession
    n = len(features.samples)
    metadata = materialise(metadata, "metadata")
    n_meta = metadata.count()  # one row per sample; decides the broadcasts below
    gathered, hot_rows = arrays.gather(features.wide.select(FEATURE, *features.samples), features.samples, scalars.log2_intensity, FEATURE)
    raw = materialise(gathered, "raw")
    hot = None
    if hot_rows is not None:
        hot = reshape.to_long(hot_rows, features.samples)
        hot = materialise(hot.withColumn("intens", scalars.log2_intensity(F.col("intens").cast("double"))), "hot")
    both = lambda table, more: table if more is None else table.unionByName(more)
    long = both(arrays.to_long(raw, features.samples, {"raw": "intens"}), hot)
    n_rows = raw.agg(F.sum(F.size("raw"))).first()[0] or 0
    size = Extent(n, n_rows + (hot_rows.count() if hot_rows is not None else 0))

    scope = clean.keep_common_samples(long, metadata, n_meta) if settings.median_scope == "mapped" else long
    median_all = qc.global_median(scope, "intens", size)
    medians = materialise(qc.flag_high_medians(qc.sample_medians(long, "intens", size)), "medians")
    flagged = qc.flag_maximum(qc.attach_samples(long, medians, size), "intens", size)
    described = meta.attach_metadata(flagged, metadata, n_meta)
    plain = meta.attach_metadata(long, metadata, n_meta)  # without the medians and flags, which these do not need
    completeness = qc.completeness(plain)
    detected = qc.detected_features(plain)
    missing = qc.missing_per_feature(plain)
    of_sample = lambda table: meta.attach_metadata(table, metadata, n_meta)

    # what is known of the samples that stay: one row each, in the order of their names
    about = of_sample(medians.drop("high")).withColumn("_group", scalars.syntactic_name(F.col("exp_group")))
    known = {r["sample_name"]: r for r in about.collect()}
    if about.count() > len(known):
        raise ValueError("a sample has several rows of metadata")
    samples = sorted(set(known) - set(settings.removed_samples))
    value_all = median_all.first()["median_all"]
    values = _Values(raw, hot, samples, known, about.drop("_group"), size)
    filled = values.normalised(features.samples, value_all, settings)
    unbatched = filled.corrected(settings)
    if settings.renormalise:
        unbatched = unbatched.renormalised()
    samples, value = unbatched.samples, "unbatched_intensity"
    before = filled.cells("v")
    after = materialise(unbatched.cells("u"), "cells")
    scores_before, components_before = project.pca_of_cells(before, filled.samples, settings.components)
    scores_after, components_after = project.pca_of_cells(after, samples, settings.components)
    products = materialise(project.gram_rows(after, len(samples), ["raw"]), "gram")

    names = spark.createDataFrame([(name,) for name in samples], "sample_name string")
    used = clean.keep_common_samples(metadata, names, n)
    if not settings.keep_pools:
        used = used.where(~F.startswith("group_number", F.lit("POOL")))
    used_names = {r["sample_name"] for r in used.select("sample_name").collect()}
    sizes = model.group_sizes(used)
    contrasts = settings.contrasts or model.pairwise_contrasts(list(sizes))
    contrasts = model.reverse_contrasts(contrasts, settings.reversed_contrasts)
    model.check_contrasts(contrasts, list(sizes))
    fit = materialise(arrays.fit_groups(after, [known[s]["_group"] if s in used_names else None for s in samples], FEATURE), "fit")
    prior = model.variance_prior(fit)
    effects = len(contrasts) <= settings.effect_columns
    overall = materialise(results.overall_results(fit, contrasts, sizes, features.annotation, FEATURE, prior, effects), "overall")
    weights = materialise(model.contrast_table(spark, contrasts), "weights")
    by_contrast = materialise(results.contrast_results(fit, weights, features.annotation, FEATURE, prior), "by_contrast")
    labels = meta.readable_names(used, settings.words, settings.label)
    dotted = meta.readable_names(used, settings.words, settings.label, ".")
    matrix = arrays.matrix(after, samples)
    readable = reshape.rename_samples(matrix, labels)
    breaches = {
        **features.checks,
        "unmapped_samples": checks.unmapped_samples(long, metadata),
        "samples_on_one_side": meta.samples_on_one_side(long, metadata),
    }
    return {
        **{f"check_{name}": rows for name, rows in breaches.items()},
        "metadata": meta.order_by_group(metadata),
        "long": described,
        "boxes_raw": qc.box_statistics(long, "intens", size),
        "boxes_normalised": qc.box_statistics(filled.long("v", "normalized_intensity"), "normalized_intensity", size),
        "boxes_unbatched": qc.box_statistics(unbatched.long("u", value), value, size),
        "completeness": of_sample(completeness),
        "mean_completeness": qc.mean_line(completeness, "completeness"),
        "detected": of_sample(detected),
        "mean_detected": qc.mean_line(detected, "n_detected"),
        "missing_histogram": qc.missing_histogram(missing),
        "processed": unbatched.processed(),
        "pca_scores_normalised": of_sample(scores_before),
        "pca_components_normalised": components_before,
        "pca_scores": of_sample(scores_after),
        "pca_components": components_after,
        "neighbours": project.nearest_neighbours(products, samples, settings.neighbours),
        "sample_labels": labels,
        "expression_matrix": matrix,
        "readable_matrix": readable,
        "contrasts": weights,
        "overall": results.ranked(overall),
        "by_contrast": by_contrast,
        "by_contrast_with_values": by_contrast.join(readable, FEATURE, "left"),
        "heat_map": results.heat_map_of_cells(overall, after, samples, dotted, settings.significance, FEATURE, n_meta),
    }


@dataclass(frozen=True)
class _Values:
    """The values of a run: features as arrays, those with very many rows in long form, and the samples they cover."""

    table: DataFrame  # (feature, raw, v, u) as far as they have come
    hot: DataFrame | None  # (feature, sample_name, intens, normalized_intensity, unbatched_intensity) likewise
    samples: list[str]
    known: Mapping[str, Row]  # MED and metadata by sample
    about: DataFrame  # the same as a table
    size: Extent

    def _of(self, column: str) -> list:
        return [self.known[s][column] for s in self.samples]

    def long(self, column: str, name: str) -> DataFrame:
        rows = arrays.to_long(self.table, self.samples, {column: name}, FEATURE)
        return rows if self.hot is None else rows.unionByName(self.hot.select(FEATURE, "sample_name", name))

    def cells(self, column: str) -> DataFrame:
        rows = arrays.cells(self.table, len(self.samples), column, FEATURE)
        if self.hot is None:
            return rows
        value = {"v": "normalized_intensity", "u": "unbatched_intensity"}[column]
        return rows.unionByName(arrays.from_cells(reshape.cells(self.hot, value, FEATURE), self.samples, value, FEATURE))

    def processed(self) -> DataFrame:
        names = {"raw": "intens", "v": "normalized_intensity", "u": "unbatched_intensity"}
        rows = arrays.to_long(self.table, self.samples, names, FEATURE)
        if self.hot is not None:
            rows = rows.unionByName(self.hot.select(rows.columns))
        return rows.join(broadcast_if(self.about, len(self.known)), "sample_name").select(
            "sample_name", FEATURE, "intens", *self.about.columns[1:], "normalized_intensity", "unbatched_intensity"
        )

    def _hot_with_samples(self) -> DataFrame:
        return self.hot.join(broadcast_if(self.about, len(self.known)), "sample_name")

    def normalised(self, all_samples: Sequence[str], median_all: float | None, settings: Settings) -> _Values:
        """Samples moved to the common median, features with many missing values out, the others filled if asked."""
        if settings.imputation not in ("no", "group_median", "sample_floor"):
            raise ValueError(f"unknown imputation {settings.imputation!r}")
        at = {s: i for i, s in enumerate(all_samples)}
        none = float("nan")
        shift = [none if median_all is None or m is None else median_all - m for m in self._of("MED")]
        groups = self._of("exp_group") if settings.imputation == "group_median" else None
        table = arrays.normalise(self.table, len(all_samples), [at[s] for s in self.samples], shift, settings.max_missing, groups, FEATURE)
        value, hot = "normalized_intensity", None
        if self.hot is not None:
            rows = clean.remove_samples(self._hot_with_samples(), settings.removed_samples)
            moved = rows.withColumn(value, F.col("intens") - F.col("MED") + F.lit(median_all).cast("double"))
            kept = clean.filter_missing(moved, settings.max_missing, value, FEATURE)
            how = "group_median" if groups is not None else "no"
            hot = normalize.impute(kept, value, how, FEATURE).select(FEATURE, "sample_name", "intens", value)
        done = self._written(table, hot, "normalised")
        if settings.imputation != "sample_floor":
            return done
        floors = normalize.sample_floors(done.long("v", value), value, self.size)
        found = {r["sample_name"]: r["_floor"] for r in floors.collect()}  # one row per sample
        low = [none if found.get(s) is None else found[s] for s in self.samples]
        table = arrays.filled(done.table, len(self.samples), low, FEATURE)
        hot = None if done.hot is None else normalize.impute(done.hot, value, "sample_floor", FEATURE, floors=floors)
        return done._written(table, hot, "filled")

    def corrected(self, settings: Settings) -> _Values:
        value, out = "normalized_intensity", "unbatched_intensity"
        if settings.batch == "none":
            hot = None if self.hot is None else batch.no_batch(self.hot)
            return replace(self, table=self.table.withColumn("u", F.col("v")), hot=hot)
        if settings.batch == "pool":
            table = arrays.pool_reference(self.table, self._of("plex"), [p == "POOL" for p in self._of("sample_or_pool")], FEATURE)
            hot = None
            if self.hot is not None:
                hot = batch.pool_reference(self._hot_with_samples(), value, FEATURE).select(FEATURE, "sample_name", "intens", value, out)
            return self._written(table, hot, "unbatched")
        if settings.batch != "combat":
            raise ValueError(f"unknown batch method {settings.batch!r}")
        named = settings.batches
        if named is None:
            named = self.about.select("sample_name", scalars.plex_of(F.col("sample_name")).alias("batch"))
        rows = clean.keep_common_samples(named, self.about, len(self.known)).where("batch IS NOT NULL").distinct().collect()
        label = {r["sample_name"]: str(r["batch"]) for r in rows}  # at most one row per sample
        samples = [s for s in self.samples if s in label]
        places = [i for i, s in enumerate(self.samples) if s in label]
        table = arrays.restricted(self.table, len(self.samples), places, FEATURE)
        gaps = arrays.any_missing(table)
        hot = more = batches = None
        if self.hot is not None:
            batches = self.table.sparkSession.createDataFrame(sorted(label.items()), "sample_name string, batch string")
            batches = clean.keep_common_samples(batches, self.about, len(self.known))
            rows = clean.keep_common_samples(self.hot, batches, len(label))
            gaps = gaps or rows.where(F.col(value).isNull()).limit(1).count() > 0
            more = batch.combat_statistics(rows, batches, value, FEATURE, len(label), gaps)
        table, prior = arrays.combat(table, [label[s] for s in samples], FEATURE, more, gaps)
        if self.hot is not None:
            hot = batch.combat(rows, batches, value, FEATURE, prior, gaps).select(FEATURE, "sample_name", "intens", value, out)
        return replace(self, samples=samples)._written(table, hot, "unbatched")

    def renormalised(self) -> _Values:
        """A second pass to the common median; a sample with any gap, and then all, becomes NULL."""
        value = "unbatched_intensity"
        medians, total = normalize.strict_medians(self.long("u", value), value, self.size)
        medians = materialise(medians, "medians")
        found, total = {r["sample_name"]: r["MEDIAN"] for r in medians.collect()}, total.first()["median_all"]
        shift = [float("nan") if total is None or found.get(s) is None else total - found[s] for s in self.samples]
        hot = None
        if self.hot is not None:
            rows = self.hot.join(broadcast_if(medians, len(self.samples)), "sample_name")
            hot = rows.withColumn(value, F.col(value) - F.col("MEDIAN") + F.lit(total).cast("double")).drop("MEDIAN")
        return self._written(arrays.shifted(self.table, len(self.samples), shift, "u", FEATURE), hot, "renormalised")

    def _written(self, table: DataFrame, hot: DataFrame | None, name: str) -> _Values:
        return replace(self, table=materialise(table, name), hot=None if hot is None else materialise(hot, f"hot_{name}"))


def write_results(tables_by_name: Mapping[str, DataFrame], folder: str) -> None:
    """Processed rows, matrices, overall table and checks as TSV; contrasts, also with values, one folder each."""
    whole = ["metadata", "processed", "expression_matrix", "readable_matrix", "overall"]
    for name in [*whole, *(n for n in tables_by_name if n.startswith("check_"))]:
        tables.write_tsv(tables_by_name[name], f"{folder}/{name}")
    for name in ("by_contrast", "by_contrast_with_values"):
        tables.write_by_contrast(tables_by_name[name], f"{folder}/{name}")
