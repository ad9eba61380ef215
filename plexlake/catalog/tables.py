"""Readers, writers, column names, scalar functions and reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from plexlake.catalog import bindings as b
from plexlake.catalog.registry import ANNOTATED, DENSE, PLEX, QUANTITIES, SAMPLES, SPARSE, query, r6, with_ctes
from plexlake.functions import scalars as s
from plexlake.operators import clean, meta, reshape
from plexlake.plans.session import scratch_path
from plexlake.sources import columns, tables
from plexlake.sources.fasta import read_fasta

# Reporter view of the order lines: seven plexes (line numbers) of six channels.
_CHANNEL_SQL = """CASE l_linestatus || l_returnflag WHEN 'FA' THEN '126' WHEN 'FN' THEN '127n' WHEN 'FR' THEN '128c'
  WHEN 'OA' THEN '129n' WHEN 'ON' THEN '130c' ELSE '131' END"""
_REPORTERS = [f"Reporter intensity corrected {i} plex{p}" for p in range(1, 8) for i in range(1, 7)]


def _reporter_wide(spark, sf_dir):
    """Wide table as an instrument export names it, with flag columns."""
    index = sum(
        (F.when((F.col("l_linestatus") == st) & (F.col("l_returnflag") == fl), i).otherwise(0)
         for i, (st, fl) in enumerate([(st, fl) for st in "FO" for fl in "ANR"], start=1)),
        F.lit(0),
    )
    name = F.concat(F.lit("Reporter intensity corrected "), index.cast("string"), F.lit(" plex"), F.col("l_linenumber").cast("string"))
    cells = b.table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").cast("string").alias("Majority protein IDs"), name.alias("r")).agg(
        F.sum("l_extendedprice").alias("v"))
    return cells.groupBy("Majority protein IDs").pivot("r", _REPORTERS).agg(F.first("v"))


def _reporter_long(wide):
    named = columns.clean_columns(columns.rename_reporters(wide, "tmt6", 7))
    long = reshape.to_long(named, columns.plex_columns(named))
    return long.select(F.col(named.columns[0]).alias("protein_group"), "sample_name", r6("intens"))


_REPORTER_SQL = f"""SELECT CAST(l_suppkey AS VARCHAR) AS protein_group,
  'plex' || l_linenumber || '_tmt6_' || {_CHANNEL_SQL} AS sample_name, round(sum(l_extendedprice), 6) AS intens
FROM lineitem GROUP BY 1, 2"""


@query(_REPORTER_SQL)
def reporter_columns_renamed(spark, sf_dir):
    return _reporter_long(_reporter_wide(spark, sf_dir))


@query(_REPORTER_SQL)
def tsv_round_trip(spark, sf_dir):
    path = scratch_path(spark, "reporters-tsv")
    tables.write_tsv(_reporter_wide(spark, sf_dir), path)
    return _reporter_long(tables.read_tsv(spark, path, numeric=columns.REPORTER_PATTERN))


@query(f"""SELECT CAST(l_suppkey AS VARCHAR) AS protein, 'intensity' AS kind, round(sum(l_extendedprice), 6) AS total
FROM lineitem GROUP BY 1""")
def csv_scan_of_peptide_export(spark, sf_dir):
    """CSV with single and combined intensity columns: combined ones are dropped, zero is missing."""
    wide = b.table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").cast("string").alias("Protein Group")).agg(
        F.sum(F.when(F.col("l_linestatus") == "F", F.col("l_extendedprice"))).alias("Intensity TMTset1 126"),
        F.sum(F.when(F.col("l_linestatus") == "O", F.col("l_extendedprice"))).alias("Intensity TMTset2 126"),
        F.sum("l_extendedprice").alias("Intensity TMTset1;TMTset2 (126)"),
        F.lit(0.0).alias("Intensity TMTset1 127N"),
    )
    path = scratch_path(spark, "peptides-csv")
    wide.write.option("header", True).csv(path)
    df = columns.select_columns(tables.read_csv(spark, path), ["Protein Group"], r"^Intensity")
    df = columns.clean_columns(columns.drop_combined(df))
    values = columns.plex_columns(df)
    df = columns.zero_to_null_columns(df, values)
    long = reshape.to_long(df, values).where("intens is not null")
    return long.groupBy(F.col("protein_group").alias("protein"), F.lit("intensity").alias("kind")).agg(r6(F.sum("intens"), "total"))


@query(with_ctes(DENSE) + "SELECT protein_group, sample_name, round(intens, 6) AS intens FROM dense")
def expression_matrix_export(spark, sf_dir):
    names = meta.sample_names(b.metadata(spark, sf_dir))
    path = scratch_path(spark, "matrix")
    tables.export_matrix(b.dense(spark, sf_dir), names, "intens", path)
    wide = tables.read_tsv(spark, path, numeric="^plex")
    return reshape.to_long(wide, names).select("protein_group", "sample_name", r6("intens"))


@query(with_ctes(ANNOTATED) + """SELECT exp_group AS contrast, protein_group, round(avg(intens), 6) AS mean
FROM annotated GROUP BY 1, 2""")
def tables_by_contrast_export(spark, sf_dir):
    path = scratch_path(spark, "by-contrast")
    means = b.annotated(spark, sf_dir).groupBy(F.col("exp_group").alias("contrast"), "protein_group").agg(r6(F.avg("intens"), "mean"))
    tables.write_by_contrast(means, path)
    return spark.read.parquet(path)


@query("""SELECT 'S' || s_suppkey AS accession, 'Gene' || s_nationkey AS gene_name, 'Protein of ' || s_nationkey AS description,
  upper(translate(s_name, '0123456789#', 'ACDEFGHIKLM')) || translate(CAST(s_suppkey AS VARCHAR), '0123456789', 'NPQRSTVWYA') AS sequence,
  '>sp|S' || s_suppkey || '|' || upper(s_name) || '_MOUSE Protein of ' || s_nationkey || ' OS=Mus musculus GN=Gene' || s_nationkey || ' PE=1' AS header
FROM supplier""")
def fasta_scan(spark, sf_dir):
    path = scratch_path(spark, "fasta")
    b.fasta_lines(spark, sf_dir).write.text(path)
    return read_fasta(spark, path).drop("fasta_ord")


# --- scalar functions -------------------------------------------------------------------


@query(with_ctes(DENSE) + "SELECT protein_group, sample_name, round(intens, 6) AS intens FROM dense")
def log2_transform(spark, sf_dir):
    return b.dense(spark, sf_dir).select("protein_group", "sample_name", r6("intens"))


@query(with_ctes(SPARSE) + """SELECT protein_group, sample_name, CASE WHEN value <> 0 THEN round(value, 6) END AS value,
  CASE WHEN value > 0.050001 THEN round(value, 6) END AS above_base FROM discounts""")
def zero_and_floor_to_null(spark, sf_dir):
    v = F.col("value")
    return b.quantities(spark, sf_dir, "l_partkey", "l_discount").select(
        "protein_group", "sample_name", r6(s.zero_to_null(v), "value"), r6(s.floor_to_null(v, 0.050001), "above_base")
    )


@query(with_ctes(SAMPLES) + """SELECT sample_name, plex, channel AS tmt, CASE WHEN ln = 7 THEN 'POOL' ELSE 'sample' END AS sample_or_pool,
  CASE WHEN ln = 7 THEN 'POOL' WHEN flag <> 'R' THEN 'sample' END AS strict_label FROM sample_list""")
def sample_name_parts(spark, sf_dir):
    meta_rows = b.metadata(spark, sf_dir)
    group = F.when(F.col("group_number") == "GroupR", "groupr").otherwise(F.col("group_number"))
    return meta_rows.select(
        "sample_name", s.plex_of(F.col("sample_name")).alias("plex"), s.channel_of(F.col("sample_name")).alias("tmt"),
        s.sample_or_pool(F.col("group_number")).alias("sample_or_pool"), s.sample_or_pool(group, strict=True).alias("strict_label"),
    )


@query("""SELECT s_suppkey, 'S' || s_suppkey AS head, s_name || '|N' || s_nationkey AS tail, s_name AS before_last,
  CASE WHEN s_nationkey > 12 THEN 'S' || s_suppkey END AS before_last_of_few, s_name AS tail_of_one FROM supplier""")
def accession_fields(spark, sf_dir):
    key = F.col("s_suppkey").cast("string")
    accession = F.concat(F.lit("S"), key, F.lit("|"), F.col("s_name"), F.lit("|N"), F.col("s_nationkey").cast("string"))
    return b.table(spark, sf_dir, "supplier").select(
        "s_suppkey", s.accession_head(accession).alias("head"), s.accession_tail(accession).alias("tail"),
        s.before_last(accession).alias("before_last"), s.before_last(F.when(F.col("s_nationkey") > 12, F.concat(F.lit("S"), key, F.lit("|x"))).otherwise(F.col("s_name"))).alias("before_last_of_few"),
        s.accession_tail(F.col("s_name")).alias("tail_of_one"),
    )


@query("""SELECT p_partkey, upper(replace(p_name, ' ', '')) AS peptide_seq, 2 AS tags FROM part""")
def strip_modifications(spark, sf_dir):
    word = F.upper("p_name")
    peptide = F.concat(F.substring(word, 1, 1), F.lit(" (+79.97)"), F.replace(F.substr(word, F.lit(2)), F.lit(" "), F.lit("(+15.99)")), F.lit("(+79.97)"))
    return b.table(spark, sf_dir, "part").select(
        "p_partkey", s.strip_modifications(peptide).alias("peptide_seq"), s.tag_count(peptide).alias("tags"))


@query("""SELECT count(*) AS n_peptides, count_if(len(string_split(text, 'the')) > 1) AS n_modified,
  CAST(sum(len(string_split(text, 'the')) - 1) AS BIGINT) AS n_tags,
  round(100.0 * count_if(len(string_split(text, 'the')) > 1) / count(*), 6) AS percent_modified FROM documents""")
def modification_share(spark, sf_dir):
    from plexlake.operators.annotate import modification_summary

    out = modification_summary(b.table(spark, sf_dir, "documents"), "text", "the")
    return out.withColumn("percent_modified", r6("percent_modified"))


@query(with_ctes(SAMPLES) + """SELECT sample_name, exp_group || '_' || number AS label, exp_group || '.' || number AS heat_label,
  replace(replace(exp_group, 'Group', 'Gr'), 'POOL', 'Pool') AS short, replace(exp_group, ' ', '_') AS syntactic
FROM meta JOIN sample_list USING (sample_name)""")
def readable_labels(spark, sf_dir):
    group, number = F.col("exp_group"), F.col("sample_number")
    return b.metadata(spark, sf_dir).select(
        "sample_name", s.readable_label(group, number).alias("label"), s.readable_label(group, number, ".").alias("heat_label"),
        s.replace_words(group, {"Group": "Gr", "POOL": "Pool"}).alias("short"), s.syntactic_name(group).alias("syntactic"),
    )


# --- reshaping --------------------------------------------------------------------------


@query(with_ctes(QUANTITIES) + "SELECT protein_group, sample_name, round(value, 6) AS intens FROM quantities")
def wide_to_long(spark, sf_dir):
    names = meta.sample_names(b.metadata(spark, sf_dir))
    wide = reshape.expression_matrix(b.quantities(spark, sf_dir), names, "value")
    return reshape.to_long(wide, names).select("protein_group", "sample_name", r6("intens"))


_LINES = f"""obs AS (SELECT CAST(l_partkey AS VARCHAR) AS protein_group,
  {PLEX} || '_tmt_' || lower(l_returnflag) || l_linenumber AS sample_name, nullif(l_discount, 0) AS v FROM lineitem)"""


@query(with_ctes(_LINES) + """SELECT protein_group, sample_name, CASE WHEN count(v) = count(*) THEN round(median(v), 6) END AS v
FROM obs GROUP BY 1, 2""")
def cell_medians(spark, sf_dir):
    return reshape.cells(b.lines(spark, sf_dir), "v").select("protein_group", "sample_name", r6("v"))


@query(with_ctes(SPARSE, SAMPLES) + """SELECT f.protein_group, s.sample_name, round(intens, 6) AS intens
FROM (SELECT DISTINCT protein_group FROM sparse) f CROSS JOIN sample_list s
LEFT JOIN sparse x ON x.protein_group = f.protein_group AND x.sample_name = s.sample_name""")
def densified_grid(spark, sf_dir):
    names = meta.sample_names(b.metadata(spark, sf_dir))
    return reshape.densify(b.sparse(spark, sf_dir), names, "intens").select("protein_group", "sample_name", r6("intens"))


_MULTI_SQL = f"""SELECT CAST(l_suppkey AS VARCHAR) AS protein,
  'reporter_intensity_corrected_' || l_linenumber || '_plex' || CASE l_linestatus WHEN 'F' THEN 1 ELSE 2 END AS sample,
  '___' || CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS multiplicity, round(sum(l_extendedprice), 6) AS value
FROM lineitem GROUP BY 1, 2, 3"""


def _site_table(spark, sf_dir, *halves):
    names = [f"reporter_intensity_corrected_{c}_plex{p}_{m}" for c in range(1, 8) for p in (1, 2) for m in (1, 2, 3)]
    m = F.col("l_returnflag")
    column = F.concat(
        F.lit("reporter_intensity_corrected_"), F.col("l_linenumber").cast("string"), F.lit("_plex"),
        F.when(F.col("l_linestatus") == "F", "1").otherwise("2"), F.lit("_"),
        F.when(m == "A", "1").when(m == "N", "2").otherwise("3"),
    )
    keys = [F.col("l_suppkey").cast("string").alias("protein"), *[F.expr(half).alias("half") for half in halves]]
    cells = b.table(spark, sf_dir, "lineitem").groupBy(*keys, column.alias("c")).agg(F.sum("l_extendedprice").alias("v"))
    return cells.groupBy("protein", *["half" for _ in halves]).pivot("c", names).agg(F.first("v"))


def _multiplicities(spark, sf_dir):
    return reshape.multiplicity_rows(_site_table(spark, sf_dir))


@query(_MULTI_SQL)
def multiplicity_to_rows(spark, sf_dir):
    return _multiplicities(spark, sf_dir).select("protein", "sample", "multiplicity", r6("value"))


@query("""WITH v AS (SELECT CAST(l_suppkey AS VARCHAR) AS protein, l_orderkey % 2 AS half,
  '___' || CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS multiplicity, l_linenumber, l_linestatus, sum(l_extendedprice) AS x
  FROM lineitem GROUP BY ALL),
rows_ AS (SELECT DISTINCT protein, half, m AS multiplicity FROM v, (VALUES ('___1'), ('___2'), ('___3')) AS t(m))
SELECT protein, multiplicity, count(x) AS n_values, round(sum(x), 4) AS total
FROM rows_ LEFT JOIN v USING (protein, half, multiplicity) GROUP BY protein, half, multiplicity""")
def site_rows_with_equal_ids(spark, sf_dir):
    """Two rows of every site, told apart by nothing: three multiplicities of each remain."""
    rows = reshape.multiplicity_wide(_site_table(spark, sf_dir, "l_orderkey % 2").drop("half"))
    values = [F.col(c) for c in rows.columns if c.startswith("reporter")]
    n = sum((v.isNotNull().cast("long") for v in values), F.lit(0).cast("long"))
    total = F.aggregate(F.array(*values), F.lit(0.0), lambda t, v: t + F.coalesce(v, F.lit(0.0)))
    return rows.select("protein", "multiplicity", n.alias("n_values"), F.when(n > 0, F.round(total, 4)).alias("total"))


@query(f"SELECT DISTINCT protein || '_' || sample || multiplicity AS protein_group FROM ({_MULTI_SQL})")
def site_keys(spark, sf_dir):
    rows = _multiplicities(spark, sf_dir)
    return rows.select(s.site_key(F.col("protein"), F.col("sample"), F.col("multiplicity")).alias("protein_group")).distinct()


# --- metadata ---------------------------------------------------------------------------


@query(with_ctes(SAMPLES) + "SELECT sample_number, sample_name, group_number, exp_group FROM meta")
def sample_metadata(spark, sf_dir):
    """Channel map and sheet go through CSV files, as a user hands them over."""
    samples = b.samples(spark, sf_dir)
    channels = [f"{flag}{n}" for flag in "anr" for n in range(1, 8)]
    map_path, sheet_path = scratch_path(spark, "channel-map"), scratch_path(spark, "sheet")
    samples.groupBy("plex").pivot("channel", channels).agg(F.first("number")).write.option("header", True).csv(map_path)
    b.sheet(spark, sf_dir).write.option("header", True).csv(sheet_path)
    rows = meta.channel_rows(tables.read_channel_map(spark, map_path), "tmt")
    joined = meta.sample_metadata(rows, meta.sample_sheet(tables.read_sample_sheet(spark, sheet_path)))
    return joined.select("sample_number", "sample_name", "group_number", "exp_group")


@query(with_ctes(SAMPLES) + "SELECT sample_number, sample_name, group_number, exp_group FROM meta ORDER BY group_number")
def metadata_by_group(spark, sf_dir):
    return meta.order_by_group(b.metadata(spark, sf_dir))


@query(with_ctes(ANNOTATED) + """SELECT protein_group, sample_name, round(intens, 6) AS intens, sample_number, group_number, exp_group, plex,
  channel AS tmt, CASE group_number WHEN 'POOL' THEN 'POOL' ELSE 'sample' END AS sample_or_pool FROM annotated""")
def long_with_metadata(spark, sf_dir):
    return b.annotated(spark, sf_dir).withColumn("intens", r6("intens"))


@query(with_ctes(SAMPLES) + """SELECT sample_name, exp_group,
  row_number() OVER (PARTITION BY exp_group ORDER BY sample_name) AS running_number FROM meta""")
def running_numbers(spark, sf_dir):
    return meta.running_number(b.metadata(spark, sf_dir)).select("sample_name", "exp_group", "running_number")


@query(with_ctes(SAMPLES) + """SELECT sample_name, row_number() OVER (ORDER BY sample_name) AS position FROM meta WHERE group_number <> 'POOL'""")
def ordered_samples(spark, sf_dir):
    return meta.non_pool_samples(b.metadata(spark, sf_dir))


@query(with_ctes(SAMPLES) + """SELECT sample_name, CASE WHEN flag = 'A' THEN 'left' ELSE 'right' END AS side FROM sample_list WHERE flag IN ('A', 'N')""")
def samples_on_one_side(spark, sf_dir):
    long = b.dense(spark, sf_dir)
    left = long.where(~F.contains("sample_name", F.lit("_n")))
    right = long.where(~F.contains("sample_name", F.lit("_a")))
    return meta.samples_on_one_side(left, right)


# --- row filters ------------------------------------------------------------------------


@query("""SELECT p_partkey, p_name FROM part WHERE p_size <> 1 AND NOT (p_brand = 'Brand#2') AND coalesce(p_type, '') <> 'SMALL'""")
def flagged_rows_dropped(spark, sf_dir):
    def mark(condition):
        return F.when(condition, "+")

    part = b.table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", mark(F.col("p_size") == 1).alias("reverse"),
        mark(F.col("p_brand") == "Brand#2").alias("potential_contaminant"),
        F.coalesce(mark(F.col("p_type") == "SMALL"), F.lit("")).alias("only_identified_by_site"),
    )
    return clean.drop_flagged(part)


@query("""SELECT 'sp|' || s_name || '|N' || s_nationkey AS accession, s_suppkey FROM supplier
WHERE s_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)""")
def contaminants_removed(spark, sf_dir):
    proteins = b.table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("sp|"), "s_name", F.lit("|N"), F.col("s_nationkey").cast("string")).alias("accession"), "s_suppkey")
    listed = b.table(spark, sf_dir, "nation").where("n_regionkey = 1").select(
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("accession"))
    return clean.remove_contaminants(proteins, listed)


@query(with_ctes(_LINES) + "SELECT protein_group, sample_name, count(*) AS n FROM obs GROUP BY 1, 2 HAVING max(v) IS NOT NULL")
def all_missing_dropped(spark, sf_dir):
    long = clean.drop_all_missing_long(b.lines(spark, sf_dir), ["protein_group", "sample_name"], "v")
    return long.groupBy("protein_group", "sample_name").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT l_partkey, max(CASE WHEN l_linestatus = 'F' THEN nullif(l_discount, 0) END) AS plex1,
  max(CASE WHEN l_linestatus = 'O' THEN nullif(l_discount, 0) END) AS plex2 FROM lineitem GROUP BY 1
HAVING max(nullif(l_discount, 0)) IS NOT NULL""")
def all_missing_dropped_wide(spark, sf_dir):
    v = s.zero_to_null(F.col("l_discount"))
    wide = b.table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(
        F.max(F.when(F.col("l_linestatus") == "F", v)).alias("plex1"), F.max(F.when(F.col("l_linestatus") == "O", v)).alias("plex2"))
    return clean.drop_all_missing(wide, ["plex1", "plex2"])


@query("""SELECT l_orderkey, l_linenumber, l_tax FROM lineitem WHERE l_tax >= 0.05""")
def confident_sites(spark, sf_dir):
    rows = b.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_tax")
    return clean.confident_sites(rows, "l_tax", 0.05)


@query(with_ctes(DENSE) + """SELECT sample_name, count(*) AS n, round(sum(intens), 6) AS total FROM dense
WHERE sample_name NOT IN ('plex1_tmt_a1', 'plex2_tmt_r7') GROUP BY 1""")
def named_samples_removed(spark, sf_dir):
    kept = clean.remove_samples(b.dense(spark, sf_dir), ["plex1_tmt_a1", "plex2_tmt_r7"])
    return kept.groupBy("sample_name").agg(F.count(F.lit(1)).alias("n"), r6(F.sum("intens"), "total"))


@query(with_ctes(SPARSE, SAMPLES) + """, kept AS (
  SELECT protein_group FROM sparse GROUP BY 1 HAVING 1 - count(intens) / (SELECT CAST(count(*) AS DOUBLE) FROM sample_list) <= 0.5)
SELECT k.protein_group, s.sample_name, round(intens, 6) AS intens FROM kept k CROSS JOIN sample_list s
LEFT JOIN sparse x ON x.protein_group = k.protein_group AND x.sample_name = s.sample_name""")
def missing_share_filter(spark, sf_dir):
    """Filtered while sparse: only features that stay are filled up to the whole grid."""
    names = meta.sample_names(b.metadata(spark, sf_dir))
    kept = clean.filter_missing(b.sparse(spark, sf_dir), 0.5, "intens", n_samples=len(names))
    return reshape.densify(kept, names, "intens").select("protein_group", "sample_name", r6("intens"))


@query(with_ctes(ANNOTATED) + """SELECT protein_group, sample_name, round(intens, 6) AS intens FROM dense
WHERE sample_name IN (SELECT sample_name FROM meta WHERE group_number <> 'POOL')""")
def common_samples_kept(spark, sf_dir):
    mapped = b.metadata(spark, sf_dir).where("group_number <> 'POOL'")
    kept = clean.keep_common_samples(b.dense(spark, sf_dir), mapped, b.extent(spark, sf_dir).samples)
    return kept.select("protein_group", "sample_name", r6("intens"))
