"""Searches, annotation joins and checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from plexlake.catalog import bindings as b
from plexlake.catalog.registry import ANNOTATED, PLEX, query, r6, with_ctes
from plexlake.operators import annotate, checks, search


def _passages(spark, sf_dir, broadcast_limit):
    documents = b.table(spark, sf_dir, "documents").select("doc_id", "text")
    passages = b.table(spark, sf_dir, "benchmark").select(F.col("text").alias("passage"))
    pairs = search.contains_pairs(passages, "passage", documents, "text", "doc_id", broadcast_limit)
    return search.first_match(pairs, "passage", "doc_id")


_PASSAGES = """SELECT passage, min(doc_id) AS doc_id, count(*) AS n_matches
FROM (SELECT DISTINCT text AS passage FROM benchmark) JOIN documents ON contains(documents.text, passage) GROUP BY 1"""


@query(_PASSAGES)
def sequence_search(spark, sf_dir):
    """First text that contains each passage."""
    return _passages(spark, sf_dir, 200_000)


@query(_PASSAGES)
def sequence_search_shuffled(spark, sf_dir):
    """The same for query sets above the broadcast bound: anchors are shuffled, texts only for candidates."""
    return _passages(spark, sf_dir, 0)


@query("""SELECT t.turn_id, CASE WHEN t.accession <> '' THEN t.accession ELSE f.accession END AS accession
FROM (SELECT item_id AS turn_id, text AS peptide_seq, CASE WHEN length(text) > 240 THEN 'known' ELSE '' END AS accession FROM benchmark) t
LEFT JOIN (SELECT text, 'D' || min(doc_id) AS accession FROM (
  SELECT b.text, d.doc_id FROM benchmark b JOIN documents d ON contains(d.text, b.text)) GROUP BY 1) f ON f.text = t.peptide_seq""")
def missing_accessions_filled(spark, sf_dir):
    peptides = b.table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("turn_id"), F.col("text").alias("peptide_seq"),
        F.when(F.length("text") > 240, "known").otherwise("").alias("accession"))
    fasta = b.table(spark, sf_dir, "documents").select(
        F.col("text").alias("sequence"), F.col("doc_id").alias("fasta_ord"), F.concat(F.lit("D"), F.col("doc_id").cast("string")).alias("accession"))
    return search.fill_accessions(peptides, fasta).select("turn_id", "accession")


def _suppliers_as_fasta(spark, sf_dir):
    return b.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("accession"), F.col("s_suppkey").alias("fasta_ord"),
        F.col("s_name").alias("gene_name"), F.col("s_nationkey").cast("string").alias("description"))


@query("""SELECT good_accession, s_name AS gene_name, CAST(s_nationkey AS VARCHAR) AS description
FROM (SELECT DISTINCT CAST(l_suppkey AS VARCHAR) AS good_accession FROM lineitem)
LEFT JOIN supplier ON CAST(s_suppkey AS VARCHAR) = good_accession""")
def accession_lookup(spark, sf_dir):
    keys = b.table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").cast("string").alias("good_accession"))
    return search.lookup_accessions(keys, _suppliers_as_fasta(spark, sf_dir))


@query("""SELECT good_accession, arg_min(s_name, s_suppkey) AS gene_name, CAST(arg_min(s_nationkey, s_suppkey) AS VARCHAR) AS description
FROM (SELECT DISTINCT CAST(s_nationkey AS VARCHAR) AS good_accession FROM supplier)
LEFT JOIN supplier ON contains(CAST(s_suppkey AS VARCHAR), good_accession) GROUP BY 1""")
def accession_lookup_contains(spark, sf_dir):
    """A key also matches longer accessions that contain it; the first record wins."""
    keys = b.table(spark, sf_dir, "supplier").select(F.col("s_nationkey").cast("string").alias("good_accession"))
    return search.lookup_accessions(keys, _suppliers_as_fasta(spark, sf_dir), mode="contains")


@query("""SELECT DISTINCT l_partkey, l_quantity, l_discount FROM lineitem""")
def redundant_rows_collapsed(spark, sf_dir):
    return annotate.collapse_redundant(b.table(spark, sf_dir, "lineitem"), "l_partkey", ["l_quantity", "l_discount"])


@query("""SELECT conv_id, string_agg(role, ';' ORDER BY turn) AS role, string_agg(text, ';' ORDER BY turn) AS text
FROM conversations GROUP BY 1""")
def annotation_concatenated(spark, sf_dir):
    return annotate.concat_annotation(b.table(spark, sf_dir, "conversations"), "conv_id", ["role", "text"], "turn")


@query("""SELECT l_partkey, l_suppkey, s_name AS gene_name, CAST(s_nationkey AS VARCHAR) AS description
FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey AND s_suppkey % 3 <> 0""")
def peptides_without_match_kept(spark, sf_dir):
    """A third of the accessions has no record; their rows stay."""
    rows = b.table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", F.col("l_suppkey").cast("string").alias("good_accession"))
    records = _suppliers_as_fasta(spark, sf_dir).where("fasta_ord % 3 <> 0")
    return search.with_records(rows, records).select("l_partkey", "l_suppkey", "gene_name", "description")


@query("""SELECT l_partkey, flags, l_linestatus FROM (SELECT DISTINCT l_partkey, l_linestatus FROM lineitem)
JOIN (SELECT l_partkey, string_agg(l_returnflag, ';' ORDER BY l_orderkey * 8 + l_linenumber, l_returnflag) AS flags FROM lineitem GROUP BY 1) USING (l_partkey)""")
def annotation_beside_distinct_rows(spark, sf_dir):
    """Only the named columns are concatenated; a value that repeats in the others appears once."""
    order = (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("o")
    lines = b.table(spark, sf_dir, "lineitem").select("l_partkey", F.col("l_returnflag").alias("flags"), "l_linestatus", order)
    return annotate.concat_beside(lines, "l_partkey", ["flags"], ["l_linestatus"], "o")


_JOINED = f"""ann AS (SELECT l_partkey AS f, string_agg(l_returnflag, ';' ORDER BY l_orderkey * 8 + l_linenumber, l_returnflag) AS flags FROM lineitem GROUP BY 1),
vals AS (SELECT DISTINCT l_partkey AS f, {PLEX} AS plex, l_quantity AS v FROM lineitem)"""


def _groups(spark, sf_dir):
    lines = b.table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("f"), F.expr(b.PLEX).alias("plex"), F.col("l_quantity").alias("v"), F.col("l_returnflag").alias("flags"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("row_ord"))
    return annotate.concat_annotation(lines, "f", ["flags"], "row_ord"), annotate.collapse_redundant(lines, "f", ["plex", "v"])


@query(with_ctes(_JOINED) + "SELECT f, flags, plex, v FROM ann JOIN vals USING (f)")
def annotation_with_intensities(spark, sf_dir):
    annotation, values = _groups(spark, sf_dir)
    return annotate.join_groups(annotation, values, "f")


@query(with_ctes(_JOINED) + """SELECT f, 1 AS n_annotation, count(*) AS n_values FROM vals GROUP BY 1 HAVING count(*) > 1""")
def ambiguous_groups(spark, sf_dir):
    return checks.ambiguous_groups(*_groups(spark, sf_dir), "f")


@query("SELECT DISTINCT s_nationkey, n_name FROM supplier JOIN nation ON n_nationkey = s_nationkey")
def annotation_dimension(spark, sf_dir):
    joined = b.table(spark, sf_dir, "supplier").join(b.table(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("s_nationkey"))
    return annotate.annotation_dimension(joined, ["s_nationkey", "n_name"])


@query("""SELECT count(*) AS n_rows, count(DISTINCT l_partkey) AS n_keys, count(*) = count(DISTINCT l_partkey) AS is_unique FROM lineitem""")
def key_uniqueness(spark, sf_dir):
    return checks.key_is_unique(b.table(spark, sf_dir, "lineitem"), "l_partkey")


@query("SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_keys(spark, sf_dir):
    return checks.duplicate_keys(b.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(with_ctes(ANNOTATED) + "SELECT sample_name, count(*) AS n_rows FROM annotated WHERE group_number = 'POOL' GROUP BY 1")
def unmapped_samples(spark, sf_dir):
    mapped = b.metadata(spark, sf_dir).where("group_number <> 'POOL'")
    return checks.unmapped_samples(b.dense(spark, sf_dir), mapped)


@query(with_ctes(ANNOTATED) + """SELECT protein_group, s_name AS protein_names, s_nationkey AS gene_names, round(avg(intens), 6) AS ave_expr
FROM annotated JOIN supplier ON CAST(s_suppkey AS VARCHAR) = protein_group GROUP BY 1, 2, 3""")
def results_with_annotation(spark, sf_dir):
    means = b.annotated(spark, sf_dir).groupBy("protein_group").agg(r6(F.avg("intens"), "ave_expr"))
    return annotate.attach_annotation(means, b.supplier_annotation(spark, sf_dir))
