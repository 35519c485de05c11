"""The queries of the training-data operators: name -> (spark, sf_dir) -> DataFrame, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.batches import repeated_postings
from tidemark.llm.encoding import restore_encoding, restored_digest
from tidemark.llm.leaks import find_leaks
from tidemark.llm.markup import convert
from tidemark.llm.names import link_names, name_pairs
from tidemark.llm.packing import fill_report, pack
from tidemark.llm.pii import find_personal
from tidemark.llm.places import link_places
from tidemark.llm.residue import find_residue
from tidemark.runtime import table


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return name_pairs(link_names(table(spark, sf_dir, "jobs")))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return convert(table(spark, sf_dir, "jobs"), keep_text=False).drop("markup", "n_labels", "n_nav")


def p3_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the tree tells apart beyond the markup's own cues."""
    return convert(table(spark, sf_dir, "jobs"), keep_text=False).select("row_id", "markup", "n_labels", "n_nav")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_places(table(spark, sf_dir, "jobs"), table(spark, sf_dir, "places"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_postings(table(spark, sf_dir, "jobs"), table(spark, sf_dir, "source_config"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return restored_digest(restore_encoding(table(spark, sf_dir, "jobs"), ["title", "description_html"]))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_residue(table(spark, sf_dir, "jobs"))


def p8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), table(spark, sf_dir, "bins"))


def p8_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_report(p8_packing(spark, sf_dir), table(spark, sf_dir, "bins"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal(table(spark, sf_dir, "documents"))


QUERIES = {"p2_found": p2_found, "p3_found": p3_found, "p3_roles": p3_roles, "p4_found": p4_found, "p5_found": p5_found, "p6_found": p6_found, "p7_found": p7_found, "p8_packing": p8_packing, "p8_fill": p8_fill, "p9_found": p9_found, "p10_found": p10_found}

SQL = {
    "p5_found": r"""
        WITH a AS (
            SELECT row_id, coalesce(c.board, j.source) AS board, regexp_replace(lower(trim(native_id)), '^[a-z][a-z0-9+.-]*://[^/]*', '') AS t
            FROM jobs j LEFT JOIN (SELECT source, min(board) AS board FROM source_config GROUP BY source) c USING (source)
            WHERE native_id IS NOT NULL AND j.source IS NOT NULL),
        b AS (SELECT row_id, board, regexp_replace(regexp_replace(regexp_replace(regexp_replace(t, '^(urn:)?(uuid|id|guid):', ''), '(.)[?#].*$', '\1'), '^/[a-z_-]+/(.)', '\1'), '^[a-z_]+=', '') AS t FROM a),
        c AS (SELECT row_id, board, regexp_replace(t, '[^a-z0-9]', '', 'g') AS t FROM b),
        d AS (SELECT row_id, board, regexp_replace(t, '^([a-z]*)0*([0-9]+)$', '\1\2') AS k FROM c WHERE t <> ''),
        e AS (SELECT row_id, min(row_id) OVER (PARTITION BY board, k) AS first_row_id FROM d)
        SELECT first_row_id, row_id FROM e WHERE first_row_id < row_id""",
}
