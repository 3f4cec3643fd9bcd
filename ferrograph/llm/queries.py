"""Queries of the text problems, by name: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import read_table
from . import boilerplate, encoding, leaks, lookalikes, residue, sentences, subjects, term_frequency


def p1_found(spark, sf_dir):
    return lookalikes.same_reading(read_table(spark, sf_dir, "tanks_data"), read_table(spark, sf_dir, "canonical_labels"))


def p1_unified(spark, sf_dir):
    return lookalikes.unify(read_table(spark, sf_dir, "tanks_data"), read_table(spark, sf_dir, "canonical_labels"), "row_id", ["display_name"], ["strategies", "keywords"])


def p1_near(spark, sf_dir):
    return lookalikes.near_labels(read_table(spark, sf_dir, "tanks_data"), read_table(spark, sf_dir, "canonical_labels"), ["display_name"], ["strategies", "keywords"])


def p2_sentences(spark, sf_dir):
    return sentences.statements(read_table(spark, sf_dir, "strategy_segments"), read_table(spark, sf_dir, "tanks_data"))


def p2_found(spark, sf_dir):
    starts = sentences.statements(read_table(spark, sf_dir, "strategy_segments"), read_table(spark, sf_dir, "tanks_data"), text=False)
    return starts.where("sentence_no > 0").select("src", "record_id", "item_no", "start_char")


def p3_main_text(spark, sf_dir):
    blocks = boilerplate.main_content(read_table(spark, sf_dir, "guide_segments"), read_table(spark, sf_dir, "fetch_results"))
    lines = F.array_sort(F.collect_list(F.struct("block_no", "text")))
    return blocks.groupBy("src", "record_id").agg(F.array_join(F.transform(lines, lambda x: x["text"]), "\n").alias("text"))


def p3_found(spark, sf_dir):
    return boilerplate.main_content(read_table(spark, sf_dir, "guide_segments"), read_table(spark, sf_dir, "fetch_results")).select("src", "record_id", "block_no")


def p4_found(spark, sf_dir):
    return residue.residue_records(read_table(spark, sf_dir, "fetch_results"))


def p5_frequency(spark, sf_dir):
    tanks = read_table(spark, sf_dir, "tanks_data", "keywords")
    return term_frequency.mark_extremes(term_frequency.term_frequency(tanks, "keywords", "keyword"), tanks)


def p5_found(spark, sf_dir):
    return p5_frequency(spark, sf_dir).where("mark is not null").select("keyword", "mark")


def p6_ids(spark, sf_dir):
    return encoding.encode(read_table(spark, sf_dir, "documents"), f"{encoding.TOKENIZERS}/byte_bpe_50k.tiktoken")


def p7_found(spark, sf_dir):
    return leaks.contained(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "eval_items"))


def p7_documents(spark, sf_dir):
    return leaks.leaked_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "eval_items"))


def p8_found(spark, sf_dir):
    return subjects.unlabelled(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "subject_labels"))


def p8_composition(spark, sf_dir):
    return subjects.composition(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "subject_labels"))


QUERIES = {
    f.__name__: f
    for f in (p1_found, p1_unified, p1_near, p2_found, p2_sentences, p3_found, p3_main_text, p4_found, p5_found, p5_frequency, p6_ids, p7_found, p7_documents, p8_found, p8_composition)
}
_FREQUENCY = r"""
WITH items AS (SELECT row_id, unnest(keywords) AS keyword FROM tanks_data),
kept AS (SELECT * FROM items WHERE keyword IS NOT NULL AND regexp_matches(keyword, '[^\s\x{0085}\p{Z}]')),
f AS (SELECT keyword, count(*) AS occurrences, count(DISTINCT row_id) AS records FROM kept GROUP BY keyword),
n AS (SELECT count(*) AS all_rows FROM tanks_data),
marks AS (
  SELECT keyword, 'rare' AS mark FROM f WHERE records <= 2
  UNION ALL SELECT keyword, 'common' FROM f, n WHERE records > 0.05 * all_rows)
"""
ORACLES = {
    "p5_found": _FREQUENCY + "SELECT keyword, mark FROM marks",
    "p5_frequency": _FREQUENCY + "SELECT f.keyword, f.occurrences, f.records, marks.mark FROM f LEFT JOIN marks USING (keyword)",
}
