"""Every table of the engine: columns and key. Readers pass these schemas; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

_KINDS = {"s": T.StringType(), "i": T.IntegerType(), "h": T.ShortType(), "d": T.DoubleType(), "l": T.LongType(), "a": T.ArrayType(T.ShortType(), False)}


def _table(columns: str) -> T.StructType:
    parts = [c.partition(":") for c in columns.split()]
    return T.StructType([T.StructField(name, _KINDS[kind or "s"]) for name, _, kind in parts])


#: name -> (schema, key columns)
TABLES: dict[str, tuple[T.StructType, list[str]]] = {
    name: (_table(columns), key.split())
    for name, columns, key in (
        ("wd_links", "src dst prop", "src dst prop"),
        ("wd_dates", "qid property time_value precision:h source_property source_target", "qid property time_value precision source_property source_target"),
        ("wd_entities", "qid best_label wp_count:i", "qid"),
        ("wd_labels", "lang label qid", "lang label qid"),
        ("wd_coords", "qid latitude:d longitude:d altitude:d precision:d globe", "qid latitude longitude globe"),
        ("languages", "id:h code", "id"),
        ("wp_links", "src dst witnesses:a wp_count:i", "src dst"),
        ("lemma_lexeme", "lang lemma lid", "lang lemma lid"),
        ("form_lexeme", "lang lemma lid", "lang lemma lid"),
        ("lexeme_lexeme", "src dst prop", "src dst prop"),
        ("lexeme_item", "lid qid prop", "lid qid prop"),
        ("sense_item", "src_lid src_sid dst prop", "src_lid src_sid dst prop"),
        ("sense_sense", "src_lid src_sid dst_lid dst_sid prop", "src_lid src_sid dst_lid dst_sid prop"),
        ("wkt_entries", "entry", "entry"),
        ("wkt_links", "src dst wkt_count:i", "src dst"),
        ("aw_entries", "qid", "qid"),
        ("aw_refs", "src_qid ref", "src_qid ref"),
        ("wf_objects", "zid", "zid"),
        ("wf_labels", "zid lang kind label", "zid lang kind label"),
        ("dbp_links", "src dst predicate", "src dst predicate"),
        ("resolution_methods", "id:h name", "id"),
        ("obs_best_guess_links", "src dst witnesses:a n:i", "src dst"),
        ("obs_conv_failures", "lang_id:h src target", "lang_id src target"),
        ("obs_src_not_found", "lang_id:h title", "lang_id title"),
        ("obs_redirect_anomalies", "lang_id:h title kind", "lang_id title"),
        ("wp_witness_methods", "lang_id:h src dst method:h", "lang_id src dst method"),
        ("obs_failed_targets", "target n_langs:l n_pairs:l", "target"),
    )
}

RESOLUTION_METHODS = [(1, "redirect_chain"), (2, "crosslang_qid"), (3, "crosslang_title")]
#: Longest title that diagnostic tables hold, in characters.
TITLE_CHARS = 384


def schema(name: str) -> T.StructType:
    return TABLES[name][0]


def key(name: str) -> list[str]:
    return TABLES[name][1]
