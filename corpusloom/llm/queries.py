"""The registered queries of this subpackage and, where SQL can say it, their SQL forms."""

from __future__ import annotations


from corpusloom.llm import decontamination, extraction, filter_audit, importance, mixing, pii_anchors, secret_scan, shallot, suffix_dedup, tensored_minhash, toxic_spans, url_filter, vector_graph
from corpusloom.llm.common import documents
from corpusloom.sources.tables import table


def op1_importance_resampling(spark, root):
    scores, _ = importance.resample(documents(spark, root), table(spark, root, "labels"))
    return scores.where("kept")


def op2_block_extraction(spark, root):
    return extraction.extract_text(table(spark, root, "pages")).drop("html")


def op3_fm_decontamination(spark, root):
    return decontamination.leak_digest(documents(spark, root), table(spark, root, "benchmark"))


def op4_suffix_dedup(spark, root):
    return suffix_dedup.remove_repeats(documents(spark, root).select("doc_id", "text"))


def op5_source_mixing(spark, root):
    mixed = mixing.mix_sources(documents(spark, root).select("doc_id", "source", "text"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op6_vector_graph(spark, root):
    return vector_graph.near_vectors(table(spark, root, "embeddings"))


def op7_url_filter(spark, root):
    named = [(*r, True) for r in url_filter.RULES] + [(*s, "block", False) for s in url_filter.BAD_SITES]
    entries = spark.createDataFrame(named, "host string, path string, verdict string, named boolean")
    return url_filter.filter_urls(table(spark, root, "pages").select("page_id", "url"), entries).drop("url")


def op8_pii_anchors(spark, root):
    return pii_anchors.pii_digest(documents(spark, root))


def op9_secret_entropy(spark, root):
    return secret_scan.secret_digest(documents(spark, root))


def op10_tensored_minhash(spark, root):
    return tensored_minhash.near_duplicates(documents(spark, root), shingle=2)


def op11_filter_audit(spark, root):
    return filter_audit.filter_audit(documents(spark, root), table(spark, root, "labels"))


def op12_toxic_spans(spark, root):
    return toxic_spans.toxic_digest(documents(spark, root), table(spark, root, "labels"))


def op13_shallot_clusters(spark, root):
    return shallot.cluster_digest(table(spark, root, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_importance_resampling, op2_block_extraction, op3_fm_decontamination, op4_suffix_dedup, op5_source_mixing, op6_vector_graph, op7_url_filter, op8_pii_anchors, op9_secret_entropy, op10_tensored_minhash, op11_filter_audit, op12_toxic_spans, op13_shallot_clusters)}
ORACLES = {"op3_fm_decontamination": decontamination.SQL, "op5_source_mixing": mixing.SQL, "op7_url_filter": url_filter.SQL, "op11_filter_audit": filter_audit.SQL, "op13_shallot_clusters": shallot.SQL}
