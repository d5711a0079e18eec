import pytest
from pyspark.sql import functions as F

from corpusloom.functions import text as tx
from corpusloom.operators import answers as an
from corpusloom.operators import embedding as em
from corpusloom.operators import evaluation as ev
from corpusloom.operators import monitoring as mo
from corpusloom.sources import sinks

GROUNDING = [
    ("The incident response procedure requires P1 incidents to be escalated within 15 minutes.",
     "According to the procedure, P1 incidents must be escalated within 15 minutes.", 8, 6, "LOW"),
    ("AI systems must maintain audit trails and log all inference requests.",
     "AI systems need to keep audit trails. They should also implement real-time monitoring dashboards.", 12, 3, "HIGH"),
    ("The data classification policy defines four levels: Public, Internal, Confidential, and Restricted.",
     "There are six classification levels including Top Secret and Eyes Only categories.", 9, 1, "HIGH"),
    ("Some context.", "the and of", 0, 0, "LOW"),
]


def test_grounding(spark):
    df = spark.createDataFrame(GROUNDING, "context string, answer string, terms long, shared long, want string")
    rows = ev.grounding_risk(df).collect()
    assert all((r.response_terms, r.matching_terms, r.risk) == (r.terms, r.shared, r.want) for r in rows)
    rate = ev.hallucination_rate(ev.grounding_risk(df.limit(3))).first()
    assert round(rate.hallucination_rate, 2) == 66.67


def decide(spark, b, o):
    cols = "k string, correctness_mean double, groundedness_mean double, latency_p95 double, avg_tokens double"
    mk = lambda v: spark.createDataFrame([("x", *v)], cols)
    r = ev.deploy_decision(mk(b), mk(o), ["k"]).first()
    return r.recommendation, r.confidence


@pytest.mark.parametrize("o,want", [
    ((4.0, 4.0, 500.0, 65.0), ("DEPLOY", 0.95)),
    ((3.85, 3.8, 500.0, 55.0), ("DEPLOY", 0.85)),
    ((3.85, 3.8, 500.0, 75.0), ("DEPLOY", 0.75)),
    ((3.5, 4.0, 500.0, 50.0), ("REJECT", 0.90)),
    ((4.0, 4.0, 500.0, 95.0), ("REJECT", 0.80)),
    ((3.7, 4.0, 500.0, 75.0), ("REVIEW", 0.60)),
])
def test_deploy_rules(spark, o, want):
    assert decide(spark, (4.0, 4.0, 500.0, 100.0), o) == want


def test_response_reuse_case(spark):
    asked = ["What is X?", "How is Y?", " what is x? ", "And Z?", "how is y?", "WHAT IS X?"]
    df = spark.createDataFrame(list(enumerate(asked)), "id int, q string")
    hits = [r.is_hit for r in an.response_reuse(df, "id", "q").orderBy("id").collect()]
    assert hits == [False, False, True, False, True, True]
    s = an.reuse_summary(df, "q").first()
    assert (s.hits, s.misses, s.hit_rate) == (3, 3, 50.0)


def test_keyword_match_and_checks(spark):
    df = spark.createDataFrame([("The warranty lasts 12 months.", ["warranty", "12 months", "manufacturing defects"])], "answer string, kw array<string>")
    assert round(ev.keyword_match(df, F.col("kw")).first().match_rate, 4) == 66.6667
    checks = ev.response_checks(spark.createDataFrame([("According to policy it usually works",), ("I don't have enough information here",)], "answer string"), F.array(F.lit("IT USUALLY"))).collect()
    assert [(r.grounding, r.safety, r.hallucination_prevention) for r in checks] == [(True, True, False), (True, True, True)]


def test_scores(spark):
    df = spark.createDataFrame([(7,), (0,), (None,)], "s int")
    assert ev.score_means(df, ["s"]).first().s_mean == 3.0


def test_claims(spark):
    claims = spark.createDataFrame([(1, 1500.0, 1, "hail"), (2, 2500.0, 1, "paint"), (3, 9000.0, 2, "x"), (4, 10.0, 9, "x")], "claim_id int, estimated_cost double, policy_id int, description string")
    policies = spark.createDataFrame([(1, True), (2, False)], "policy_id int, active boolean")
    rows = an.triage_claims(claims, policies, incident_words={"weather": ["hail"]}).orderBy("claim_id").collect()
    assert [r.decision for r in rows] == ["Auto-Approve", "Manual Review", "Reject", "Reject"]
    assert [r.severity for r in rows] == ["medium", "high", "high", "low"] and rows[0].incident == "weather"


def test_routes_and_empty(spark):
    hits = spark.createDataFrame([(1, 1, "the retention is 180 days"), (1, 2, "warranty of a year"), (2, 1, "other"), (2, 2, "more")], "query_id int, rank int, content string")
    q = spark.createDataFrame([(1, "Retention or WARRANTY?"), (2, "warranty?"), (3, "warranty?")], "query_id int, question string")
    routes = [(("warranty",), ("warranty",), "Based on the documentation"), (("retention", "retain"), ("retention", "days"), "Based on the policy")]
    got = {r.query_id: r.answer for r in an.routed_answer(hits, q, routes).collect()}
    assert got == {1: "Based on the documentation: warranty of a year", 2: "Based on the available information: other more...", 3: an.NOT_FOUND}


def test_embeddings(spark):
    df = spark.createDataFrame([(1, "a text that is long enough"), (2, "short"), (3, None), (4, "another text with more words")], "id int, t string")
    for out in (em.hashed_embeddings(df, "t"), em.model_embeddings(df, "t", lambda: lambda xs: [[3.0, 4.0] for _ in xs])):
        rows = {r.id: r.embedding for r in out.collect()}
        assert rows[2] is None and rows[3] is None and len(rows) == 4
    assert sum(x * x for x in em.hashed_embeddings(df, "t").where("id = 1").first().embedding) == pytest.approx(1, abs=1e-5)
    assert rows[1] == [3.0, 4.0]


def test_model_answers_hook(spark):
    df = spark.createDataFrame([(1, "p")], "id int, prompt string")
    assert an.model_answers(df, lambda ps: [p.upper() for p in ps]).first().answer == "P"


def test_text_cases(spark):
    row = spark.createDataFrame([(" a\n\n\nb  c Page 12 d ", "x <b>&amp;lt;</b><script>var a='</p>'</script>&copy;", "One. Two. Three")], "a string, h string, s string").select(
        tx.clean_text(F.col("a")).alias("a"), tx.html_to_text(F.col("h")).alias("h"),
        tx.lead_sentences(F.col("s"), F.lit("simple")).alias("s1"), tx.lead_sentences(F.col("s"), F.lit("moderate")).alias("s2"),
    ).first()
    assert (row.a, row.h, row.s1, row.s2) == ("a\nb c  d", "x &lt; ©", "One.", "One. Two.")


def test_sync_actions(spark):
    new = spark.createDataFrame([(1, "a"), (2, "B"), (4, "d")], "id int, c string")
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, c string")
    ch = sinks.index_changes(new, old, "id", "c")
    assert {(r.id, r.action) for r in ch.collect()} == {(2, "update"), (3, "delete"), (4, "insert")}
    assert sorted(map(tuple, sinks.apply_changes(old, new, ch, "id").collect())) == sorted(map(tuple, new.collect()))


def test_concurrency(spark):
    df = spark.createDataFrame([(0, 10.0), (5, 10.0), (12, 1.0), (40, 1.0)], "m int, latency_ms double").withColumn("ts", F.timestamp_seconds(F.col("m") * 60))
    rows = {r.in_flight: r.requests for r in mo.concurrency_profile(df, "MINUTES", 3).collect()}
    assert rows == {1: 2, 2: 2}


def test_containment(spark):
    items = spark.createDataFrame([(1, "a b c d e f"), (2, "x y")], "i int, t string")
    corpus = spark.createDataFrame([(1, "z a b c d e"), (2, "z a b c d e"), (3, None)], "d int, t string")
    rows = ev.ngram_containment(items, corpus, "i", "t", "d", "t").collect()
    assert [(r.i, r.grams, r.grams_found) for r in rows] == [(1, 2, 1)]


def test_containment_repeats_and_long_texts(spark):
    # repeated grams count once; no pairwise array_distinct over a document's gram structs (quadratic in its length)
    items = spark.createDataFrame([(1, "a b c d e a b c d e")], "i int, t string")
    corpus = spark.createDataFrame([(1, "a b c d e x a b c d e")], "d int, t string")
    rows = ev.ngram_containment(items, corpus, "i", "t", "d", "t").collect()
    assert [(r.i, r.grams, r.grams_found) for r in rows] == [(1, 5, 1)]
    plan = ev.gram_hashes(corpus, "d", "t", 5)._jdf.queryExecution().optimizedPlan().toString()
    assert "array_distinct" not in plan
