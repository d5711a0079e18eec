from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from corpusloom.operators import chunking as ck


def test_sentence_word_chunks_case():
    text = "a b c d e f. g h i. j k."
    assert ck.sentence_word_chunks(text, 5, 2, faithful=True) == ["", "a b c d e f.", "e f. g h i.", "h i. j k."]
    assert ck.sentence_word_chunks(text, 5, 2) == ["a b c d e f.", "e f. g h i.", "h i. j k."]


def chunks_of(spark, text, array):
    return spark.createDataFrame([(text,)], "t string").select(array(F.col("t"))).first()[0]


def test_greedy_chunks_close_after_the_passing_sentence(spark):
    assert chunks_of(spark, "Aaaa. Bbbb. Cc.", lambda t: ck.greedy_array(t, 8)) == ["Aaaa. Bbbb.", "Cc."]
    assert chunks_of(spark, " One. ", lambda t: ck.greedy_array(t, 8)) == ["One."]
    assert chunks_of(spark, None, ck.greedy_array) is None


def test_paragraph_chunks_modes(spark):
    text = "Intro.\n\nAaaa bbbb. Cccc dddd. Eeee ffff."
    assert chunks_of(spark, text, lambda t: ck.paragraph_array(t, 20, mode="faithful")) == ["Intro.", "Intro.\n\nAaaa bbbb.", "Cccc dddd.", "Eeee ffff."]
    assert chunks_of(spark, text, lambda t: ck.paragraph_array(t, 20)) == ["Intro.", "Aaaa bbbb.", "Cccc dddd.", "Eeee ffff."]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 30), min_size=1, max_size=60), st.integers(0, 40))
def test_greedy_ends(lengths, size):
    want, total = [], 0
    for i, n in enumerate(lengths):
        total += n
        if total > size:
            want.append(i + 1)
            total = 0
    assert ck.greedy_ends(lengths, size) == (want if want and want[-1] == len(lengths) else [*want, len(lengths)])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 2), st.booleans()), min_size=1, max_size=60), st.integers(1, 40), st.booleans())
def test_piece_bounds(pieces, size, keep_open):
    want, held, lo = [], 0, 0
    for i, (n, glue, cut) in enumerate(pieces):
        if cut:
            want += [(lo, i)]
            if not keep_open:
                held, lo = 0, i
        if held + n > size:
            want += [(lo, i)]
            held, lo = 0, i
        held += n + glue
    want += [(lo, len(pieces))]
    got = ck.piece_bounds(*zip(*pieces), size=size, keep_open=keep_open)
    assert got == [b for b in want if b[0] < b[1]]


def test_long_texts_in_linear_time(spark):
    import time

    took = []
    for n in (10_000, 40_000):
        df = spark.createDataFrame([("A short one. " * n,)], "t string")
        start = time.time()
        df.select(F.size(ck.greedy_array(F.col("t"))), F.size(ck.paragraph_array(F.col("t")))).collect()
        took.append(time.time() - start)
    assert took[1] < 8 * took[0] + 2


def test_recursive_chunks_overlap():
    words = " ".join(f"w{i:03d}" for i in range(60))
    chunks = ck.recursive_chunks(words, 50, 20)
    assert all(len(c) <= 50 for c in chunks)
    assert all(a.split()[-1] in b.split() for a, b in zip(chunks, chunks[1:]))
    assert ck.recursive_chunks("one\n\ntwo", 5, 0) == ["one", "two"]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab. \n", max_size=300), st.integers(5, 40), st.integers(0, 4))
def test_recursive_chunks_cover_and_bound(text, size, overlap):
    chunks = ck.recursive_chunks(text, size, overlap)
    assert all(0 < len(c) <= size for c in chunks)
    at = 0
    for c in chunks:  # in order, and all letters covered
        found = text.find(c, max(0, at - overlap - size))
        assert found >= 0
        at = found
    assert set("".join(chunks)) >= set(text) - set(" \n")


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab. ", max_size=300), st.integers(2, 20), st.integers(0, 5))
def test_word_chunks_cover_all_words(text, size, overlap):
    chunks = ck.sentence_word_chunks(text, size, overlap)
    words = text.split()
    assert set(" ".join(chunks).split()) == set(words)
    assert " ".join(ck.sentence_word_chunks(text, size, 0)).split() == words


def test_chunk_batches_are_cut_by_bytes(spark):
    from corpusloom.operators import chunking as ck

    texts = spark.range(3000, numPartitions=1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("Word one. Word two. "), 2000).alias("content"))
    seen = ck.chunk_array(F.col("content"), lambda t: [str(len(t))])  # sets the cut as a step of the plan
    assert int(spark.conf.get(ck.ARROW_BYTES)) <= ck.BATCH_BYTES

    @F.pandas_udf("long")
    def batch_rows(s):
        return s.map(lambda _: len(s))

    # 3,000 texts of 40,000 characters: more than 64 MB in one partition, about 8 MB a batch (a batch ends after the row that passes it)
    assert texts.select(batch_rows("content").alias("n"), seen.alias("c")).agg(F.max("n")).first()[0] * 40_000 <= 2 * ck.BATCH_BYTES
