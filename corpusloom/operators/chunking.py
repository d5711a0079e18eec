"""Document chunking. Splitters are small helpers per text over Arrow batches, whose bounds are found by bisection of running lengths;
numbering, metadata and statistics are plain columns."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Callable, Sequence
from functools import partial
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import text as tx

WS_CHARS = " \t\n\r\f"
SENTENCE_GAP = re.compile(r"(?<=[.!?])[ \t\n\r\f]+")
SENTENCE_END = re.compile(r"(?<=\.) ")
TRIMMED = " \t\n\x0b\f\r"
NON_WS = re.compile(r"[^ \t\n\r\f]+")

# Chunk sizes of the study, and the separators of the recursive splitter.
WORDS_PER_CHUNK, WORD_OVERLAP = 200, 50
GREEDY_CHARS = 350
# Text a Python worker takes at once. A batch's chunks are held as strings beside its texts, several times their size, so
# batches are cut by bytes, not only by rows (Spark's default is 64 MB).
BATCH_BYTES = 8 << 20
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
RECURSIVE_CHARS, RECURSIVE_OVERLAP = 1000, 200
RECURSIVE_SEPARATORS = ("\n\n", "\n", ". ", " ", "")
PARAGRAPH_CHARS = 500
SWEEP_SIZES = (50, 150, 300, 600)
SWEEP_SLACK = 25


def sentence_word_chunks(text: str, size: int = WORDS_PER_CHUNK, overlap: int = WORD_OVERLAP, faithful: bool = False) -> list[str]:
    """Sentence chunks with a word overlap. A chunk is always one run of the text's words, so only its
    bounds are tracked. ``faithful`` keeps the empty chunk that a too long first sentence makes."""
    words = NON_WS.findall(text)
    bounds, begin, seen = [], 0, 0
    for sentence in SENTENCE_GAP.split(text.strip(WS_CHARS)):
        n = len(NON_WS.findall(sentence))
        if seen - begin + n > size:
            bounds.append((begin, seen))
            begin = max(begin, seen - overlap) if overlap else seen
        seen += n
    bounds.append((begin, seen))
    last = len(bounds) - 1
    return [" ".join(words[a:b]) for i, (a, b) in enumerate(bounds) if b > a or (faithful and i < last)]


def _pieces(text: str, lo: int, hi: int, sep: str) -> list[tuple[int, int]]:
    """Spans of text[lo:hi] that start at each occurrence of ``sep`` (at each character if empty)."""
    if sep:
        cuts, at = [], text.find(sep, lo, hi)
        while at >= 0:
            cuts.append(at)
            at = text.find(sep, at + len(sep), hi)
    else:
        cuts = list(range(lo + 1, hi))
    edges = [lo, *cuts, hi]
    return [(a, b) for a, b in zip(edges, edges[1:]) if b > a]


def _pack(spans: Sequence[tuple[int, int]], size: int, overlap: int) -> list[tuple[int, int]]:
    """Join neighbouring spans up to ``size``; the next chunk starts at most ``overlap`` back."""
    out, first = [], 0
    for i, (lo, hi) in enumerate(spans):
        width = hi - lo
        if i > first and lo - spans[first][0] + width > size:
            out.append((spans[first][0], lo))
            while first < i and (lo - spans[first][0] > overlap or lo - spans[first][0] + width > size):
                first += 1
    if spans:
        out.append((spans[first][0], spans[-1][1]))
    return out


def recursive_chunks(
    text: str, size: int = RECURSIVE_CHARS, overlap: int = RECURSIVE_OVERLAP, separators: Sequence[str] = RECURSIVE_SEPARATORS
) -> list[str]:
    """Split at the coarsest separator present, recurse into pieces that are still too long, and pack
    short neighbours with overlap. Separators stay at the start of the piece that follows them."""

    def walk(lo: int, hi: int, level: int) -> list[tuple[int, int]]:
        while level < len(separators) - 1 and text.find(separators[level], lo, hi) < 0:
            level += 1
        spans, waiting = [], []
        for piece in _pieces(text, lo, hi, separators[level]):
            if piece[1] - piece[0] < size:
                waiting.append(piece)
                continue
            spans += _pack(waiting, size, overlap)
            waiting = []
            spans += walk(*piece, level + 1) if level + 1 < len(separators) else [piece]
        return spans + _pack(waiting, size, overlap)

    return [c for c in (text[a:b].strip() for a, b in walk(0, len(text), 0)) if c]


def chunk_array(text: Column, splitter: Callable[[str], list[str]]) -> Column:
    """``array<string>`` of a splitter's chunks, run over Arrow batches."""

    def run(texts: pd.Series) -> pd.Series:
        return texts.map(splitter, na_action="ignore")

    bound_batches(SparkSession.getActiveSession())
    return F.pandas_udf(run, "array<string>")(text)


def bound_batches(spark: SparkSession | None) -> None:
    """Arrow batches of at most BATCH_BYTES in this session; a stream's batches run in a session of their own."""
    if spark is not None and not ((held := str(spark.conf.get(ARROW_BYTES))).isdigit() and int(held) <= BATCH_BYTES):
        spark.conf.set(ARROW_BYTES, str(BATCH_BYTES))


def sentence_word_array(text: Column, size: int = WORDS_PER_CHUNK, overlap: int = WORD_OVERLAP, faithful: bool = False) -> Column:
    return chunk_array(text, partial(sentence_word_chunks, size=size, overlap=overlap, faithful=faithful))


def greedy_ends(lengths: Sequence[int], size: int = GREEDY_CHARS) -> list[int]:
    """Ends of the chunks over sentences of these lengths: each chunk ends where its running length first passes ``size``.

    Every end is found by bisection of the running lengths, so a text costs as many steps as it has chunks.
    """
    run, ends, base = list(accumulate(lengths)), [], 0
    while (at := bisect_right(run, base + size)) < len(run):
        ends.append(at + 1)
        base = run[at]
    return ends if ends and ends[-1] == len(run) else [*ends, len(run)]


def piece_bounds(lengths: Sequence[int], glue: Sequence[int], cuts: Sequence[bool], size: int = PARAGRAPH_CHARS, keep_open: bool = False) -> list[tuple[int, int]]:
    """Chunk bounds (first piece, piece behind the last) over pieces of these lengths with their glue, empty chunks left out.

    A chunk is closed in front of a piece that does not fit any more, and in front of a ``cut`` piece; with ``keep_open``
    a cut leaves it open, so that its pieces come again. The next piece that does not fit is found by bisection.
    """
    n = len(lengths)
    before = [0, *accumulate(a + b for a, b in zip(lengths, glue))]
    reach = [a + b for a, b in zip(before, lengths)]  # never falls
    bounds, lo, at, taken = [], 0, 0, 0  # taken: length in front of the open chunk
    for stop in [*(i for i, cut in enumerate(cuts) if cut), n]:
        while at < stop:
            full = max(at, bisect_right(reach, taken + size))
            if full >= stop:
                break
            bounds.append((lo, full))
            lo, at, taken = full, full + 1, before[full]
        at = max(at, stop)
        if stop < n:
            bounds.append((lo, stop))
            if not keep_open:
                lo, taken = stop, before[stop]
    return [b for b in [*bounds, (lo, n)] if b[0] < b[1]]


def greedy_chunks(text: str, size: int = GREEDY_CHARS) -> list[str]:
    """A chunk ends with the sentence whose running length, joining spaces left out, passes ``size``."""
    sentences = SENTENCE_GAP.split(text.strip(WS_CHARS))
    ends = greedy_ends([len(s) for s in sentences], size)
    return [" ".join(sentences[a:b]) for a, b in zip([0, *ends], ends)]


def greedy_array(text: Column, size: int = GREEDY_CHARS) -> Column:
    return chunk_array(text, partial(greedy_chunks, size=size))


def paragraph_chunks(text: str, size: int = PARAGRAPH_CHARS, separator: str = "\n\n", faithful: bool = False) -> list[str]:
    """Paragraphs are packed up to ``size``; a longer one is packed by sentence."""
    pieces = []  # text, glue, cut
    for p in text.split(separator):
        if len(p) <= size:
            pieces.append((p, separator, False))
        else:
            parts = p.split("|") if faithful else [p]
            pieces += [(s, " ", i == 0) for i, s in enumerate(s for part in parts for s in SENTENCE_END.split(part))]
    bounds = piece_bounds([len(t) for t, _, _ in pieces], [len(g) for _, g, _ in pieces], [c for _, _, c in pieces], size, faithful)
    chunks = ["".join(t + g for t, g, _ in pieces[a:b]).strip(TRIMMED) for a, b in bounds]
    return chunks if faithful else [c for c in chunks if c]


def paragraph_array(text: Column, size: int = PARAGRAPH_CHARS, separator: str = "\n\n", mode: str = "fixed") -> Column:
    """``faithful`` repeats the text before a too long paragraph in the chunk after it and keeps empty chunks; ``fixed`` does neither."""
    return chunk_array(text, partial(paragraph_chunks, size=size, separator=separator, faithful=mode == "faithful"))


def recursive_array(text: Column, size: int = RECURSIVE_CHARS, overlap: int = RECURSIVE_OVERLAP) -> Column:
    return chunk_array(text, partial(recursive_chunks, size=size, overlap=overlap))


def explode_chunks(docs: DataFrame, chunks: Column, keep: Sequence[str], id_col: str = "doc_id") -> DataFrame:
    """One row per chunk, keyed by (document, index), with the document's columns carried along."""
    return (
        docs.select(id_col, *keep, chunks.alias("_chunks"))
        .select(id_col, *keep, F.size("_chunks").cast("bigint").alias("total_chunks"), F.posexplode("_chunks").alias("_i", "content"))
        .select(
            F.concat_ws("_chunk_", F.col(id_col).cast("string"), F.col("_i").cast("string")).alias("chunk_id"),
            id_col, *keep,
            F.col("_i").cast("bigint").alias("chunk_index"),
            "total_chunks", "content",
            F.length("content").cast("bigint").alias("char_count"),
        )
    )


def size_distribution(chunks: DataFrame) -> DataFrame:
    per_doc = chunks.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("char_count").alias("lo"), F.max("char_count").alias("hi"), F.sum("char_count").alias("total")
    )
    return per_doc.agg(
        F.count(F.lit(1)).alias("documents"),
        F.sum("n").alias("chunks"),
        (F.sum("n") / F.count(F.lit(1))).alias("chunks_per_doc"),
        F.min("lo").alias("min_chars"),
        F.max("hi").alias("max_chars"),
        (F.sum("total") / F.sum("n")).alias("avg_chars"),
    )


def size_sweep(chunks: DataFrame, keyword: str, sizes: Sequence[int] = SWEEP_SIZES, slack: int = SWEEP_SLACK) -> DataFrame:
    """Per size: chunks that fit and the share of them with the keyword, all sizes in one pass."""
    n_words = tx.word_count(F.col("content"))
    hit = F.contains(F.lower("content"), F.lit(keyword.lower()))
    marked = chunks.select(n_words.alias("n_words"), hit.alias("hit"))
    sums = marked.agg(*[
        F.struct(
            F.lit(s).alias("chunk_size"),
            F.count(F.when(F.col("n_words") <= s + slack, 1)).alias("chunks"),
            F.count(F.when((F.col("n_words") <= s + slack) & F.col("hit"), 1)).alias("hits"),
        ).alias(f"s{s}")
        for s in sizes
    ])
    return sums.select(F.explode(F.array(*[f"s{s}" for s in sizes])).alias("r")).select(
        "r.chunk_size", "r.chunks", F.when(F.col("r.chunks") > 0, F.col("r.hits") / F.col("r.chunks")).otherwise(0.0).alias("precision_score")
    )


def overlap_effect(docs: DataFrame, keyword: str, size: int = WORDS_PER_CHUNK, overlap: int = WORD_OVERLAP, text_col: str = "content") -> DataFrame:
    """Chunks, mean length and keyword hits with and without overlap."""
    variants = F.array(
        F.struct(F.lit("with_overlap").alias("variant"), F.col("_with").alias("chunks")),
        F.struct(F.lit("without_overlap").alias("variant"), F.col("_without").alias("chunks")),
    )
    both = docs.select(
        sentence_word_array(F.col(text_col), size, overlap).alias("_with"), sentence_word_array(F.col(text_col), size, 0).alias("_without")
    )
    return (
        both.select(F.explode(variants).alias("v"))
        .select("v.variant", F.explode("v.chunks").alias("chunk"))
        .groupBy("variant")
        .agg(
            F.count(F.lit(1)).alias("chunks"),
            F.avg(F.length("chunk")).alias("avg_chars"),
            F.count(F.when(F.contains(F.lower("chunk"), F.lit(keyword.lower())), 1)).alias("keyword_hits"),
        )
    )
