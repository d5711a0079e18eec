"""Secret scan with DataFrame functions only: fixed patterns, and sliding-window entropy over candidate strings.

Positions of all matches of a pattern come from two native calls: ``split`` gives the text between the matches and
``regexp_extract_all`` the matches, and their running lengths are the offsets. The running lengths are folded in blocks
of 256, so a text with very many matches costs n * 256 steps and not n * n. Expressions run only on texts that pass a
cheap test. All work is within the row: nothing is shuffled.

Entropy: a candidate is a run of 20 or more characters of [A-Za-z0-9+/_-] with a digit and a letter. For each character
class whose alphabet holds all of the candidate, a window of 20 characters slides over it. The state of the fold holds
the count of each character and the sum of c * log2(c); a step changes two counts. The candidate is reported if any
window reaches the class's threshold. Every candidate is in a class: the last two hold those of one case with marks, where
words and dates joined by marks (paths, slugs) need more bits than strings in which letters and digits alternate. Allow-listed candidates (words that mark samples, runs of one character,
counting sequences, ids in the 8-4-4-4-12 form) are suppressed.

Defined cases: a null text is empty and has no spans; equal rows get equal results; an empty table gives no rows. Offsets
are code points, ends exclusive. Added columns replace input columns of the same name; other columns are kept.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import fresh, sha256_hex

# The base patterns.
ASSIGN = r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}"
KEY_PARTS = ("passw", "secret", "token", "api")
LEAST_VALUE = 6

# Character classes (what the candidate looks like: alphabet, least bits in a window) and the allow-list.
WINDOW = 20
ONE_CASE_MARKS = r"^(?=[A-Z0-9+/_-]+$|[a-z0-9+/_-]+$)(?=[A-Za-z0-9]*[+/_-])"
ALTERNATES = r"(?>.*?(?:[A-Za-z](?=[0-9])|[0-9](?=[A-Za-z]))){3}"
CLASSES = {
    r"^[0-9a-f]+$": ("0123456789abcdef", 2.9),
    r"^[A-Z0-9]+$": ("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", 3.4),
    r"(?=.*[a-z])(?=.*[A-Z])": ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-", 3.7),
    r"^[a-z0-9]+$": ("abcdefghijklmnopqrstuvwxyz0123456789", 3.4),
    ONE_CASE_MARKS + ALTERNATES: ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-", 3.3),
    ONE_CASE_MARKS: ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-", 4.0),
}
ALLOWED = r"(?i)example|sample|placeholder|changeme|dummy|0123456789|1234567890|abcdefghij|^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
FOLD = 256
SPAN = "array<struct<kind:string,start:bigint,stop:bigint,ok:boolean>>"


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, although lambdas inside ``body`` use it many times."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _positions(pairs: Column, kind: str, accept) -> Column:
    """Spans from (b, m) pairs: the text in front of a match, and the match."""

    def one(state, pair):
        start = state["at"] + F.length(pair["b"])
        stop = start + F.length(pair["m"])
        span = F.struct(F.lit(kind).alias("kind"), start.alias("start"), stop.alias("stop"), accept(pair["m"]).alias("ok"))
        return F.struct(stop.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

    def block(state, part):
        done = F.aggregate(part, F.struct(state["at"].alias("at"), F.array().cast(SPAN).alias("spans")), one)
        return F.struct(done["at"].alias("at"), F.concat(state["blocks"], F.array(done["spans"])).alias("blocks"))

    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(f"array<{SPAN}>").alias("blocks"))
    firsts = F.sequence(F.lit(1), F.size(pairs), F.lit(FOLD))
    return F.flatten(F.aggregate(F.transform(firsts, lambda k: F.slice(pairs, k, F.lit(FOLD))), start, block)["blocks"])


def matches_of(text: Column, pattern: str, kind: str, gate: Column, accept=lambda m: F.lit(True)) -> Column:
    none = F.array().cast(SPAN)
    pairs = F.arrays_zip(F.split(text, pattern, -1).alias("b"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"))
    whole = F.filter(pairs, lambda p: p["m"].isNotNull())  # the last piece has no match behind it
    return F.when(gate, let(whole, lambda p: F.when(F.size(p) > 0, _positions(p, kind, accept)).otherwise(none))).otherwise(none)


def _weight(count: Column) -> Column:
    return F.when(count > 1, count * F.log2(count.cast("double"))).otherwise(F.lit(0.0))


def highest_entropy(s: Column, alphabet: str, window: int = WINDOW) -> Column:
    """Highest Shannon entropy (bits a character) of ``window`` consecutive characters of ``s``, by incremental counts."""
    codes = F.transform(F.split(s, ""), lambda c: F.instr(F.lit(alphabet), c))
    # each step sees the code that comes in, and the one that leaves the window (0: none yet)
    moves = let(codes, lambda c: F.arrays_zip(c.alias("came"), F.slice(F.concat(F.array_repeat(F.lit(0), window), c), F.lit(1), F.size(c)).alias("went")))
    state0 = F.struct(F.array_repeat(F.lit(0), len(alphabet)).alias("counts"), F.lit(0).alias("n"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("best"))
    count = lambda counts, code: F.element_at(counts, F.greatest(code, F.lit(1)))

    def step(state, move):
        came, went, n = move["came"], move["went"], state["n"] + 1
        a = count(state["counts"], came)
        b = count(state["counts"], went) + (went == came).cast("int")
        grown = state["sum"] + _weight(a + 1) - _weight(a)
        total = F.when(went > 0, grown + _weight(b - 1) - _weight(b)).otherwise(grown)
        counts = F.transform(state["counts"], lambda c, j: c + (j + 1 == came).cast("int") - (j + 1 == went).cast("int"))
        bits = F.when(n >= window, F.log2(F.lit(float(window))) - total / F.lit(float(window))).otherwise(F.lit(0.0))
        return F.struct(counts.alias("counts"), n.alias("n"), total.alias("sum"), F.greatest(state["best"], bits).alias("best"))

    return F.round(F.aggregate(moves, state0, step)["best"], 9)


def random_looking(s: Column) -> Column:
    """A candidate with a digit and a letter, not allow-listed, one class of which reaches its entropy in some window."""
    found = F.lit(False)
    for holds, (alphabet, least) in CLASSES.items():
        found = found | (s.rlike(holds) & (highest_entropy(s, alphabet) >= least))
    return s.rlike("[0-9]") & s.rlike("[A-Za-z]") & ~s.rlike(ALLOWED) & found


def secret_spans(text: Column) -> Column:
    """All accepted spans of a text by start, then kind (assign, access, hex, entropy)."""
    holds = lambda *parts, of=text: reduce(or_, [F.contains(of, F.lit(p)) for p in parts])
    named = holds(":", "=") & holds(*KEY_PARTS, of=F.lower(text))
    digits = holds(*"0123456789")
    value = lambda m: F.length(F.regexp_extract(m, ASSIGN, 1)) >= LEAST_VALUE
    spans = F.concat(
        matches_of(text, ASSIGN, "assign", named, value),
        matches_of(text, ACCESS, "access", holds("AKIA")),
        matches_of(text, HEX, "hex", text.rlike(HEX)),
        matches_of(text, CANDIDATE, "entropy", digits & text.rlike(CANDIDATE), random_looking),
    )
    kinds = F.array(*[F.lit(k) for k in ("assign", "access", "hex", "entropy")])
    ranked = F.transform(F.filter(spans, lambda x: x["ok"]), lambda x: F.struct(x["start"].alias("start"), F.array_position(kinds, x["kind"]).alias("k"), x["stop"].alias("stop"), x["kind"].alias("kind")))
    return F.sort_array(ranked)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["stop"].cast("string"))), ",")


def scan_secrets(docs: DataFrame) -> DataFrame:
    """Documents with ``secrets``: array of (start, k, stop, kind)."""
    return docs.withColumn("secrets", secret_spans(F.coalesce(F.col("text"), F.lit(""))))


def secret_digest(docs: DataFrame) -> DataFrame:
    """One row per document: counts of the base kinds, the hash of the base spans, and all spans as text."""
    spans = fresh("spans")
    found = docs.select("doc_id", secret_spans(F.coalesce(F.col("text"), F.lit(""))).alias(spans))
    kinds = ("assign", "access", "hex")
    count = lambda kind: F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select("doc_id", *[count(k) for k in kinds], sha256_hex(_joined(F.filter(spans, lambda x: x["kind"] != "entropy"))).alias("base_sha256"), _joined(F.col(spans)).alias("spans"))


def redact_secrets(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """Documents with every accepted span replaced by ``mark`` (overlapping spans by one) and n_chars brought up to date.

    Texts without a span, and null texts, stay as they are.
    """
    spans, out = fresh("spans"), fresh("text")
    marked = docs.withColumn(spans, secret_spans(F.coalesce(F.col("text"), F.lit(""))))

    def piece(state, x):
        keep = F.substring(F.col("text"), (state["at"] + 1).cast("int"), F.greatest(x["start"] - state["at"], F.lit(0)).cast("int"))
        text = F.when(x["start"] >= state["at"], F.concat(state["out"], keep, F.lit(mark))).otherwise(state["out"])
        return F.struct(F.greatest(state["at"], x["stop"]).alias("at"), text.alias("out"))

    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))
    done = F.aggregate(F.col(spans), start, piece)
    whole = F.concat(done["out"], F.expr(f"substring(text, cast(aggregate({spans}, cast(0 as bigint), (s, x) -> greatest(s, x.stop)) + 1 as int))"))
    marked = marked.withColumn(out, F.when(F.size(spans) > 0, whole).otherwise(F.col("text")))
    hit = F.size(spans) > 0
    new = {"text": F.col(out), "n_chars": F.when(hit, F.length(out).cast("bigint")).otherwise(F.col("n_chars")) if "n_chars" in docs.columns else None}
    return marked.select(*[new[c].alias(c) if new.get(c) is not None else F.col(c) for c in docs.columns])
