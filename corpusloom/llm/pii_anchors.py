"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, plus signs, digits, schemes and identifier cues. Each anchor
starts a small local parser that expands to the left and right, tests the boundaries and validates the result (octets,
check digits, digit counts). A parser never looks behind the end of its kind's last match, so the spans of a kind are
the leftmost ones and do not overlap, and the work is linear in the text.

Base kinds: email, ip, card (13 to 19 digits, Luhn), phone (9 to 15 digits). Added kinds, which only their anchors make
visible: login (user and password in front of a host, after a scheme), account (IBAN after its cue, mod 97) and ssn
(after its cue, with the blocks that are never issued left out).

Defined cases: a null text is empty and has no spans; equal rows get equal results; an empty table gives no rows. Offsets
are code points, ends exclusive. Added columns replace input columns of the same name; other columns are kept.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import fresh, sha256_hex

# Kinds in order, and the cues of identifiers.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = BASE_KINDS + ("login", "account", "ssn")
CUES = {"IBAN": "account", "Iban": "account", "iban": "account", "SSN": "ssn", "Ssn": "ssn", "ssn": "ssn", "social security": "ssn", "Social Security": "ssn"}

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
ADDRESS = re.compile(r"([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
NUMBER = re.compile(r"[0-9](?:[ -]?[0-9])+")
DIALLED = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
USER = re.compile(r"[^\s/@:?#]+:[^\s/@?#]+(?=@)")
IBAN = re.compile(r"[ :#.]{0,4}(?:[Nn]o[.:]? ?|number:? )?([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{1,4}){3,8})(?![A-Za-z0-9])")
SSN = re.compile(r"[ :#.]{0,4}(?:[Nn]o[.:]? ?|number:? )?((?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4})(?![0-9-])")
SPANS = "array<struct<kind:string,start:bigint,stop:bigint>>"


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def iban_valid(s: str) -> bool:
    s = s.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def _email(text, at, free):
    start = at
    while start > free and text[start - 1] in LOCAL:
        start -= 1
    m = DOMAIN.match(text, at + 1) if start < at else None
    return (start, m.end(), True) if m else None


def _ip(text, at, free):
    m = ADDRESS.match(text, at)
    # a number of many digits is no octet; its length is tested first
    return (at, m.end(), all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.groups())) if m else None


def _card(text, at, free):
    m = NUMBER.match(text, at)
    if not m:
        return None
    digits = m[0].replace(" ", "").replace("-", "")
    return at, m.end(), 13 <= len(digits) <= 19 and luhn(digits)


def _phone(text, at, free):
    m = DIALLED.match(text, at)
    return (at, m.end(), 9 <= sum(c.isdigit() for c in m[0]) <= 15) if m else None


def _login(text, at, free):
    m = USER.match(text, at + 3)
    return (at + 3, m.end(), True) if m else None


def _account(text, at, free):
    m = IBAN.match(text, at)
    return (m.start(1), m.end(1), iban_valid(m[1])) if m else None


def _ssn(text, at, free):
    m = SSN.match(text, at)
    return (m.start(1), m.end(1), True) if m else None


PARSERS = {"email": _email, "ip": _ip, "card": _card, "phone": _phone, "login": _login, "account": _account, "ssn": _ssn}


def automaton():
    import ahocorasick

    out = ahocorasick.Automaton()
    out.add_word("@", (0, ("email",)))
    out.add_word("+", (0, ("phone",)))
    out.add_word("://", (2, ("login",)))
    for d in "0123456789":
        out.add_word(d, (0, ("ip", "card")))
    for cue, kind in CUES.items():
        out.add_word(cue, (-1, (kind,)))  # parsed from behind the cue
    out.make_automaton()
    return out


def find_spans(text: str, anchors) -> list[tuple[str, int, int]]:
    """Accepted spans by kind as listed, then start."""
    free = dict.fromkeys(KINDS, 0)
    found = {k: [] for k in KINDS}
    last_digit = -2
    for end, (back, kinds) in anchors.iter(text):
        at = end - back
        if len(kinds) == 2:  # a digit: only the first of a run can start a match
            inside, last_digit = last_digit == at - 1, at
            if inside:
                continue
        for kind in kinds:
            if at >= free[kind] and (span := PARSERS[kind](text, at, free[kind])):
                start, stop, good = span
                free[kind] = stop  # a failing match is used up, too
                if good:
                    found[kind].append((kind, start, stop))
    return [s for k in KINDS for s in found[k]]


def _scan(name: str):
    def run(batches):
        anchors = automaton()
        for batch in batches:
            spans = [[{"kind": k, "start": a, "stop": b} for k, a, b in find_spans(t.as_py() or "", anchors)] for t in batch.column("text")]
            columns = [pa.array(spans, batch.schema.field(i).type) if c == name else batch.column(i) for i, c in enumerate(batch.schema.names)]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return run


def find_pii(docs: DataFrame) -> DataFrame:
    """Documents with ``pii``: array of (kind, start, stop), by kind as listed, then start."""
    name = fresh("pii")
    marked = docs.withColumn(name, F.array().cast(SPANS))
    found = marked.mapInArrow(_scan(name), marked.schema)
    return found.select(*[c for c in docs.columns if c != "pii"], F.col(name).alias("pii"))


def pii_digest(docs: DataFrame) -> DataFrame:
    """One row per document: counts of the base kinds, the hash of the base spans, and all spans as text."""
    joined = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["stop"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("pii", lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    base = F.filter("pii", lambda x: x["kind"].isin(*BASE_KINDS))
    return find_pii(docs.select("doc_id", "text")).select("doc_id", *[count(k) for k in BASE_KINDS], sha256_hex(joined(base)).alias("base_sha256"), joined(F.col("pii")).alias("spans"))
